import pytest
from pyspark.sql import functions as F

from eventloom.llm import mixing
from eventloom.llm.mixing import MixRules


def fill(sizes, weights, cap=3):
    """Targets by going round until no source is above its cap."""
    total, full = sum(sizes), set()
    while True:
        left = total - sum(cap * sizes[k] for k in full)
        rest = [k for k in range(len(sizes)) if k not in full]
        share = left / sum(weights[k] for k in rest) if rest else 0
        over = {k for k in rest if share * weights[k] > cap * sizes[k]}
        if not over:
            return [cap * sizes[k] if k in full else share * weights[k] for k in range(len(sizes))]
        full |= over


@pytest.mark.parametrize("n", [1, 2, 7, 64, 1000])
def test_permutation(spark, n):
    out = spark.range(n).select("id", mixing.permuted(F.col("id"), F.lit(n), F.lit(3), 24).alias("to"))
    out = out.withColumn("back", mixing.permuted(F.col("to"), F.lit(n), F.lit(3), 24, inverse=True)).collect()
    assert sorted(r.to for r in out) == list(range(n)) and all(r.back == r.id for r in out)
    assert n < 64 or sum(r.to == r.id for r in out) < n / 10


def rows_of(sizes):
    names = ["a", "b", None, "é", "Z", "aa"]
    out = []
    for s, n in zip(names, sizes):
        left, k = n, 0
        while left:
            m = min(left, 37 + 61 * (k % 5))
            out.append((1000 * len(out) + k, " ".join(f"w{j}" for j in range(m)), "en", s))
            left, k = left - m, k + 1
    return out


@pytest.mark.parametrize("sizes", [(9000, 5000, 4000, 3000, 2000, 6000), (60000, 900, 700, 40000, 300, 500)])
def test_targets_are_met(docs_of, sizes):
    rows = rows_of(sizes)
    docs = docs_of(rows)
    got = mixing.taken_words(docs).collect()
    assert sorted(got) == sorted(mixing.taken_words(docs).collect())
    order = sorted({r[3] for r in rows if r[3]}, key=lambda s: [ord(c) for c in s]) + [None]
    source = {r[0]: r[3] for r in rows}
    totals = {s: sum(r.size for r in got if source[r.doc_id] == s) for s in order}
    want = dict(zip(order, fill([totals[s] for s in order], [(1, 2, 3)[k % 3] for k in range(len(order))])))
    for s in order:
        mine = [r for r in got if source[r.doc_id] == s]
        assert all(r.source_size == totals[s] and r.taken <= 3 * r.size for r in mine)
        assert mine[0].target == pytest.approx(want[s])
        assert abs(sum(r.taken for r in mine) - want[s]) <= 1.5 * MixRules().block


def test_slots_and_pieces(docs_of):
    docs, rules = docs_of(rows_of((3000, 2000, 1000, 900, 800, 700))), MixRules(block=16, shard_slots=64)
    mix = mixing.plan_mix(docs, rules)
    slots = mix.slots.collect()
    assert sorted(r.slot for r in slots) == list(range(len(slots)))
    wanted = {r.source_no: (r.slots, r.blocks) for r in mix.sources.collect()}
    for no, (n, blocks) in wanted.items():
        mine = [r.block for r in slots if r.source_no == no]
        uses = [mine.count(b) for b in range(blocks)]
        assert len(mine) == n and max(uses) - min(uses) <= 1
    counts = mixing.shard_counts(mix).groupBy("shard").agg(F.sum("n_slots").alias("n")).collect()
    assert all(r.n == 64 for r in counts if r.shard < len(slots) // 64)
    pieces = mixing.mixed_pieces(mix).agg(F.sum(F.col("to_word") - F.col("from_word"))).first()[0]
    assert pieces == mixing.taken_words(docs, rules).agg(F.sum("taken")).first()[0]


def test_mixed_documents(docs_of):
    docs = docs_of(rows_of((900, 500, 400, 300, 200, 600)))
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns and out.schema["n_chars"].dataType == docs.schema["n_chars"].dataType
    got = {r.doc_id: r.n for r in out.groupBy("doc_id").agg(F.sum(F.size(F.split("text", " "))).alias("n")).collect()}
    want = {r.doc_id: r.taken for r in mixing.taken_words(docs).collect() if r.taken}
    assert got == want
    assert out.filter(F.col("n_chars") != F.length("text")).count() == 0


def test_odd_rows(odd):
    got = {}
    for r in mixing.taken_words(odd).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert sum(map(len, got.values())) == odd.count()
    assert (got[1][0].size, got[1][0].taken, got[2][0].taken, got[4][0].size, got[3][0].size) == (0, 0, 0, 0, 30_000)
    assert len(got[5]) == 2 and all(r.taken <= 3 * r.size for rows in got.values() for r in rows)
    assert mixing.taken_words(odd.limit(0)).count() == 0
    wordless = odd.filter("doc_id in (1, 2, 4, 7)")
    assert {r.taken for r in mixing.taken_words(wordless).collect()} == {0}
    assert mixing.mixed_documents(wordless).count() == 0 and mixing.mixed_documents(odd).columns == odd.columns
