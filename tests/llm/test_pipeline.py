"""The pipeline against a plain version of each stage, and the registered queries against SQL."""

import random

import pytest
import sentencepiece
import zstandard
from pyspark.sql import functions as F

import corpus_pipeline
from eventloom.llm.common import on_workers
from eventloom.llm.oracles import ORACLES
from eventloom.llm.queries import QUERIES
from eventloom.llm.quality import Bands
from eventloom.llm.sentence_pieces import MODEL

from ..compare import difference, duck
from . import brute
from .test_mixing import fill
from .test_text_operators import plain_counts, prose


@pytest.mark.parametrize("name", [n for n in QUERIES if n in ORACLES])
def test_queries_agree_with_sql(spark, name):
    sf = "/root/testdata/sf0.001"
    assert difference(QUERIES[name](spark, sf), duck(sf), ORACLES[name]) is None


def test_every_operator_has_a_query(spark):
    import __spark_entry__ as entry

    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


def corpus():
    draw, rows = random.Random(21), []
    passage = "This passage is repeated in a good many of the documents here, word for word"
    for k in range(60):
        text = prose(k, draw.randint(60, 500), 3000)
        if k % 4 == 0:
            text = passage + "\n" + text
        rows.append((k, text, "en", f"s{k % 4}"))
    for k in range(60, 80):
        words = rows[k - 60][1].split(" ")
        words[len(words) // 2] = "edited"
        rows.append((k, " ".join(words), "en", f"s{k % 4}"))
    rows += [(90, "too short", "en", "s1"), (91, "again and again " * 50, "en", "s1"), (92, None, None, None), (93, "", "en", "s2")]
    return rows


def good(text):
    if plain_counts(text)[-1]:
        return False
    bands, data = Bands(), text.encode()
    pack = zstandard.ZstdCompressor(level=bands.level)
    sizes = [len(data)] + [n for n in (len(data[k:k + 4096]) for k in range(0, len(data), 4096)) if n >= 1024 and len(data) > 4096]
    parts = [data] + [c for c in (data[k:k + 4096] for k in range(0, len(data), 4096)) if len(c) >= 1024 and len(data) > 4096]
    low, high = bands.limits(sizes)
    inside = [low[k] <= len(pack.compress(p)) / len(p) <= high[k] for k, p in enumerate(parts)]
    return inside[0] and not (len(parts) > 2 and inside[1:].count(False) > bands.bad_chunks * (len(parts) - 1))


def test_stages(spark, docs_of):
    on_workers(spark)
    docs = docs_of(corpus())
    kept = {k: t for k, t, *_ in corpus() if good(t)}
    assert 60 < len(kept) < 84
    steps, stages = {}, dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == list(stages)
    at = docs
    for name, stage in corpus_pipeline.STAGES:
        at = stage(spark, at, "").cache()
        steps[name] = at
        if name != "sentence_pieces":
            assert at.columns == docs.columns and at.filter(F.col("n_chars") != F.length("text")).count() == 0
    assert {r.doc_id: r.text for r in steps["quality_rules"].collect()} == kept
    cut = {k: t for k, (_, _, t) in brute.lines(kept).items()}
    assert {r.doc_id: r.text for r in steps["line_dedup"].collect()} == cut and cut != kept
    single = {k: cut[k] for k, (_, owner) in brute.near(cut).items() if k == owner}
    assert {r.doc_id: r.text for r in steps["near_dedup"].collect()} == single and len(single) < len(cut)
    size = lambda t: len(brute.WORD.findall(t))
    totals = [sum(size(t) for k, t in single.items() if k % 4 == s) for s in range(4)]
    mixed = steps["source_mixing"].collect()
    for s, want in enumerate(fill(totals, [1, 2, 3, 1])):
        assert abs(sum(size(r.text) for r in mixed if r.source == f"s{s}") - want) <= 96
    assert all(sum(size(x.text) for x in mixed if x.doc_id == k) <= 3 * size(t) for k, t in single.items())
    words = {k: set(brute.WORD.findall(t)) for k, t in single.items()}
    assert all(set(brute.WORD.findall(r.text)) <= words[r.doc_id] for r in mixed)
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    last = steps["sentence_pieces"].collect()
    assert all(r.restored for r in last)
    assert sorted((r.doc_id, library.decode(r.ids)) for r in last) == sorted((r.doc_id, r.text) for r in mixed)


def test_odd_rows_go_through(spark, odd):
    at = odd
    for name, stage in corpus_pipeline.STAGES:
        none = stage(spark, odd.limit(0), "")
        assert none.count() == 0
        at = stage(spark, odd, "")
        assert name == "sentence_pieces" or at.columns == odd.columns
        at.count()


def test_run(spark):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.count() > 0 and out.filter(~F.col("restored")).count() == 0
