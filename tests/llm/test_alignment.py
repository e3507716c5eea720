"""Alignment against whole texts straight from the tokenizers; fragments in any bracketing."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventloom.llm.alignment import AlignRules, Pair, align, default_models, fragment
from eventloom.llm.queries import QUERIES

from .brute_alignment import aligned, streams

ODD = [
    "Hello world", " ", "a ", "a  ", "  two  spaces \n\n and\tlines\r\n  here ", "x　 y  z   w", "▁ mark", "café naïve 漢字文 text",
    "<|endoftext|> <s> </s> <unk> plain", "emoji \U0001f600\U0001f600 joined", "don't we'll they're 'tis", "\x00\x01 control \x1f x", "\n", "\n x", "tabs\t\t x", None, "",
    "é combining", "1234567 89,000.5", "..... ,,, !!!", "\x1c x\x85 y", "word " * 50, "nospaceatall" * 300,
]


def _rows(df):
    return {r.doc_id: (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in df.collect()}


@pytest.mark.parametrize("size", [7, 64, 64 << 10])
def test_odd_texts_in_all_sizes_of_chunks(spark, size):
    df = spark.createDataFrame(list(enumerate(ODD)), "doc_id long, text string")
    got = _rows(align(df, rules=AlignRules(chunk_bytes=size, fan_in=2)))
    want = dict(enumerate(aligned(ODD)))
    assert got == want


def test_query_matches_plain_version(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    want = dict(zip([r.doc_id for r in docs], aligned([r.text for r in docs]), strict=True))
    assert _rows(QUERIES["op12_token_alignment"](spark, sf)) == want


def test_fragments_compose_in_any_bracketing():
    rng = random.Random(4)
    text = "The quick brown fox, 123 jumping over naïve cafés and 漢字 again and again"
    (a, b), = streams([text])
    one, two = np.cumsum([len(x) for _, x in a]), np.cumsum([len(x) for _, x in b])
    size = int(one[-1])

    def part(lo, hi):
        p, q = (one > lo) & (one <= hi), (two > lo) & (two <= hi)
        return fragment([a[k][0] for k in np.flatnonzero(p)], one[p].tolist(), [b[k][0] for k in np.flatnonzero(q)], two[q].tolist())

    def fold(parts):
        if len(parts) == 1:
            return parts[0]
        at = rng.randrange(1, len(parts))
        return fold(parts[:at]) + fold(parts[at:])

    whole = part(0, size)
    for _ in range(100):
        bounds = [0, *sorted(rng.sample(range(1, size), rng.randint(1, 12))), size]
        got = fold([part(lo, hi) for lo, hi in zip(bounds, bounds[1:], strict=False)])
        assert got.groups() == whole.groups()
        assert (got.n_a, got.n_b, got.n_closed) == (whole.n_a, whole.n_b, whole.n_closed)
        assert got.pairs.tolist() == whole.pairs.tolist() and got.counts.tolist() == whole.counts.tolist()


def test_units_forgotten():
    with open(default_models()[0], encoding="utf-8") as f, open(default_models()[1], "rb") as g:
        pair = Pair(f.read(), g.read(), kept=3)
    for units in ([[b" a", b" b"]], [[b" c", b" d"]], [[b" a", b" d"]]):
        pair.learn(units)
        assert all(u in pair.known for u in units[0])


def test_odd_rows(odd):
    got = align(odd).collect()
    assert len(got) == odd.count()
    by_id = {}
    for r in got:
        by_id.setdefault(r.doc_id, []).append(r)
    assert [tuple(r)[1:] for k in (1, 2) for r in by_id[k]] == [(0, 0, 0, 0, 0, 0, "")] * 2
    assert len(by_id[5]) == 2 and by_id[5][0] == by_id[5][1]
    assert by_id[3][0].n_groups == 30_001 and by_id[None][0].n_links > 3
    assert align(odd.filter(F.lit(False))).count() == 0
