"""Runs against a plain version, over random sequences, whole tables and odd rows."""

import random
from itertools import pairwise

import numpy as np
from pyspark.sql import functions as F

from eventloom.llm.common import mix
from eventloom.llm.periodic_runs import Tour, periodic_runs, runs_of, stretches, suffix_tree
from eventloom.llm.queries import QUERIES

from . import brute_runs


def _sequences(count):
    rng = random.Random(3)
    for _ in range(count):
        n, k = rng.randint(0, 60), rng.randint(1, 4)
        t = [rng.randrange(k) for _ in range(n)]
        if n > 6 and rng.random() < 0.6:
            a, p = rng.randrange(n), rng.randint(1, 6)
            t = [x if i < a or a + (i - a) % p >= n else t[a + (i - a) % p] for i, x in enumerate(t)]
            t += t[:rng.randint(0, n)]
        yield t


def test_runs_match_all_periods():
    for t in _sequences(1500):
        assert [tuple(r) for r in runs_of(np.array(t, dtype=np.int64)).tolist()] == brute_runs.runs(t), t


def test_stretches_lose_no_run():
    for t in _sequences(800):
        begin, end = stretches(np.zeros(len(t), dtype=np.int64), mix(np.array(t, dtype=np.uint64) + np.uint64(9)))
        for s, k, _ in brute_runs.runs(t):
            assert any(a <= s and s + k <= b for a, b in zip(begin.tolist(), end.tolist(), strict=True)), t


def test_extensions_are_ancestor_depths():
    rng = random.Random(8)
    t = [rng.randint(1, 2) for _ in range(80)]
    tour = Tour(suffix_tree(t))
    for a, b in pairwise(range(80)):
        k = 0
        while b + k < 80 and t[a + k] == t[b + k]:
            k += 1
        assert tour.common(np.array([a]), np.array([b]))[0] == k
    suffixes = sorted(range(81), key=lambda i: [*t, 0][i:])
    assert [int(r) for r in np.argsort(tour.rank)] == suffixes


def test_query_matches_plain_version(spark, sf):
    texts = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    want = {r.doc_id: brute_runs.digests(r.doc_id, r.text) for r in texts}
    got = QUERIES["op13_periodic_runs"](spark, sf).collect()
    assert len(got) == len(texts)
    assert {r.doc_id: tuple(r)[1:] for r in got} == want
    assert sum(r.n_runs for r in got) > 10


def test_long_text_of_one_word(spark):
    df = spark.createDataFrame([(1, "a " * 200_000), (2, "b c " * 5 + "x")], "doc_id long, text string")
    rows = {r.doc_id: r for r in periodic_runs(df).collect()}
    assert [tuple(x) for x in rows[1].runs] == [(0, 200_000, 1)] and rows[1].collapsed == "a"
    assert [tuple(x) for x in rows[2].runs] == [(0, 10, 2)] and rows[2].collapsed == "b c x"


def test_odd_rows(odd):
    rows = periodic_runs(odd).collect()
    assert len(rows) == odd.count()
    assert {r.doc_id for r in rows if r.n_words == 0} == {1, 2, 4, 7}
    assert all(r.runs == [] and r.collapsed == "" for r in rows if r.n_words == 0)
    assert [(len(r.runs), r.collapsed) for r in rows if r.doc_id == 3] == [(1, "word")]
    assert len([r for r in rows if r.doc_id == 5]) == 2
    assert periodic_runs(odd.filter(F.lit(False))).count() == 0
