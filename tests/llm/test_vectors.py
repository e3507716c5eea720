import numpy as np
import pytest

from eventloom.llm import vector_dedup
from eventloom.llm.vector_dedup import CodeRules

from .brute import find


def plain(rows, limit=0.95):
    """{vec_id: (links, component)} by comparing all with all."""
    usable = {k: np.array(v, dtype=float) for k, v in rows
              if v and all(x is not None for x in v) and np.isfinite(v).all() and np.any(np.array(v) != 0)}
    links = []
    keys = sorted(usable)
    for i, a in enumerate(keys):
        for b in keys[i + 1:]:
            x, y = usable[a], usable[b]
            if len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= limit:
                links.append((a, b))
    owner = find(links, [k for k, _ in rows])
    return {k: (sum(k in p for p in links), owner[k]) for k, _ in rows}


def clusters(seed, groups, dim=24, spread=0.16):
    draw, out = np.random.default_rng(seed), []
    for n in groups:
        centre = draw.standard_normal(dim)
        for _ in range(n):
            out.append((centre + spread * draw.standard_normal(dim)).astype(np.float32).tolist())
    return [(k, v) for k, v in enumerate(out)]


def check(spark, rows, kind="array<float>", rules=CodeRules()):
    got = vector_dedup.near_vectors(spark.createDataFrame(rows, f"vec_id long, embedding {kind}"), rules).collect()
    want = plain(rows)
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == want
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_clusters_and_odd_vectors(spark):
    rows = clusters(1, [1] * 80 + [2, 3, 5, 8, 30])
    last = rows[-1][1]
    rows += [(k, v) for k, v in enumerate([None, [], [0.0] * 24, [float("nan")] + [1.0] * 23, [float("inf")] * 24, [None] * 24,
                                           last, last, [3 * x for x in last], [-x for x in last], last[:12], last[:12], [1e-30 * x for x in last]], start=1000)]
    check(spark, rows)


def test_block_pairs_of_a_large_bucket(spark):
    check(spark, clusters(2, [90, 60, 1, 1], spread=0.1), "array<double>", CodeRules(block=16))


def test_links_at_the_limit(spark):
    """Pairs just above and just below the limit; misses at the limit itself are one in a thousand by design."""
    draw, rows = np.random.default_rng(5), []
    for k, c in enumerate(np.linspace(0.945, 0.955, 150)):
        a, b = draw.standard_normal((2, 32))
        a /= np.linalg.norm(a)
        b -= (a @ b) * a
        b /= np.linalg.norm(b)
        rows += [(2 * k, a.tolist()), (2 * k + 1, (c * a + np.sqrt(1 - c * c) * b).tolist())]
    check(spark, rows, "array<double>", CodeRules(missed=1e-6))


def test_estimates_are_unbiased_and_bounded():
    rules, draw = CodeRules(), np.random.default_rng(9)
    a = vector_dedup.unit_rows(draw.standard_normal((3000, 64)))
    b = draw.standard_normal((3000, 64))
    b = vector_dedup.unit_rows(b - (a * b).sum(axis=1, keepdims=True) * a)
    b = 0.95 * a + np.sqrt(1 - 0.95**2) * b
    codes, factor = vector_dedup.binary_codes(a, rules)
    coded = vector_dedup.unpacked(codes, 64, rules)
    assert np.allclose((coded * a).sum(axis=1), factor)
    estimate = (coded * b).sum(axis=1) / factor
    assert abs(estimate.mean() - 0.95) < 0.003
    assert (estimate >= vector_dedup.least_estimate(factor, coded, rules) - 1e-12).mean() > 0.9995


def test_repeated_and_clashing(spark):
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.01]), (3, [0.0, 1.0])]
    df = spark.createDataFrame([(*r, 7, 7, "x", 7) for r in rows], "vec_id long, embedding array<float>, rep long, n long, vec string, label int")
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in vector_dedup.near_vectors(df).collect())
    assert got == [(1, 2, 1), (1, 2, 1), (2, 2, 1), (3, 0, 3)]
    assert vector_dedup.near_vectors(df.limit(0)).count() == 0
    assert vector_dedup.near_vectors(spark.createDataFrame([(None, None)], "vec_id long, embedding array<float>")).collect()[0].n_links == 0


@pytest.mark.parametrize("n", [2, 1000, 10**6, 10**9])
def test_tables_keep_the_promise(n):
    bits, tables = vector_dedup.tables_for(n, CodeRules())
    together = (1 - np.arccos(0.95) / np.pi) ** bits
    assert (1 - together) ** tables <= 0.001 and 2**bits >= n
