"""Near-copies among embeddings: randomised-rotation binary codes, bounds, exact recomputation."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, mix, roots, tiled, written


@dataclass(frozen=True)
class CodeRules:
    """``code_rotations`` rotations make the binary code. ``width`` spreads the confidence bound.

    ``missed``: chance that a pair at the very limit meets in no bucket. Alike pairs miss more
    rarely still: at a cosine of 0.98 by a factor of thousands. ``block`` vectors of a large
    bucket are compared with ``block`` others in one task.
    """

    cosine: float = 0.95
    code_rotations: int = 4
    width: float = 4.0
    missed: float = 0.001
    block: int = 512
    seed: int = 23


@lru_cache(maxsize=64)
def rotation(dim: int, number: int, seed: int) -> np.ndarray:
    """A random rotation, the same in every task."""
    q, r = np.linalg.qr(np.random.default_rng([seed, dim, number]).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


@lru_cache(maxsize=8)
def directions(dim: int, n: int, seed: int) -> np.ndarray:
    """``n`` directions, the columns of as many rotations as it takes."""
    return np.concatenate([rotation(dim, 1000 + k, seed) for k in range(-(-n // dim))], axis=1)[:, :n]


def tables_for(n: int, rules: CodeRules) -> tuple[int, int]:
    """Sign bits per bucket key, so that vectors without kin seldom meet, and tables to keep ``missed``."""
    bits = max(4, int(np.ceil(np.log2(max(2, n)))) + 2)
    together = (1 - np.arccos(rules.cosine) / np.pi) ** bits
    return bits, int(np.ceil(np.log(rules.missed) / np.log1p(-together)))


def bucket_keys(unit: np.ndarray, bits: int, tables: int, rules: CodeRules) -> np.ndarray:
    """A 64-bit key per vector and table: the signs of ``bits`` of its rotated coordinates."""
    signs = unit @ directions(unit.shape[1], bits * tables, rules.seed) > 0
    keys = np.zeros((len(unit), tables), dtype=np.uint64)
    for k in range(bits):
        keys = (keys << np.uint64(1)) | signs[:, k::bits].astype(np.uint64)
    return mix(keys * np.uint64(2 * tables + 1) + np.arange(tables, dtype=np.uint64) + np.uint64(unit.shape[1] << 40))


def binary_codes(unit: np.ndarray, rules: CodeRules) -> tuple[np.ndarray, np.ndarray]:
    """Packed signs of the rotated vectors, and each code's correction factor, its product with the vector."""
    dim = unit.shape[1]
    turned = np.concatenate([unit @ rotation(dim, k, rules.seed) for k in range(rules.code_rotations)], axis=1)
    factor = np.abs(turned).sum(axis=1) / (np.sqrt(dim) * rules.code_rotations)
    return np.packbits(turned > 0, axis=1), factor


def unpacked(codes: np.ndarray, dim: int, rules: CodeRules) -> np.ndarray:
    """The vectors that codes stand for, turned back: the mean over the rotations."""
    signs = np.unpackbits(codes, axis=1, count=dim * rules.code_rotations).astype(np.float64) * 2 - 1
    back = sum(signs[:, k * dim:(k + 1) * dim] @ rotation(dim, k, rules.seed).T for k in range(rules.code_rotations))
    return back / (np.sqrt(dim) * rules.code_rotations)


def least_estimate(factor: np.ndarray, coded: np.ndarray, rules: CodeRules) -> np.ndarray:
    """Estimates under this mean a cosine under the limit, by the confidence bound.

    A vector at cosine c from the coded one is c times that vector and sqrt(1 - c*c) times a
    direction at right angles to it. The estimate is c plus that part's product with the code's
    own part at right angles, which for a random rotation is spread like one coordinate of a
    vector of that length.
    """
    dim = coded.shape[1]
    across = np.sqrt(np.maximum((coded**2).sum(axis=1) - factor**2, 0)) / factor
    return rules.cosine - rules.width * np.sqrt(1 - rules.cosine**2) * across / np.sqrt(max(1, dim - 1))


# --- tables ----------------------------------------------------------------------------


def _matrix(batch: pa.RecordBatch, name: str) -> np.ndarray:
    """A binary column of float64 vectors of one length as a matrix."""
    return np.frombuffer(b"".join(batch.column(name).to_pylist()), dtype=np.float64).reshape(len(batch), -1)


def keyed_vectors(vectors: DataFrame) -> DataFrame:
    """``vec_id, k1, k2, vec``: vectors as bytes of float64 with a 128-bit key; null where they can't link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw: list[bytes | None] = []
            for x in batch.column("embedding").to_pylist():
                v = np.array([np.nan if e is None else e for e in x], dtype=np.float64) + 0.0 if x else np.zeros(0)
                raw.append(v.tobytes() if len(v) and np.isfinite(v).all() and np.abs(v).max() > 0 else None)
            keys = np.frombuffer(b"".join(xxhash.xxh3_128_digest(v or b"") for v in raw), dtype=np.int64).reshape(-1, 2)
            gone = np.array([v is None for v in raw], dtype=bool)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(keys[:, 0], mask=gone), pa.array(keys[:, 1], mask=gone), pa.array(raw, pa.binary())],
                names=["vec_id", "k1", "k2", "vec"])

    return vectors.select(F.col("vec_id").cast("long"), "embedding").mapInArrow(run, "vec_id long, k1 long, k2 long, vec binary")


def unit_rows(raw: np.ndarray) -> np.ndarray:
    """Rows at length 1; scaled first, so that very large or small ones keep their direction."""
    raw = raw / np.abs(raw).max(axis=1, keepdims=True)
    return raw / np.sqrt((raw**2).sum(axis=1, keepdims=True))


def coded(classes: DataFrame, bits: int, tables: int, rules: CodeRules) -> DataFrame:
    """``rep, n, vec, code, factor, buckets`` of each distinct vector; vectors of another length meet in no bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = np.array(pa.compute.binary_length(batch.column("vec")))
            for size in np.unique(lengths):
                part = batch.filter(pa.array(lengths == size))
                unit = unit_rows(_matrix(part, "vec"))
                codes, factor = binary_codes(unit, rules)
                keys = bucket_keys(unit, bits, tables, rules).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column("rep"), part.column("n"), part.column("vec"), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(factor),
                     pa.ListArray.from_arrays(np.arange(0, keys.size + 1, tables, dtype=np.int32), pa.array(keys.reshape(-1)))],
                    names=["rep", "n", "vec", "code", "factor", "buckets"])

    return classes.mapInArrow(run, "rep long, n long, vec binary, code binary, factor double, buckets array<long>")


# --- comparing ---------------------------------------------------------------------------


def linked_pairs(left: np.ndarray, right: np.ndarray, unit: np.ndarray, seen: np.ndarray, factor: np.ndarray,
                 least: np.ndarray, keys: np.ndarray, table: np.ndarray, cosine: float) -> np.ndarray:
    """Which of the pairs (left, right) are links that this bucket has to report.

    Estimated first; pairs whose bound reaches the limit are recomputed exactly. A pair is
    reported by the first table in which it meets.
    """
    estimate = np.einsum("ij,ij->i", seen[left], unit[right]) / factor[left]
    open_ = np.flatnonzero(estimate >= least[left])
    exact = np.einsum("ij,ij->i", unit[left[open_]], unit[right[open_]])
    open_ = open_[exact >= cosine]
    same = keys[left[open_]] == keys[right[open_]]
    out = np.zeros(len(left), dtype=bool)
    out[open_] = same.argmax(axis=1) == table[left[open_]]
    return out


def compare(batches: Iterator[pa.RecordBatch], bits: int, tables: int, rules: CodeRules) -> Iterator[pa.RecordBatch]:
    """Links inside runs of rows with one ``bucket`` and ``tile``, as ``id, links, root``.

    ``links`` counts linked vectors, copies included; ``root`` is an id joined to ``id`` by links.
    Rows come in order, so only the run at hand is kept: at most two blocks of vectors.
    """
    rest: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        rest = table if rest is None else pa.concat_tables([rest, table])
        key = np.stack([rest["bucket"].to_numpy(), rest["tile"].to_numpy()])
        last = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0))
        if len(last) and (len(rest) >= 2048 or last[-1] > 4 * rules.block):
            yield from _compare_runs(rest.slice(0, last[-1] + 1), bits, tables, rules)
            rest = rest.slice(last[-1] + 1)
    if rest is not None and len(rest):
        yield from _compare_runs(rest, bits, tables, rules)


def _compare_runs(rows: pa.Table, bits: int, tables: int, rules: CodeRules) -> Iterator[pa.RecordBatch]:
    bucket, tile, side = (rows[c].to_numpy() for c in ("bucket", "tile", "side"))
    sizes = np.array(pa.compute.binary_length(rows["vec"].combine_chunks()))
    ids, copies = rows["rep"].to_numpy(), rows["n"].to_numpy()
    begins = np.flatnonzero(np.concatenate(([True], (bucket[1:] != bucket[:-1]) | (tile[1:] != tile[:-1]))))
    ends = np.append(begins[1:], len(bucket))
    out_id, out_links, out_root = [], [], []
    # Runs of one vector length, a bounded number of vectors at a time.
    start = 0
    while start < len(begins):
        stop = start + 1
        while stop < len(begins) and sizes[begins[stop]] == sizes[begins[start]] and ends[stop] - begins[start] <= 4096:
            stop += 1
        lo, hi = begins[start], ends[stop - 1]
        part = rows.slice(lo, hi - lo)
        unit = unit_rows(np.frombuffer(b"".join(part["vec"].to_pylist()), dtype=np.float64).reshape(hi - lo, -1))
        codes = np.frombuffer(b"".join(part["code"].to_pylist()), dtype=np.uint8).reshape(hi - lo, -1)
        factor, seen = part["factor"].to_numpy(), unpacked(codes, unit.shape[1], rules)
        least = least_estimate(factor, seen, rules)
        keys = bucket_keys(unit, bits, tables, rules).view(np.int64)
        table = (keys == bucket[lo:hi, None]).argmax(axis=1)
        links, a_all, b_all = np.zeros(hi - lo, dtype=np.int64), [], []
        run = np.repeat(np.arange(start, stop), ends[start:stop] - begins[start:stop])
        # Each row against all behind it in its run, some hundred thousand pairs at a time.
        partners = ends[run] - np.arange(lo, hi) - 1
        done = 0
        while done < hi - lo:
            to = done + max(1, int(np.searchsorted(np.cumsum(partners[done:]), 250_000, side="right")))
            left = np.repeat(np.arange(done, to), partners[done:to])
            right = left + 1 + np.arange(len(left)) - np.repeat(np.cumsum(partners[done:to]) - partners[done:to], partners[done:to])
            # In a tile of two blocks only pairs across them; side is 0 and 1 there, and 2 where a block meets itself.
            meet = (side[lo + left] == 2) | (side[lo + left] != side[lo + right])
            left, right = left[meet], right[meet]
            hit = linked_pairs(left, right, unit, seen, factor, least, keys, table, rules.cosine)
            a, b = left[hit], right[hit]
            np.add.at(links, a, copies[lo + b])
            np.add.at(links, b, copies[lo + a])
            a_all.append(a)
            b_all.append(b)
            done = to
        a, b = np.concatenate(a_all), np.concatenate(b_all)
        if len(a):
            mine = np.unique(np.concatenate((a, b)))
            root = roots(hi - lo, a, b)
            out_id.append(ids[lo + mine])
            out_links.append(links[mine])
            out_root.append(ids[lo + root[mine]])
        start = stop
    if out_id:
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (out_id, out_links, out_root)], names=["id", "links", "root"])


def near_vectors(vectors: DataFrame, rules: CodeRules = CodeRules()) -> DataFrame:  # noqa: B008
    """``vec_id, n_links, component_id, kept``, a row per row of ``vectors(vec_id, embedding)``.

    Vectors that are null, empty, zero, or hold null or non-finite components link with nothing;
    vectors of different lengths neither. Equal vectors are compared once and counted as often as
    they occur. Large buckets are cut into blocks, and each pair of blocks is a task of its own.
    Repeated rows count as vectors of their own. Other columns are not read.
    """
    spark = vectors.sparkSession
    keyed = written(keyed_vectors(vectors), "vec-keyed")
    usable = keyed.filter("vec is not null")
    classes = written(usable.groupBy("k1", "k2").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n"), F.first("vec").alias("vec")), "vec-classes")
    bits, tables = tables_for(classes.count(), rules)
    code_table = written(coded(classes.filter("rep is not null").select("rep", "n", "vec"), bits, tables, rules), "vec-codes")
    members = code_table.select("rep", F.explode("buckets").alias("bucket"))
    full = written(members.groupBy("bucket").agg(F.count("*").alias("size")).filter("size > 1"), "vec-buckets")
    met = written(members.join(full, "bucket").select("bucket", "rep", "size"), "vec-members")
    dealt = tiled(met, "bucket", "rep", "size", rules.block)
    rows = dealt.join(code_table.drop("buckets"), "rep").select("bucket", "tile", "side", "rep", "n", "vec", "code", "factor")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = written(rows.repartition(parts, "bucket", "tile").sortWithinPartitions("bucket", "tile", "side", "rep").mapInArrow(
        lambda it: compare(it, bits, tables, rules), "id long, links long, root long"), "vec-links")
    owner = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    totals = found.groupBy(F.col("id").alias("lid")).agg(F.sum("links").alias("links"))
    per_class = (classes.join(owner, classes.rep == owner.id, "left").join(totals, classes.rep == totals.lid, "left")
                 .select(F.col("k1").alias("c1"), F.col("k2").alias("c2"), F.coalesce("component_id", "rep").alias("component"),
                         (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links")))
    per_class = written(per_class, "vec-owners")
    out = keyed.join(per_class, (F.col("k1") == F.col("c1")) & (F.col("k2") == F.col("c2")), "left")
    component = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      component.eqNullSafe(F.col("vec_id")).alias("kept"))
