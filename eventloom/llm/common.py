"""Helpers the operators share: text buffers, hashes, written tables, connected components."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text bytes worked on at a time inside a task. Longer texts are worked on alone.
SLICE_BYTES = 2 << 20


# --- written tables ----------------------------------------------------------------


def work_dir(spark: SparkSession) -> str:
    """The shared folder in ``spark.checkpoint.dir``; one of our own only in local sessions that set none."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="eventloom-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def new_dir(spark: SparkSession, purpose: str) -> str:
    """A new path in the shared folder; what is written there goes when the session ends."""
    path = f"{work_dir(spark)}/{purpose}-{uuid.uuid4().hex}"
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(jvm_path)
    return path


def written(df: DataFrame, purpose: str, **options: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors.

    The files go when the session ends.
    """
    spark = df.sparkSession
    path = new_dir(spark, purpose)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, with as many underscores in front as it takes to clash with no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out


def with_row_key(docs: DataFrame, name: str) -> DataFrame:
    """Add a long that tells documents apart: ``doc_id`` where it stands for one text, else a hash of id and text.

    The hash is for null ids, and for all but one text of an id that has several. It is above 2 ** 62, so
    that such rows come after the others. Rows with the same id and text get one key. Ids that have
    several texts are written first: the planner then knows their size, and while it is small it
    moves no text for their join.
    """
    doc_id, text = F.col("doc_id").cast("long"), F.xxhash64("text")
    odd = docs.filter("doc_id is not null").groupBy(doc_id.alias("_odd")).agg(F.min(text).alias("_low"), F.max(text).alias("_high"))
    odd = written(odd.filter("_low <> _high").drop("_high"), "odd-ids")
    odd_id, low = fresh(docs, "_odd", "_low")
    odd = odd.select(F.col("_odd").alias(odd_id), F.col("_low").alias(low))
    own = doc_id.isNotNull() & (F.col(low).isNull() | (F.col(low) == text))
    hashed = F.xxhash64("doc_id", "text").bitwiseAND(F.lit((1 << 62) - 1)).bitwiseOR(F.lit(1 << 62))
    return docs.join(odd, doc_id == F.col(odd_id), "left").withColumn(name, F.when(own, doc_id).otherwise(hashed)).drop(odd_id, low)


def parts_for(spark: SparkSession, rows: int, per_part: int) -> int:
    """Partitions so that each gets about ``per_part`` rows, and no fewer than the session's own number."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // per_part))


def on_workers(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, if they can't already."""
    home = str(Path(__file__).resolve().parents[2])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if home not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([home, *filter(None, paths)])


# --- texts as buffers ----------------------------------------------------------------


def text_slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of a string array with about ``limit`` bytes of text each, one row at least."""
    sizes = np.array(pa.compute.binary_length(texts).fill_null(0), dtype=np.int64)
    ends, start = np.cumsum(sizes), 0
    while start < len(sizes):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield start, stop
        start = stop


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All texts in one byte array, a newline after each, and where each text begins (one more at the end)."""
    starts = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=starts[1:])
    return np.frombuffer(b"\n".join([*texts, b""]), dtype=np.uint8), starts


def word_spans(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of every run of bytes other than space and 0x09-0x0D."""
    blank = (buf == 32) | ((buf >= 9) & (buf <= 13))
    edge = np.flatnonzero(np.diff(np.concatenate(([True], blank, [True])).view(np.int8)))
    return edge[::2], edge[1::2]


# --- hashes --------------------------------------------------------------------------

_BASE = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.ones(1, dtype=np.uint64)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_INVERSES = np.ones(1, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Scatter 64-bit values: a bijection, so different values stay different."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse, 0 to n - 1."""
    global _POWERS, _INVERSES
    if len(_POWERS) < n:
        size = max(n, 2 * len(_POWERS))
        table = np.full(size, _BASE, dtype=np.uint64)
        table[0] = 1
        _POWERS = np.multiply.accumulate(table)
        table = np.full(size, _INVERSE, dtype=np.uint64)
        table[0] = 1
        _INVERSES = np.multiply.accumulate(table)
    return _POWERS, _INVERSES


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the values in each span, the same wherever the span stands.

    Works through long buffers in pieces that end between spans, so memory stays bounded.
    """
    out = np.empty(len(starts), dtype=np.uint64)
    done = 0
    while done < len(starts):
        base = starts[done]
        stop = max(done + 1, int(np.searchsorted(ends, base + SLICE_BYTES, side="right")))
        piece = buf[base:ends[stop - 1]]
        up, down = powers(len(piece) + 1)
        total = np.zeros(len(piece) + 1, dtype=np.uint64)
        np.cumsum((piece.astype(np.uint64) + np.uint64(1)) * up[:len(piece)], out=total[1:])
        at, to = starts[done:stop] - base, ends[done:stop] - base
        out[done:stop] = mix((total[to] - total[at]) * down[at] + (to - at).astype(np.uint64))
        done = stop
    return out


def owners(starts: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The text that each buffer position in ``at`` belongs to."""
    return np.searchsorted(starts, at, side="right") - 1


# --- groups in tiles -------------------------------------------------------------------


def tiled(members: DataFrame, group: str, member: str, size: str, block: int) -> DataFrame:
    """Deal the members of a group out to tiles so that every two of them meet in one.

    A group is cut into blocks of about ``block`` members by a hash, and each pair of blocks
    is a tile. ``size`` is the column with the group's number of members. Adds ``tile`` and
    ``side``: 0 and 1 in a tile of two blocks, whose members meet only across, 2 in a tile of one.
    """
    blocks = F.ceil(F.col(size) / block).cast("int")
    low, high = F.least("_mine", "_other"), F.greatest("_mine", "_other")
    dealt = members.withColumns({"_blocks": blocks, "_mine": F.pmod(F.xxhash64(group, member), blocks).cast("int")})
    each = dealt.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    side = F.when(F.col("_mine") == F.col("_other"), 2).when(F.col("_mine") < F.col("_other"), 0).otherwise(1)
    return each.withColumns({"tile": low.cast("long") * F.col("_blocks") + high, "side": side.cast("int")}).drop("_blocks", "_mine", "_other")


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Rows with equal ``keys``, a table per run; the rows come in order of the keys."""
    rest: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not len(batch):
            continue
        columns = [batch.column(k).to_numpy() for k in keys]
        cuts = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
        bounds = [0, *cuts.tolist(), len(batch)]
        for start, stop in zip(bounds, bounds[1:], strict=False):
            key = tuple(c[start] for c in columns)
            if rest and key != last:
                yield pa.Table.from_batches(rest)
                rest = []
            rest.append(batch.slice(start, stop - start))
            last = key
    if rest:
        yield pa.Table.from_batches(rest)


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest reachable number per number 0..n-1, for the links a-b."""
    root = np.arange(n)
    while True:
        before = root.copy()
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        root = root[root]
        if (root == before).all():
            return root


# --- connected components --------------------------------------------------------------


def _is_star(links: DataFrame) -> bool:
    """Whether every node has one smaller neighbour, which has none itself."""
    twice = links.groupBy("u").agg(F.count("*").alias("n")).filter("n > 1").limit(1)
    if twice.count():
        return False
    inner = links.select(F.col("v").alias("k")).distinct().join(links, F.col("k") == links.u, "left_semi").limit(1)
    return not inner.count()


def components(edges: DataFrame, purpose: str = "components") -> DataFrame:
    """Smallest reachable id per node: ``edges(a, b)`` to ``(id, component_id)`` for each node of an edge.

    Alternates two star steps until only stars are left: every node links its larger
    neighbours to the smallest one near it, then its smaller ones. A node keeps a minimum,
    never a list of neighbours. Each join reads two written tables, so that adaptive
    execution can split a node with very many links. An empty input gives an empty result.
    """
    links = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                    .filter("u <> v").distinct(), purpose)
    while not _is_star(links):
        both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        near = written(both.groupBy("u").agg(F.min("v").alias("m")).select(
            F.col("u").alias("k"), F.least("u", "m").alias("m")), purpose)
        large = written(both.join(near, both.u == near.k).filter("v > u").select(
            F.col("v").alias("u"), F.col("m").alias("v")).distinct(), purpose)
        near = written(large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "k"), purpose)
        small = large.join(near, large.u == near.k).filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = written(small.union(near.select(F.col("k").alias("u"), F.col("m").alias("v"))).distinct(), purpose)
    roots = links.select(F.col("v").alias("id")).distinct()
    return (links.select(F.col("u").alias("id"), F.col("v").alias("component_id"))
            .union(roots.select("id", F.col("id").alias("component_id"))))
