"""Line dedup: exact reference counts of long lines, with sharded cuckoo filters in front."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, mix, written

_STRIP = " \t\n\x0b\x0c\r"
#: Frequent keys that one filter shard is planned for, and the least number of shards.
SHARD_KEYS, LEAST_SHARDS = 4096, 16
#: Tasks that the lines of one shard are dealt to, so that a very frequent line is no hot spot.
SALTS = 16
_SLOTS = 4


@dataclass(frozen=True)
class LineRules:
    """A key of ``min_chars`` code points or more in ``min_docs`` documents or more is frequent."""

    min_chars: int = 40
    min_docs: int = 5


# --- cuckoo filter -------------------------------------------------------------------


class Full(Exception):
    """No place was found for a fingerprint; the filter must be built anew with more buckets."""


class CuckooFilter:
    """Fingerprints of 16 bits in buckets of four; keys are 64-bit hashes.

    A key that was added is always found until it is removed. The second bucket follows from
    the first and the fingerprint, so that a removal needs nothing else.
    """

    def __init__(self, table: np.ndarray):
        self.table = table

    @classmethod
    def sized(cls, n_keys: int) -> CuckooFilter:
        buckets = 1 << max(2, int(np.ceil(np.log2(max(1, n_keys) / (_SLOTS * 0.8)))))
        return cls(np.zeros((buckets, _SLOTS), dtype=np.uint16))

    @classmethod
    def of(cls, keys: np.ndarray) -> CuckooFilter:
        made = cls.sized(len(keys))
        while True:
            try:
                made.add(keys)
                return made
            except Full:
                made = cls(np.zeros((2 * len(made.table), _SLOTS), dtype=np.uint16))

    @classmethod
    def from_bytes(cls, data: bytes) -> CuckooFilter:
        return cls(np.frombuffer(data, dtype=np.uint16).reshape(-1, _SLOTS).copy())

    def to_bytes(self) -> bytes:
        return self.table.tobytes()

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        mask = np.uint64(len(self.table) - 1)
        keys = mix(keys.astype(np.uint64))
        prints = (keys >> np.uint64(48)).astype(np.uint16)
        prints[prints == 0] = 1
        first = keys & mask
        return prints, first.astype(np.int64), (first ^ (mix(prints.astype(np.uint64)) & mask)).astype(np.int64)

    def contains(self, keys: np.ndarray) -> np.ndarray:
        prints, first, second = self._places(keys)
        same = (self.table[first] == prints[:, None]) | (self.table[second] == prints[:, None])
        return same.any(axis=1)

    def add(self, keys: np.ndarray) -> None:
        mask = len(self.table) - 1
        for tag, a, b in zip(*(x.tolist() for x in self._places(keys)), strict=True):
            at, turn = a, 0
            for bucket in (a, b):
                free = np.flatnonzero(self.table[bucket] == 0)
                if len(free):
                    self.table[bucket, free[0]] = tag
                    break
            else:
                at = b
                for turn in range(500):
                    slot = turn % _SLOTS
                    tag, self.table[at, slot] = int(self.table[at, slot]), tag
                    at ^= int(mix(np.array([tag], dtype=np.uint64))[0]) & mask
                    free = np.flatnonzero(self.table[at] == 0)
                    if len(free):
                        self.table[at, free[0]] = tag
                        break
                else:
                    raise Full

    def remove(self, keys: np.ndarray) -> None:
        """Take out keys that were added; others must not be given."""
        for tag, a, b in zip(*(x.tolist() for x in self._places(keys)), strict=True):
            for bucket in (a, b):
                held = np.flatnonzero(self.table[bucket] == tag)
                if len(held):
                    self.table[bucket, held[0]] = 0
                    break


# --- keys ----------------------------------------------------------------------------


def line_key(line: str, min_chars: int) -> bytes | None:
    """128-bit key of a line as two 64-bit halves, or None for a short line."""
    line = line.strip(_STRIP)
    return xxhash.xxh3_128_digest(line.encode().lower()) if len(line) >= min_chars else None


def postings_of(docs: DataFrame, rules: LineRules) -> DataFrame:
    """``(doc_id, k1, k2)``: the distinct long keys of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, keys = [], []
            for row, text in enumerate(batch.column("text").to_pylist()):
                if text and len(text) >= rules.min_chars:
                    found = {line_key(x, rules.min_chars) for x in text.split("\n") if len(x) >= rules.min_chars}
                    found.discard(None)
                    keys.extend(sorted(found))
                    rows.extend([row] * len(found))
            halves = np.frombuffer(b"".join(keys), dtype=np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(halves[:, 0]), pa.array(halves[:, 1])],
                names=["doc_id", "k1", "k2"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, k1 long, k2 long")


def _counts(postings: DataFrame) -> DataFrame:
    ids = F.coalesce("doc_id", F.lit(-(1 << 63)))
    return postings.groupBy("k1", "k2").agg(F.count_distinct(ids).alias("n_docs"), F.max(ids).alias("last_doc"))


# --- index ---------------------------------------------------------------------------


@dataclass(frozen=True)
class LineIndex:
    """State of the line dedup, all of it in tables.

    ``postings(doc_id, k1, k2)``, the exact table ``counts(k1, k2, n_docs, last_doc)`` and
    ``filters(shard, filter)``, one cuckoo filter of the frequent keys per shard.
    """

    postings: DataFrame
    counts: DataFrame
    filters: DataFrame
    shards: int
    rules: LineRules

    def frequent(self) -> DataFrame:
        return self.counts.filter(F.col("n_docs") >= self.rules.min_docs)


def _shard(shards: int) -> F.Column:
    return F.pmod(F.col("k2"), F.lit(shards)).cast("int")


def build_index(docs: DataFrame, rules: LineRules = LineRules()) -> LineIndex:  # noqa: B008
    """Index all documents; they are told apart by ``doc_id``, and a null id is the smallest."""
    postings = written(postings_of(docs, rules), "line-postings")
    counts = written(_counts(postings), "line-counts")
    frequent = counts.filter(F.col("n_docs") >= rules.min_docs)
    shards = max(LEAST_SHARDS, -(-frequent.count() // SHARD_KEYS))

    def make(shard: pa.Table) -> pa.Table:
        made = CuckooFilter.of(shard["k1"].to_numpy().view(np.uint64))
        return pa.table({"shard": shard["shard"].slice(0, 1).cast(pa.int32()), "filter": pa.array([made.to_bytes()], pa.binary())})

    filters = frequent.select(_shard(shards).alias("shard"), "k1").groupBy("shard").applyInArrow(make, "shard int, filter binary")
    return LineIndex(postings, counts, written(filters, "line-filters"), shards, rules)


def _changed_filters(index: LineIndex, counts: DataFrame) -> DataFrame:
    """Filters after ``counts`` takes the place of the index's own: fingerprints come and go."""
    limit = index.rules.min_docs
    old = index.counts.select("k1", "k2", F.col("n_docs").alias("before"))
    change = (counts.select("k1", "k2", F.col("n_docs").alias("after")).join(old, ["k1", "k2"], "full_outer")
              .select(_shard(index.shards).alias("shard"), "k1", (F.coalesce("after", F.lit(0)) >= limit).alias("now"),
                      (F.coalesce("before", F.lit(0)) >= limit).alias("was")).filter("now or was"))

    def update(filters: pa.Table, keys: pa.Table) -> pa.Table:
        now, was = (np.array(keys[c].to_pylist(), dtype=bool) for c in ("now", "was"))
        hashes = keys["k1"].to_numpy().view(np.uint64)
        try:
            made = CuckooFilter.from_bytes(filters["filter"][0].as_py()) if len(filters) else CuckooFilter.of(hashes[was])
            made.remove(hashes[was & ~now])
            made.add(hashes[now & ~was])
        except Full:
            made = CuckooFilter.of(hashes[now])
        shard = (keys if len(keys) else filters)["shard"].slice(0, 1).cast(pa.int32())
        return pa.table({"shard": shard, "filter": pa.array([made.to_bytes()], pa.binary())})

    return index.filters.groupBy("shard").cogroup(change.groupBy("shard")).applyInArrow(update, "shard int, filter binary")


def insert_documents(index: LineIndex, docs: DataFrame) -> LineIndex:
    """The index with more documents, whose ids must be new."""
    more = written(postings_of(docs, index.rules), "line-postings")
    merged = (index.counts.union(_counts(more)).groupBy("k1", "k2")
              .agg(F.sum("n_docs").alias("n_docs"), F.max("last_doc").alias("last_doc")))
    counts = written(merged, "line-counts")
    return replace(index, postings=index.postings.union(more), counts=counts,
                   filters=written(_changed_filters(index, counts), "line-filters"))


def delete_documents(index: LineIndex, doc_ids: DataFrame) -> LineIndex:
    """The index as if the documents in ``doc_ids(doc_id)`` had never been added.

    Only keys that those documents hold are counted anew.
    """
    gone = doc_ids.select("doc_id").distinct()
    kept = written(index.postings.join(gone, "doc_id", "left_anti"), "line-postings")
    touched = written(index.postings.join(gone, "doc_id", "left_semi").select("k1", "k2").distinct(), "line-touched")
    recounted = _counts(kept.join(touched, ["k1", "k2"], "left_semi"))
    counts = written(index.counts.join(touched, ["k1", "k2"], "left_anti").union(recounted), "line-counts")
    return replace(index, postings=kept, counts=counts, filters=written(_changed_filters(index, counts), "line-filters"))


# --- dropping ------------------------------------------------------------------------


def dropped_keys(index: LineIndex) -> DataFrame:
    """``(doc_id, k1, k2)``: keys that the documents of the index lose.

    The lines of a shard meet its filter, dealt out over ``SALTS`` tasks; what passes is
    joined to the exact table, so that a false positive of a filter drops nothing.
    """
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    nothing = F.lit(None).cast("long")
    filters = index.filters.select("shard", salts.alias("salt"), F.lit(0).alias("kind"), "filter",
                                   nothing.alias("doc_id"), nothing.alias("k1"), nothing.alias("k2"))
    lines = index.postings.select(
        _shard(index.shards).alias("shard"), F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int").alias("salt"),
        F.lit(1).alias("kind"), F.lit(None).cast("binary").alias("filter"), "doc_id", "k1", "k2")

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, None
        for batch in batches:
            batch = batch.select(["shard", "filter", "doc_id", "k1", "k2"])
            shards = batch.column("shard").to_numpy()
            heads = np.flatnonzero(np.array(batch.column("filter").is_valid()))
            cuts = np.unique(np.concatenate(([0], heads, np.flatnonzero(np.diff(shards)) + 1, [len(shards)])))
            is_head = set(heads.tolist())
            for start, stop in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                if start in is_head:
                    at, held = shards[start], CuckooFilter.from_bytes(batch.column("filter")[start].as_py())
                    start += 1
                if held is None or at != shards[stop - 1] or start == stop:
                    continue
                part = batch.slice(start, stop - start).select(["doc_id", "k1", "k2"])
                yield part.filter(pa.array(held.contains(part.column("k1").to_numpy().view(np.uint64))))

    parts = max(int(index.postings.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    positive = (filters.union(lines).repartition(parts, "shard", "salt").sortWithinPartitions("shard", "salt", "kind")
                .mapInArrow(probe, "doc_id long, k1 long, k2 long"))
    exact = index.frequent().select("k1", "k2", "last_doc")
    return positive.join(exact, ["k1", "k2"]).filter(
        F.coalesce("doc_id", F.lit(-(1 << 63))) != F.col("last_doc")).select("doc_id", "k1", "k2")


def with_kept_text(docs: DataFrame, index: LineIndex) -> DataFrame:
    """``docs`` with ``text`` cut to the kept lines, and a last column, ``struct<n_lines, n_dropped>``.

    Documents whose lines all go have an empty text.
    """
    doc_name, keys_name, last = fresh(docs, "_doc", "_keys", "_lines")
    drops = dropped_keys(index).groupBy(F.col("doc_id").alias(doc_name)).agg(
        F.collect_set(F.struct("k1", "k2")).alias(keys_name))
    joined = docs.join(drops, docs.doc_id.eqNullSafe(F.col(doc_name)), "left").select(*docs.columns, keys_name)
    names, min_chars = docs.columns, index.rules.min_chars
    where = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, counts, drops_of = [], [], batch.column(keys_name).to_pylist()
            for text, keys in zip(batch.column(where).to_pylist(), drops_of, strict=True):
                n_lines = (text or "").count("\n") + 1
                n_dropped = 0
                if keys:
                    gone = {np.array([k["k1"], k["k2"]], dtype=np.int64).tobytes() for k in keys}
                    kept = [x for x in text.split("\n") if len(x) < min_chars or line_key(x, min_chars) not in gone]
                    n_dropped, text = n_lines - len(kept), "\n".join(kept)
                texts.append(text)
                counts.append({"n_lines": n_lines, "n_dropped": n_dropped})
            columns = list(batch.columns[:-1])
            columns[where] = pa.array(texts, pa.string())
            columns.append(pa.array(counts, pa.struct([("n_lines", pa.int64()), ("n_dropped", pa.int64())])))
            yield pa.RecordBatch.from_arrays(columns, names=[*names, last])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return joined.mapInArrow(run, f"{kinds}, {last} struct<n_lines: bigint, n_dropped: bigint>")


def dedup_lines(docs: DataFrame, rules: LineRules = LineRules()) -> DataFrame:  # noqa: B008
    """``(doc_id, n_lines, n_dropped, kept_text)``, a row per document.

    Null and empty texts are one empty line; a null text stays null. Repeated rows of one
    ``doc_id`` count as one document and lose the same lines. Other columns are not read.
    """
    wanted = docs.select("doc_id", "text")
    out = with_kept_text(wanted, build_index(wanted, rules))
    return out.select("doc_id", F.col("_lines.n_lines").alias("n_lines"), F.col("_lines.n_dropped").alias("n_dropped"),
                      F.col("text").alias("kept_text"))


def dedup_filter(docs: DataFrame, rules: LineRules = LineRules()) -> DataFrame:  # noqa: B008
    """The documents with repeated lines taken out of ``text``; ``n_chars``, where there is one, follows."""
    out = with_kept_text(docs, build_index(docs, rules)).select(*docs.columns)
    if "n_chars" in out.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out
