"""MinHash near-dedup with b-bit signatures: bands find candidates, bit counts screen them, full sets decide."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import (
    components, fresh, joined, mix, owners, roots, runs, span_hashes, text_slices, tiled, with_row_key, word_spans, written,
)


@dataclass(frozen=True)
class NearRules:
    """``bands * rows`` minima per document; ``bits`` low bits of each are kept in the signature.

    A pair of similarity 0.75 shares no band of 4 minima in one of 200,000 cases, more alike
    pairs still less. ``margin``: how far under ``percent`` an estimate may lie before the pair
    is given up unread, five times the estimate's standard error.
    """

    words: int = 5
    percent: int = 75
    bands: int = 32
    rows: int = 4
    bits: int = 4
    margin: float = 0.20
    seed: int = 11
    #: Tasks that the pairs of one pivot are dealt to.
    salts: int = 64
    #: Members of a bucket, and texts of a cluster, that one task compares with as many others.
    bucket_block: int = 512
    cluster_block: int = 128

    @property
    def minima(self) -> int:
        return self.bands * self.rows


# --- shingles ------------------------------------------------------------------------


def shingle_sets(texts: list[bytes], words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingle hashes of many texts: (hashes ordered by text, text of each, word hashes, text of each word)."""
    buf, starts = joined([t.lower() for t in texts])
    at, to = word_spans(buf)
    word_hash, word_owner = span_hashes(buf, at, to), owners(starts, at)
    counts = np.bincount(word_owner, minlength=len(texts))
    first = np.flatnonzero(np.concatenate(([True], word_owner[1:] != word_owner[:-1]))) if len(at) else at
    # A shingle begins at each word that has enough words after it, or at the first word of a short text.
    place = np.arange(len(at)) - np.repeat(first, counts[counts > 0])
    length = np.minimum(counts[word_owner], words)
    begins = np.flatnonzero((place + length <= counts[word_owner]) & ((counts[word_owner] >= words) | (place == 0)))
    size = length[begins]
    shingle = size.astype(np.uint64)
    for k in range(words):
        inside = size > k
        shingle[inside] = mix(shingle[inside] + word_hash[begins[inside] + k])
    owner = word_owner[begins]
    order = np.lexsort((shingle, owner))
    shingle, owner = shingle[order], owner[order]
    fresh = np.ones(len(order), dtype=bool)
    fresh[1:] = (shingle[1:] != shingle[:-1]) | (owner[1:] != owner[:-1])
    return shingle[fresh], owner[fresh], word_hash, word_owner


def _sums(values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Sum of 64-bit values per text, modulo 2**64; owners come in order."""
    total = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values, out=total[1:])
    ends = np.searchsorted(owner, np.arange(n + 1))
    return total[ends[1:]] - total[ends[:-1]]


def signatures(texts: list[bytes], rules: NearRules) -> dict[str, np.ndarray]:
    """Per text: set size, 128-bit key of its word sequence, packed b-bit signature, band keys."""
    n = len(texts)
    shingle, owner, word_hash, word_owner = shingle_sets(texts, rules.words)
    sizes = np.bincount(owner, minlength=n)
    place = np.arange(len(word_hash), dtype=np.uint64) - np.searchsorted(word_owner, np.arange(n)).astype(np.uint64)[word_owner]
    keys = [_sums(mix(word_hash + mix(place + np.uint64(salt))), word_owner, n) for salt in (1 << 40, 1 << 50)]
    full = np.flatnonzero(sizes)
    minima = np.zeros((n, rules.minima), dtype=np.uint64)
    if len(full):
        begins = np.searchsorted(owner, full)
        factors = mix(np.arange(rules.seed, rules.seed + 2 * rules.minima, dtype=np.uint64) << np.uint64(20))
        for k in range(rules.minima):
            minima[full, k] = np.minimum.reduceat((shingle ^ factors[2 * k]) * (factors[2 * k + 1] | np.uint64(1)), begins)
    scattered = mix(minima)
    low = scattered & np.uint64((1 << rules.bits) - 1)
    per_word = 64 // rules.bits
    shifts = (np.arange(per_word, dtype=np.uint64) * np.uint64(rules.bits))
    packed = np.bitwise_or.reduce(low.reshape(n, -1, per_word) << shifts, axis=2)
    bands = np.zeros((n, rules.bands), dtype=np.uint64)
    for k in range(rules.rows):
        bands = mix(bands + scattered.reshape(n, rules.bands, rules.rows)[:, :, k])
    bands = mix(bands + np.arange(rules.bands, dtype=np.uint64))
    return {"n_shingles": sizes, "k1": keys[0], "k2": keys[1], "signature": packed, "bands": bands}


def _raw(texts: pa.Array) -> list[bytes]:
    return [(t or "").encode() for t in texts.to_pylist()]


def signed(docs: DataFrame, rules: NearRules) -> DataFrame:
    """``doc_id, n_shingles, k1, k2, signature array<long>, bands array<long>`` of every document."""

    def lists(values: np.ndarray) -> pa.Array:
        return pa.ListArray.from_arrays(np.arange(0, values.size + 1, values.shape[1], dtype=np.int32),
                                        pa.array(values.reshape(-1).view(np.int64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in text_slices(batch.column("text")):
                part = batch.slice(start, stop - start)
                made = signatures(_raw(part.column("text")), rules)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(made["n_shingles"], pa.int64()), pa.array(made["k1"].view(np.int64)),
                     pa.array(made["k2"].view(np.int64)), lists(made["signature"]), lists(made["bands"])],
                    names=["doc_id", "n_shingles", "k1", "k2", "signature", "bands"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, n_shingles long, k1 long, k2 long, signature array<long>, bands array<long>")


# --- candidates ------------------------------------------------------------------------


def estimated(left: Column, right: Column, rules: NearRules) -> Column:
    """Similarity estimated from two packed signatures by counting bits, chance collisions taken out."""
    ones = sum(1 << k for k in range(0, 64, rules.bits))
    ones = ones - (1 << 64) if ones >= 1 << 63 else ones

    def unequal(a: Column, b: Column) -> Column:
        bits = a.bitwiseXOR(b)
        for k in range(1, rules.bits):
            bits = bits.bitwiseOR(F.shiftrightunsigned(a.bitwiseXOR(b), k))
        return F.bit_count(bits.bitwiseAND(F.lit(ones)))

    differ = F.aggregate(F.zip_with(left, right, unequal), F.lit(0), lambda n, x: n + x)
    chance = 2.0 ** -rules.bits
    return ((1 - differ / rules.minima) - chance) / (1 - chance)


def _alike(pairs: DataFrame, sets: DataFrame, rules: NearRules) -> DataFrame:
    """The pairs ``(a, b)`` whose estimate is not clearly under the limit."""
    left = sets.select(F.col("rep").alias("a"), F.col("signature").alias("sa"))
    right = sets.select(F.col("rep").alias("b"), F.col("signature").alias("sb"))
    return pairs.join(left, "a").join(right, "b").filter(
        estimated(F.col("sa"), F.col("sb"), rules) >= rules.percent / 100 - rules.margin).select("a", "b")


def confirmed(pairs: DataFrame, texts: DataFrame, rules: NearRules) -> DataFrame:
    """The pairs ``(a, b)`` whose full shingle sets meet the limit; ``texts(rep, text)``.

    The pairs of one a are dealt over ``salts`` tasks. In each, the text of a comes first and
    those of its partners stream past it.
    """
    dealt = pairs.select("a", F.pmod(F.xxhash64("b"), F.lit(rules.salts)).cast("int").alias("salt"), "b")
    wanted = dealt.select("a", "salt", F.lit(0).alias("kind"), F.col("a").alias("id")).distinct().union(
        dealt.select("a", "salt", F.lit(1), "b"))
    rows = wanted.join(texts, wanted.id == texts.rep).select("a", "salt", "kind", "id", "text")
    parts = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, held = None, np.zeros(0, dtype=np.uint64)
        for batch in batches:
            for start, stop in text_slices(batch.column("text")):
                part = batch.slice(start, stop - start)
                sets, owner, _, _ = shingle_sets(_raw(part.column("text")), rules.words)
                cuts = np.searchsorted(owner, np.arange(len(part) + 1))
                out_a, out_b = [], []
                rows = zip(*(part.column(c).to_pylist() for c in ("a", "salt", "kind", "id")), strict=True)
                for k, (a, salt, kind, b) in enumerate(rows):
                    mine = sets[cuts[k]:cuts[k + 1]]
                    if kind == 0:
                        head, held = (a, salt), mine
                    elif head == (a, salt):
                        both = len(np.intersect1d(held, mine, assume_unique=True))
                        if 100 * both >= rules.percent * (len(held) + len(mine) - both):
                            out_a.append(a)
                            out_b.append(b)
                yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())], names=["a", "b"])

    return (rows.repartition(parts, "a", "salt").sortWithinPartitions("a", "salt", "kind", "id")
            .mapInArrow(run, "a long, b long"))


# --- what is left between components -----------------------------------------------------


def _pairs_across(table: pa.Table, rules: NearRules) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a tile's rows that may be alike and lie in different components."""
    signs = np.array(table["signature"].to_pylist(), dtype=np.int64).view(np.uint64)
    owner, side = table["component"].to_numpy(), table["side"].to_numpy()
    left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
    ones = np.uint64(sum(1 << k for k in range(0, 64, rules.bits)))
    found_a, found_b = [], []
    most = (1 - (rules.percent / 100 - rules.margin) * (1 - 2.0**-rules.bits) - 2.0**-rules.bits) * rules.minima
    for a in left.tolist():
        others = right[(owner[right] != owner[a]) & ((side[right] != 2) | (right > a))]
        bits = signs[others] ^ signs[a]
        spread = bits
        for k in range(1, rules.bits):
            spread = spread | (bits >> np.uint64(k))
        hit = others[np.bitwise_count(spread & ones).sum(axis=1) <= most]
        found_a.append(np.full(len(hit), a))
        found_b.append(hit)
    return np.concatenate([*found_a, np.zeros(0, np.int64)]), np.concatenate([*found_b, np.zeros(0, np.int64)])


def _edges(ids: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    """Links that join what the pairs join, one per id at most."""
    root = roots(len(ids), a, b)
    mine = np.flatnonzero(root != np.arange(len(ids)))
    return pa.RecordBatch.from_arrays([pa.array(ids[root[mine]], pa.int64()), pa.array(ids[mine], pa.int64())], names=["a", "b"])


def clustered(members: DataFrame, rules: NearRules) -> DataFrame:
    """``id, component_id``: documents joined up by pairs across components that may be alike.

    ``members(bucket, size, rep, component, signature)``. Pairs never leave their task.
    """
    parts = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, ["bucket", "tile"]):
            yield _edges(table["rep"].to_numpy(), *_pairs_across(table, rules))

    dealt = tiled(members, "bucket", "rep", "size", rules.bucket_block).select("bucket", "tile", "side", "rep", "component", "signature")
    return components(dealt.repartition(parts, "bucket", "tile").sortWithinPartitions("bucket", "tile", "side", "rep")
                      .mapInArrow(run, "a long, b long"), "near-clusters")


def links_across(texts: DataFrame, rules: NearRules) -> DataFrame:
    """Links ``(a, b)`` between components, confirmed on full sets; enough of them to join all they join.

    ``texts(cluster, size, rep, component, signature, text)``. A tile holds two blocks of texts at
    most. Pairs that links found before already join are passed over.
    """
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, ["cluster", "tile"]):
            ids, column = table["rep"].to_numpy(), table["text"].combine_chunks()
            a, b = _pairs_across(table, rules)
            sets: list[np.ndarray] = []
            for start, stop in text_slices(column):
                made, owner, _, _ = shingle_sets(_raw(column.slice(start, stop - start)), rules.words)
                sets.extend(np.split(made, np.searchsorted(owner, np.arange(1, stop - start))))
            _, owner = np.unique(table["component"].to_numpy(), return_inverse=True)
            link_a, link_b = [], []
            for x, y in zip(a.tolist(), b.tolist(), strict=True):
                small, large = sorted((len(sets[x]), len(sets[y])))
                if owner[x] == owner[y] or 100 * small < rules.percent * large:
                    continue
                both = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
                if 100 * both >= rules.percent * (small + large - both):
                    link_a.append(x)
                    link_b.append(y)
                    owner[owner == owner[y]] = owner[x]
            yield pa.RecordBatch.from_arrays([pa.array(ids[link_a], pa.int64()), pa.array(ids[link_b], pa.int64())], names=["a", "b"])

    dealt = tiled(texts, "cluster", "rep", "size", rules.cluster_block).select("cluster", "tile", "side", "rep", "component", "signature", "text")
    return (dealt.repartition(parts, "cluster", "tile").sortWithinPartitions("cluster", "tile", "side", "rep")
            .mapInArrow(run, "a long, b long"))


def near_components(docs: DataFrame, rules: NearRules = NearRules()) -> DataFrame:  # noqa: B008
    """``doc_id, n_shingles, component_id, kept``, a row per row of ``docs``.

    Documents with one word sequence are a class, and its smallest id stands for it. In each
    band bucket the smallest member is compared with all others, and the links found joined up
    to components. Then only buckets that still hold several components are left. All their
    pairs across components are screened, and what may be alike is put together in clusters,
    inside which sets are compared in tiles of two blocks: no link that would join two
    components is missed, and no pair is a row.

    A null text, or one without words, links with nothing; nor does a row with a null id, whose
    component is null unless another document has its words. Repeated rows of one ``doc_id`` are
    taken to be the same text. Other columns are not read. ``near_filter`` tells all rows apart.
    """
    signed_docs = written(signed(docs, rules), "near-signed")
    filled = signed_docs.filter("n_shingles > 0 and doc_id is not null")
    classes = written(filled.groupBy("k1", "k2").agg(F.min("doc_id").alias("rep")), "near-classes")
    named = classes.select(F.col("k1").alias("c1"), F.col("k2").alias("c2"), "rep")
    sets = written(
        filled.join(named, (F.col("k1") == F.col("c1")) & (F.col("k2") == F.col("c2")) & (F.col("doc_id") == F.col("rep")))
        .select("rep", "signature", "bands").dropDuplicates(["rep"]), "near-sets")
    buckets = sets.select("rep", F.explode("bands").alias("bucket"))
    shared = written(buckets.groupBy("bucket").agg(F.min("rep").alias("pivot"), F.count("*").alias("n")).filter("n > 1"), "near-buckets")
    members = written(buckets.join(shared.select("bucket", "pivot"), "bucket"), "near-members")
    texts = docs.select(F.col("doc_id").cast("long"), "text")
    involved = members.select(F.col("rep").alias("k")).distinct()
    texts = written(texts.join(involved, texts.doc_id == involved.k).select(F.col("doc_id").alias("rep"), "text")
                    .dropDuplicates(["rep"]), "near-texts")

    stars = members.filter("rep <> pivot").select(F.col("pivot").alias("a"), F.col("rep").alias("b")).distinct()
    links = written(confirmed(_alike(stars, sets, rules), texts, rules), "near-links")
    found = written(components(links), "near-components")
    placed = members.join(found, members.rep == found.id, "left").select(
        "bucket", "rep", F.coalesce("component_id", "rep").alias("component"))
    placed = written(placed, "near-placed")
    split = placed.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("size"))
    split = written(split.filter("low < high").select("bucket", "size"), "near-split")
    signs = sets.select("rep", "signature")
    cluster = written(clustered(placed.join(split, "bucket").join(signs, "rep"), rules), "near-clusters")
    sizes = written(cluster.groupBy(F.col("component_id").alias("cluster")).agg(F.count("*").alias("size")), "near-sizes")
    one = placed.select("rep", "component").distinct().withColumnRenamed("rep", "k")
    open_texts = (cluster.join(sizes, cluster.component_id == sizes.cluster).join(one, F.col("id") == F.col("k"))
                  .join(signs, F.col("id") == signs.rep).drop("rep").join(texts, F.col("id") == texts.rep)
                  .select("cluster", "size", "rep", "component", "signature", "text"))
    more = links_across(open_texts, rules)
    every = links.union(written(more, "near-links"))

    final = written(components(every), "near-components")
    owner = classes.join(final, classes.rep == final.id, "left").select(
        F.col("k1").alias("c1"), F.col("k2").alias("c2"), F.coalesce("component_id", "rep").alias("component"))
    owner = written(owner, "near-owners")
    out = signed_docs.join(owner, (F.col("k1") == F.col("c1")) & (F.col("k2") == F.col("c2")) & (F.col("n_shingles") > 0), "left")
    component = F.coalesce("component", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), component.eqNullSafe(F.col("doc_id")).alias("kept"))


def near_filter(docs: DataFrame, rules: NearRules = NearRules()) -> DataFrame:  # noqa: B008
    """One document of each group, the one with the smallest id, with its own columns; repeated rows go too.

    Rows with a null id, and different texts of one id, are documents of their own (``with_row_key``).
    """
    row, keep = fresh(docs, "_row", "_keep")
    keyed = with_row_key(docs, row)
    kept = near_components(keyed.select(F.col(row).alias("doc_id"), "text"), rules).filter("kept").select(F.col("doc_id").alias(keep)).distinct()
    once = keyed.dropDuplicates([row])
    return once.join(kept, once[row] == kept[keep], "left_semi").drop(row)
