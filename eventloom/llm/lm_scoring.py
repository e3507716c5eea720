"""Cross-entropy difference of texts under two bigram models, of a target and of the background.

Both models have one vocabulary, all words of both corpora, and one form: a bigram's probability
is its count with the unigram probability as a prior. Words and bigrams are 64-bit hashes. A slice
of documents sends each shard of the hash space one row with its own distinct keys there and their
counts; the shard adds them up over all slices, and answers with the sums of both corpora; the
slice then works out the losses of its texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import joined, mix, owners, span_hashes, text_slices, word_spans, written

#: Keys of the tokens that are no words.
OTHER, BEGIN, END = (np.uint64(x) for x in (0x243F6A8885A308D3, 0x13198A2E03707344, 0xA4093822299F31D0))
#: Text bytes of a slice: the more, the more often its texts share a bigram, which is sent once.
SLICE = 4 << 20


@dataclass(frozen=True)
class ModelRules:
    """``vocabulary``: none tells all words apart; a number keeps the most frequent words of both corpora,
    equally frequent ones in or out together, and counts the others as one. ``bigram_prior`` and
    ``unigram_prior``: weights of the priors in tokens. ``shard_tokens``: tokens per shard of the hash space."""

    vocabulary: int | None = None
    bigram_prior: float = 20.0
    unigram_prior: float = 100.0
    shard_tokens: int = 500_000


@dataclass(frozen=True)
class Corpora:
    """``words``: number of words told apart; ``chosen``: their hashes in order, where the vocabulary is
    limited; ``background`` and ``target``: tokens of each, ends of text included."""

    words: int
    chosen: np.ndarray | None
    background: int
    target: int


def _words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of each word; A-Z count as a-z."""
    buf, starts = joined([t.lower() for t in texts])
    at, to = word_spans(buf)
    return span_hashes(buf, at, to), owners(starts, at)


def _merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    distinct, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    return distinct, np.bincount(inverse, weights=np.concatenate(counts), minlength=len(distinct)).astype(np.int64)


def word_counts(texts: DataFrame) -> DataFrame:
    """``word, n`` of ``texts(text)``: counts by word hash, added up in each task before they are shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, waiting = [], [], 0
        for batch in batches:
            for start, stop in text_slices(batch.column("text")):
                hashes, _ = _words([(t or "").encode() for t in batch.column("text").slice(start, stop - start).to_pylist()])
                word, n = np.unique(hashes, return_counts=True)
                keys.append(word)
                counts.append(n)
                waiting += len(word)
                if waiting > 800_000:
                    word, n = _merged(keys, counts)
                    keys, counts, waiting = [word], [n], len(word)
                    if len(word) > 500_000:
                        yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(n)], names=["word", "n"])
                        keys, counts, waiting = [], [], 0
        if keys:
            word, n = _merged(keys, counts)
            yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(n)], names=["word", "n"])

    return texts.select("text").mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def corpora(docs: DataFrame, target: DataFrame, rules: ModelRules) -> Corpora:
    """Sizes of both corpora and of their vocabulary; only a limited vocabulary comes to the driver.

    The least count that lets no more than ``vocabulary`` words in is found from a histogram of
    counts, which has about as many rows as the root of the number of tokens.
    """
    none = F.lit(0).cast("long")
    words = (word_counts(docs).select("word", F.col("n").alias("b"), none.alias("t"))
             .union(word_counts(target).select("word", none, F.col("n")))
             .groupBy("word").agg(F.sum("b").alias("b"), F.sum("t").alias("t")))
    if rules.vocabulary is not None:
        words = written(words, "lm-words")
    sums = words.agg(F.count("*").alias("words"), F.coalesce(F.sum("b"), none).alias("b"), F.coalesce(F.sum("t"), none).alias("t")).first()
    chosen, n_words = None, sums["words"]
    if rules.vocabulary is not None:
        both = F.col("b") + F.col("t")
        shape = words.groupBy(both.alias("n")).agg(F.count("*").alias("words")).orderBy(F.desc("n")).toPandas()
        inside = shape["n"][shape["words"].cumsum() <= rules.vocabulary]
        rows = words.filter(both >= int(inside.min())) if len(inside) else words.limit(0)
        chosen = np.sort(rows.select("word").toPandas()["word"].to_numpy(dtype=np.int64).view(np.uint64))
        n_words = len(chosen)
    return Corpora(n_words, chosen, sums["b"] + docs.count(), sums["t"] + target.count())


def as_planes(values: np.ndarray) -> bytes:
    """64-bit values byte by byte, all first bytes before all second ones: small values compress well."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def of_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, dtype=np.uint8).reshape(8, -1).T).view("<u8").ravel()


SLICES = "slice long, target boolean, ids array<long>, sizes binary, texts binary"


def text_rows(texts: DataFrame, target: bool) -> DataFrame:
    """``SLICES`` rows of ``texts(doc_id, text)``: many texts in each, packed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, packer = TaskContext.get().partitionId() << 32, zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for start, stop in text_slices(batch.column("text"), SLICE):
                mine = [(t or "").encode() for t in batch.column("text").slice(start, stop - start).to_pylist()]
                ids = batch.column("doc_id").slice(start, stop - start).to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number], pa.int64()), pa.array([target]), pa.array([ids], pa.list_(pa.int64())),
                     pa.array([np.array([len(t) for t in mine], dtype=np.int64).tobytes()], pa.binary()),
                     pa.array([packer.compress(b"".join(mine))], pa.binary())], names=["slice", "target", "ids", "sizes", "texts"])
                number += 1

    return texts.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SLICES)


@dataclass(frozen=True)
class Tokens:
    """Keys of the steps from a token to the next in a slice's texts, and the text of each step."""

    first: np.ndarray
    second: np.ndarray
    pair: np.ndarray
    text: np.ndarray


def tokens_of(sizes: bytes, texts: bytes, chosen: np.ndarray | None) -> Tokens:
    """The steps of a packed slice; each text is laid out as begin, words, end."""
    data, ends = zstandard.ZstdDecompressor().decompress(texts), np.cumsum(np.frombuffer(sizes, dtype=np.int64)).tolist()
    n = len(ends)
    token, owner = _words([data[a:b] for a, b in zip([0, *ends], ends, strict=False)])
    if chosen is not None:
        at = np.minimum(np.searchsorted(chosen, token), max(0, len(chosen) - 1))
        token = np.where(chosen[at] == token, token, OTHER) if len(chosen) else np.full(len(token), OTHER)
    counts = np.bincount(owner, minlength=n)
    begins = np.concatenate(([0], np.cumsum(counts + 2)))
    line = np.empty(begins[-1], dtype=np.uint64)
    line[begins[:-1]], line[begins[1:] - 1] = BEGIN, END
    line[np.arange(len(token)) + 2 * owner + 1] = token
    inner = np.ones(len(line), dtype=bool)
    inner[begins[1:] - 1] = False
    at = np.flatnonzero(inner)
    first, second = line[at], line[at + 1]
    return Tokens(first, second, mix(mix(first) + second), np.repeat(np.arange(n), counts + 1))


def counted_keys(tokens: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order (the begin, what follows, and pairs) and how often each occurs, with one sorted copy of them."""
    n_begins = int(np.count_nonzero(tokens.first == BEGIN))
    n = len(tokens.second)
    line = np.empty(n_begins + 2 * n, dtype=np.uint64)
    line[:n_begins], line[n_begins:n_begins + n], line[n_begins + n:] = BEGIN, tokens.second, tokens.pair
    del tokens
    line.sort()
    at = np.flatnonzero(np.concatenate(([True], line[1:] != line[:-1]))) if len(line) else np.zeros(0, dtype=np.int64)
    return line[at], np.diff(np.append(at, len(line)))


REQUESTS = "shard long, slice long, target boolean, keys binary, counts binary"


def requests(slices: DataFrame, shards: int, chosen: np.ndarray | None) -> DataFrame:
    """``REQUESTS`` rows: one per slice and shard with the slice's distinct keys there, as steps from key to key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # A batch holds many slices: one at a time is unpacked.
            for k in range(batch.num_rows):
                name, target, sizes, texts = (batch.column(c)[k].as_py() for c in ("slice", "target", "sizes", "texts"))
                keys, counts = counted_keys(tokens_of(sizes, texts, chosen))
                del sizes, texts
                firsts = np.arange(shards, dtype=np.uint64)
                # The least key of shard s: its upper half times ``shards`` reaches s << 32.
                least = (((firsts << np.uint64(32)) + np.uint64(shards - 1)) // np.uint64(shards)) << np.uint64(32)
                bounds = [*np.searchsorted(keys, least).tolist(), len(keys)]
                out = [(s, name, target, as_planes(np.diff(keys[a:b], prepend=np.uint64(0))), as_planes(counts[a:b]))
                       for s, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)) if a < b]
                del keys, counts
                kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out, strict=True), kinds, strict=True)],
                                                 names=["shard", "slice", "target", "keys", "counts"])

    return slices.select("slice", "target", "sizes", "texts").mapInArrow(run, REQUESTS)


def shard_sums(rows: pa.Table) -> pa.Table:
    """``shard, slice, background, target``: for each slice's keys, in its own order, their counts in both corpora."""
    keys = [np.cumsum(of_planes(x), dtype=np.uint64) for x in rows["keys"].to_pylist()]
    counts = np.concatenate([of_planes(x) for x in rows["counts"].to_pylist()]).astype(float)
    of_target = np.repeat(np.array(rows["target"], dtype=bool), [len(k) for k in keys])
    _, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    sums = [np.bincount(inverse, weights=counts * mine).astype(np.int64) for mine in (~of_target, of_target)]
    ends = np.cumsum([len(k) for k in keys]).tolist()
    ask = [k for k, t in enumerate(rows["target"].to_pylist()) if not t]
    answers = [pa.array([as_planes(s[inverse[ends[k] - len(keys[k]):ends[k]]]) for k in ask], pa.binary()) for s in sums]
    own = pa.array(ask, pa.int64())
    return pa.table([rows["shard"].take(own), rows["slice"].take(own), *answers], names=["shard", "slice", "background", "target"])


KINDS = [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("target_loss", pa.float64()), ("background_loss", pa.float64()), ("difference", pa.float64())]


def slice_losses(head: pa.Table, answers: pa.Table, sizes: Corpora, rules: ModelRules) -> pa.Table:
    """The losses of a slice's texts from the sums of all its keys."""
    if not len(head):
        return pa.table({n: pa.array([], k) for n, k in KINDS})
    tokens = tokens_of(head["sizes"][0].as_py(), head["texts"][0].as_py(), sizes.chosen)
    keys, _ = counted_keys(tokens)
    answers = answers.sort_by("shard")
    # Places by halving: sorting all steps with their places takes several times the memory.
    second, pair = np.searchsorted(keys, tokens.second), np.searchsorted(keys, tokens.pair)
    # What a step starts from is the begin or what the step before ended with.
    first = np.where(tokens.first == BEGIN, np.searchsorted(keys, BEGIN), np.roll(second, 1))
    n_keys, owner = len(keys), tokens.text
    del keys, tokens
    length = np.bincount(owner)
    loss = {}
    for name, size in (("target", sizes.target), ("background", sizes.background)):
        seen = np.concatenate([of_planes(x) for x in answers[name].to_pylist()]).astype(float)
        if len(seen) != n_keys:
            raise ValueError(f"{len(seen)} sums for {n_keys} keys of slice {head['slice'][0]}")
        # Words, ends and the rest can follow; no more.
        share = (seen[second] + rules.unigram_prior / (sizes.words + 2)) / (size + rules.unigram_prior)
        each = -np.log((seen[pair] + rules.bigram_prior * share) / (seen[first] + rules.bigram_prior))
        loss[name] = np.bincount(owner, weights=each) / length
    ids = head["ids"].combine_chunks().flatten()
    return pa.table([ids, pa.array(length.astype(np.int64)), pa.array(loss["target"]), pa.array(loss["background"]),
                     pa.array(loss["target"] - loss["background"])], names=[n for n, _ in KINDS])


def cross_entropy(docs: DataFrame, target: DataFrame, rules: ModelRules = ModelRules()) -> DataFrame:  # noqa: B008
    """``doc_id, n_tokens, target_loss, background_loss, difference``, a row per row of ``docs(doc_id, text)``.

    ``target(text)`` is the corpus to be alike to; the background is ``docs``. Losses are nats
    per token, where the end of a text is a token; the lower the difference, the nearer to the
    target. Null and empty texts are an end only. An empty target leaves its model with the prior
    alone. A null ``doc_id`` stays null. Other columns are not read.
    """
    sizes = corpora(docs, target, rules)
    shards = max(16, -(-sizes.background // rules.shard_tokens))
    slices = written(text_rows(docs, False).union(text_rows(target.select(F.lit(0).alias("doc_id"), "text"), True)), "lm-slices")
    sums = requests(slices, shards, sizes.chosen).groupBy("shard").applyInArrow(
        shard_sums, "shard long, slice long, background binary, target binary")
    heads = slices.filter("not target").select("slice", "ids", "sizes", "texts")
    return heads.groupBy("slice").cogroup(sums.groupBy("slice")).applyInArrow(
        lambda head, answers: slice_losses(head, answers, sizes, rules),
        "doc_id long, n_tokens long, target_loss double, background_loss double, difference double")
