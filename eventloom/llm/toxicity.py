"""Toxicity: maximum-scoring segments over token log-odds, with extreme-value calibration."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import joined, mix, owners, span_hashes, text_slices, word_spans, written
from .language_id import held_out, sampled

#: A token is a run of letters: ASCII other than letters separates. Capitals of ASCII and Latin-1
#: count as small letters; both forms have the same number of bytes, so places stay true.
_SEEN = np.array([b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256)], dtype=np.uint8)


@dataclass(frozen=True)
class ToxicRules:
    """``train_docs``: texts learnt from per label. ``prefixes``: a token that is longer is also seen
    by its first so many bytes, since words may be built from toxic stems. ``prior``: weight of the
    Dirichlet prior in counts. Only features found ``min_count`` times with an absolute z-score
    over ``min_z`` get a score, their log-odds less ``caution`` standard deviations. A token
    has the score of its most significant feature; every token pays ``drift``. ``max_e``: largest
    expected number of such segments by chance for a passage to be called significant."""

    train_docs: int = 6000
    prefixes: tuple[int, ...] = (4, 5, 6, 7, 8, 9)
    prior: float = 10_000.0
    min_count: int = 4
    min_z: float = 3.0
    caution: float = 1.0
    drift: float = 0.25
    max_e: float = 0.05
    seed: int = 7


@dataclass(frozen=True)
class ToxicModel:
    """Scores and absolute z-scores of features by hash, the two parameters of the extreme-value law, and a logistic curve."""

    features: np.ndarray
    scores: np.ndarray
    weights: np.ndarray
    decay: float
    rate: float
    slope: float
    level: float
    rules: ToxicRules


@dataclass(frozen=True)
class Tokens:
    """Tokens of a slice of texts: number of the distinct token and of the text, begin and end in
    UTF-8 bytes; ``starts`` of the texts; ``features`` (distinct tokens x features, 0 for none)."""

    token: np.ndarray
    owner: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    starts: np.ndarray
    features: np.ndarray


def tokens_of(texts: list[str | None], rules: ToxicRules) -> Tokens:
    buf, starts = joined([(t or "").encode() for t in texts])
    seen = _SEEN[buf]
    capital = np.flatnonzero((seen[:-1] == 0xC3) & (seen[1:] >= 0x80) & (seen[1:] <= 0x9E) & (seen[1:] != 0x97)) + 1
    seen[capital] += 0x20
    at, to = word_spans(seen)
    words, first, token = np.unique(span_hashes(seen, at, to), return_index=True, return_inverse=True)
    features = np.zeros((len(words), 1 + len(rules.prefixes)), dtype=np.uint64)
    features[:, 0] = words
    for k, n in enumerate(rules.prefixes, start=1):
        longer = np.flatnonzero((to - at)[first] > n)
        begin = at[first[longer]]
        order = np.argsort(begin)
        hashes = np.empty(len(longer), dtype=np.uint64)
        hashes[order] = span_hashes(seen, begin[order], begin[order] + n)
        features[longer, k] = mix(hashes + np.uint64(n))
    return Tokens(token, owners(starts, at), at, to, starts, features)


def token_scores(tokens: Tokens, model: ToxicModel) -> np.ndarray:
    """The score of every token."""
    best, weight = np.zeros(len(tokens.features)), np.zeros(len(tokens.features))
    if len(model.features):
        for k in range(tokens.features.shape[1]):
            column = tokens.features[:, k]
            where = np.minimum(np.searchsorted(model.features, column), len(model.features) - 1)
            better = (model.features[where] == column) & (column != 0) & (model.weights[where] > weight)
            best = np.where(better, model.scores[where], best)
            weight = np.where(better, model.weights[where], weight)
    return best[tokens.token] - model.rules.drift


def best_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximum-scoring segments ``(first, stop, score)`` of a sequence, by Ruzzo and Tompa's scan.

    Only tokens of positive score open a segment, so the others are passed over in one step;
    a segment that is merged away is never looked at again, which keeps the scan linear.
    """
    total = np.concatenate(([0.0], np.cumsum(scores)))
    held: list[tuple[int, int, float, float]] = []
    for k in np.flatnonzero(scores > 0).tolist():
        first, left, right = k, float(total[k]), float(total[k + 1])
        while True:
            j = len(held) - 1
            while j >= 0 and held[j][2] >= left:
                j -= 1
            if j < 0 or held[j][3] >= right:
                held.append((first, k + 1, left, right))
                break
            first, left = held[j][0], held[j][2]
            del held[j:]
    return [(first, stop, right - left) for first, stop, left, right in held]


def log_odds(toxic: Column, clean: Column, n_toxic: float, n_clean: float, rules: ToxicRules) -> tuple[Column, Column]:
    """Log-odds of a feature between two classes under a Dirichlet prior shaped like both together, and its variance.

    ``n_toxic`` and ``n_clean`` are the classes' tokens.
    """
    prior = rules.prior * (toxic + clean) / max(1.0, n_toxic + n_clean)
    a, b = toxic + prior, clean + prior
    odds = F.log(a / (n_toxic + rules.prior - a)) - F.log(b / (n_clean + rules.prior - b))
    return odds, 1 / a + 1 / b


def decay_of(values: np.ndarray, shares: np.ndarray) -> float:
    """The positive root of sum(share * exp(root * value)) = 1: how fast chance scores die out.

    1 where there is none, because no token scores above 0 or they score above 0 on average.
    """
    if not len(values) or values.max() <= 0 or (values * shares).sum() >= 0:
        return 1.0
    low, high = 0.0, 1.0
    while (shares * np.exp(np.minimum(high * values, 700))).sum() < 1 and high < 64:
        high *= 2
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if (shares * np.exp(np.minimum(mid * values, 700))).sum() < 1 else (low, mid)
    return max(high, 1e-3)


def bits(segments: list[tuple[int, int, float]], n_tokens: int, model: ToxicModel) -> float:
    """Sum of the segments' scores above what chance gives in a text of this length."""
    floor = np.log(max(1e-12, model.rate * max(1, n_tokens)))
    return float(sum(max(0.0, model.decay * s - floor) for _, _, s in segments))


def _logistic(x: np.ndarray, y: np.ndarray, share: float) -> tuple[float, float]:
    """Slope and level of a logistic curve through labels, lightly held back.

    ``share`` is that of label 1 among all labels; the sample's classes are weighted to it.
    """
    if len(x) == 0 or y.min() == y.max():
        return 0.0, float(-2.0 if len(x) == 0 or y.max() == 0 else 2.0)
    weight = np.where(y == 1, share / y.sum(), (1 - share) / (len(y) - y.sum()))
    slope, level = 0.0, float(np.log(share / (1 - share)))
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(slope * x + level, -30, 30)))
        g = np.array([(weight * (p - y) * x).sum() + 1e-4 * slope, (weight * (p - y)).sum()])
        w = weight * p * (1 - p)
        h = np.array([[(w * x * x).sum() + 1e-4, (w * x).sum()], [(w * x).sum(), w.sum() + 1e-6]])
        step = np.linalg.solve(h, g)
        size = np.abs(step).max()
        step *= min(1.0, 2.0 / max(size, 1e-12))
        slope, level = slope - step[0], level - step[1]
        if size < 1e-9:
            break
    return float(slope), float(level)


def train(docs: DataFrame, labels: DataFrame, rules: ToxicRules = ToxicRules()) -> ToxicModel:  # noqa: B008
    """Fit on ``docs(doc_id, text)`` and ``labels(doc_id, toxic)``; a document labelled twice takes the larger label.

    The sample's ids, ``train_docs`` per label, are few by that parameter and are broadcast to
    the texts. A token counts once in a text.
    """
    marks = (labels.select(F.col("doc_id").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
             .filter("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    counts = {r.toxic: r.n for r in marks.filter("toxic in (0, 1)").groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    ids = sampled(marks, "toxic", counts, rules.train_docs, rules.seed).withColumnRenamed("doc_id", "_id")
    sample = docs.select("doc_id", "text").join(F.broadcast(ids), F.col("doc_id") == F.col("_id")).filter(
        "text is not null").select("text", "toxic")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in text_slices(batch.column("text")):
                part = batch.slice(start, stop - start)
                found = tokens_of(part.column("text").to_pylist(), rules)
                pair = np.unique(found.owner * len(found.features) + found.token)
                word = pair % max(1, len(found.features))
                toxic = np.array(part.column("toxic").to_pylist(), dtype=float)[pair // max(1, len(found.features))]
                y1 = np.bincount(word, weights=toxic, minlength=len(found.features))
                y0 = np.bincount(word, weights=1 - toxic, minlength=len(found.features))
                flat = found.features.T.reshape(-1)
                feature, inverse = np.unique(flat, return_inverse=True)
                wide = found.features.shape[1]
                counts = [np.bincount(inverse, weights=np.tile(y, wide), minlength=len(feature)) for y in (y1, y0)]
                feature, counts = np.append(feature[feature != 0], np.uint64(0)), [c[feature != 0] for c in counts]
                counts = [np.append(c, y.sum()) for c, y in zip(counts, (y1, y0), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(feature.view(np.int64)), *map(pa.array, counts)], names=["feature", "y1", "y0"])

    # Row 0 holds the tokens of each class; a token counts once in a text.
    tally = written(sample.mapInArrow(count, "feature long, y1 double, y0 double").groupBy("feature").agg(
        F.sum("y1").alias("y1"), F.sum("y0").alias("y0")), "toxic-counts")
    total = tally.filter("feature = 0").first()
    odds, variance = log_odds(F.col("y1"), F.col("y0"), total.y1 if total else 0.0, total.y0 if total else 0.0, rules)
    clear = tally.filter((F.col("feature") != 0) & (F.col("y1") + F.col("y0") >= rules.min_count)).withColumns(
        {"odds": odds, "sd": F.sqrt(variance)}).filter(F.abs("odds") >= rules.min_z * F.col("sd")).toPandas()
    feature = clear["feature"].to_numpy(dtype=np.int64).view(np.uint64)
    order = np.argsort(feature)
    value, spread = clear["odds"].to_numpy(dtype=float)[order], clear["sd"].to_numpy(dtype=float)[order]
    score = np.sign(value) * np.maximum(np.abs(value) - rules.caution * spread, 0)
    first = ToxicModel(feature[order], score, np.abs(value) / spread, 1.0, 1.0, 1.0, 0.0, rules)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in text_slices(batch.column("text")):
                part = batch.slice(start, stop - start)
                found = tokens_of(part.column("text").to_pylist(), rules)
                score, cuts = token_scores(found, first), np.searchsorted(found.owner, np.arange(len(part) + 1))
                texts = [score[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
                ups = [x[x > -rules.drift].tolist() + x[x < -rules.drift].tolist() for x in texts]
                yield pa.RecordBatch.from_arrays(
                    [part.column("toxic"), pa.array([len(x) for x in texts], pa.int64()),
                     pa.array([[s for _, _, s in best_segments(x)] for x in texts], pa.list_(pa.float64())),
                     pa.array(ups, pa.list_(pa.float64()))], names=["toxic", "n", "segments", "marked"])

    seen = sample.mapInArrow(look, "toxic int, n long, segments array<double>, marked array<double>").toPandas()
    clean = seen[seen["toxic"] == 0]
    values = np.concatenate([np.asarray(x, dtype=float) for x in clean["marked"]] or [np.zeros(0)])
    n_clean = max(1, int(clean["n"].sum()))
    values, times = np.unique(np.round(values, 6), return_counts=True)
    decay = decay_of(np.append(values, -rules.drift), np.append(times, n_clean - times.sum()) / n_clean)
    top = np.array([max(x, default=0.0) for x in clean["segments"]])
    chance = (clean["n"].to_numpy(dtype=float) * np.exp(-decay * top)).sum() if len(clean) else 1.0
    half = ToxicModel(first.features, first.scores, first.weights, decay, max(1e-12, len(clean) / max(chance, 1e-12)), 1.0, 0.0, rules)
    x = np.array([bits([(0, 0, s) for s in g], n, half) for g, n in zip(seen["segments"], seen["n"], strict=True)])
    share = counts.get(1, 0) / max(1, sum(counts.values()))
    slope, level = _logistic(x, seen["toxic"].to_numpy(dtype=float), share)
    return ToxicModel(half.features, half.scores, half.weights, half.decay, half.rate, slope, level, rules)


PASSAGES = "passages array<struct<begin: int, end: int, score: double, expected: double>>"


def score_texts(docs: DataFrame, model: ToxicModel) -> DataFrame:
    """``doc_id, score, n_passages, passages``, a row per row of ``docs``.

    A passage is a significant segment: its place in characters, its score, and how many such
    segments chance would give in a text of that length. Null and empty texts have none and
    get the lowest score there is.
    """
    rules = model.rules

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores, passages = [], []
            for start, stop in text_slices(batch.column("text")):
                texts = batch.column("text").slice(start, stop - start).to_pylist()
                found = tokens_of(texts, rules)
                at, to, starts = found.begin, found.end, found.starts
                value, cuts = token_scores(found, model), np.searchsorted(found.owner, np.arange(len(texts) + 1))
                for k, text in enumerate(texts):
                    first, last = cuts[k], cuts[k + 1]
                    segments = best_segments(value[first:last])
                    x = model.slope * bits(segments, last - first, model) + model.level
                    scores.append(float(1 / (1 + np.exp(-np.clip(x, -30, 30)))))
                    mine, raw = [], None
                    for a, b, s in segments:
                        expected = float(model.rate * max(1, last - first) * np.exp(-model.decay * s))
                        if expected <= rules.max_e:
                            raw = (text or "").encode() if raw is None else raw
                            begin, end = at[first + a] - starts[k], to[first + b - 1] - starts[k]
                            begin_char = len(raw[:begin].decode())
                            mine.append({"begin": begin_char, "end": begin_char + len(raw[begin:end].decode()), "score": s, "expected": expected})
                    passages.append(mine)
            kind = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("expected", pa.float64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores, pa.float64()), pa.array([len(x) for x in passages], pa.int64()),
                 pa.array(passages, kind)], names=["doc_id", "score", "n_passages", "passages"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double, n_passages long, {PASSAGES}")


def toxicity(docs: DataFrame, labels: DataFrame, rules: ToxicRules = ToxicRules()) -> DataFrame:  # noqa: B008
    """``doc_id, held_out, score, predicted, n_passages, passages``: learn from three quarters of the labels, score all."""
    out = held_out(F.col("doc_id"), 4, 2)
    model = train(docs, labels.select("doc_id", "toxic").filter(~out), rules)
    return score_texts(docs, model).select(
        "doc_id", out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), "n_passages", "passages")
