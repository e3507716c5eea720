"""Language identification by error-correcting output codes over hashed n-grams."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import joined, text_slices

_LETTER = re.compile(r"[^\W\d_]")
#: Bytes as the n-grams see them: ASCII other than letters becomes a space, the rest stays.
_SEEN = np.array([b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256)], dtype=np.uint8)


@dataclass(frozen=True)
class LanguageRules:
    """``train_docs``: texts learnt from per language, drawn by a hash of their ids; ``most_langs``
    languages at most. ``buckets``: hashed n-grams. ``sharpness`` turns losses into a score,
    ``ambiguous``: least lead in loss of the first language over the second."""

    train_docs: int = 3000
    most_langs: int = 512
    orders: tuple[int, ...] = (2, 3)
    buckets: int = 1 << 15
    smoothing: float = 0.5
    sharpness: float = 4.0
    ambiguous: float = 0.25
    seed: int = 5


@dataclass(frozen=True)
class LanguageModel:
    """``codes`` (languages x bits, +1 or -1), n-gram ``weights`` (buckets x bits), ``scale`` per bit,
    ``trust`` (languages x bits): how often a bit is right on a language, summing to one per language."""

    langs: tuple[str, ...]
    codes: np.ndarray
    weights: np.ndarray
    scale: np.ndarray
    trust: np.ndarray
    rules: LanguageRules


def codewords(n: int, seed: int) -> np.ndarray:
    """A codeword per language: all splits in two up to five languages, else the best of many random codes."""
    if n <= 5:
        splits = [[1 if k == 0 or (bits >> (k - 1)) & 1 else -1 for k in range(n)] for bits in range((1 << max(0, n - 1)) - 1)]
        return np.array(splits, dtype=np.int8).T.reshape(n, len(splits))
    width, best, gap = int(np.ceil(10 * np.log2(n))), None, -1
    draw = np.random.default_rng(seed)
    for _ in range(200):
        code = draw.choice(np.array([-1, 1], dtype=np.int8), (n, width))
        code[0, np.abs(code.sum(axis=0)) == n] *= -1
        same = code.astype(np.int32) @ code.T
        least = int((width - same[~np.eye(n, dtype=bool)].max()) // 2)
        if least > gap:
            best, gap = code, least
    return best


def gram_ids(texts: list[str], rules: LanguageRules) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every n-gram, and how many each text has, text by text."""
    buf, starts = joined([b" " + t.lower().encode() for t in texts])
    seen = _SEEN[buf]
    # Runs of spaces count once, so that layout and digits say nothing.
    keep = np.concatenate(([True], (seen[1:] != 32) | (seen[:-1] != 32))) if len(seen) else np.zeros(0, dtype=bool)
    keep[starts[:-1]] = True
    places = np.concatenate(([0], np.cumsum(keep)))[starts]
    seen = seen[keep].astype(np.uint32)
    ids, owner = [], []
    of = np.repeat(np.arange(len(texts)), np.diff(places))
    for n in rules.orders:
        if len(seen) < n:
            continue
        h = np.full(len(seen) - n + 1, n, dtype=np.uint32)
        for k in range(n):
            h = (h * np.uint32(0x01000193)) ^ seen[k:len(seen) - n + 1 + k]
        h ^= h >> np.uint32(15)
        inside = of[:len(h)] == of[n - 1:]
        ids.append((h * np.uint32(0x2C1B3C6D) >> np.uint32(8))[inside] % np.uint32(rules.buckets))
        owner.append(of[:len(h)][inside])
    ids, owner = np.concatenate([*ids, np.zeros(0, np.uint32)]), np.concatenate([*owner, np.zeros(0, np.int64)])
    return ids, owner


def bit_values(texts: list[str], model_weights: np.ndarray, rules: LanguageRules) -> np.ndarray:
    """Mean n-gram weight of each text for each bit: the outputs of the binary classifiers."""
    out = np.zeros((len(texts), model_weights.shape[1]))
    ids, owner = gram_ids(texts, rules)
    counts = np.bincount(owner, minlength=len(texts))
    for bit in range(model_weights.shape[1]):
        out[:, bit] = np.bincount(owner, weights=model_weights[ids, bit], minlength=len(texts))
    return out / np.maximum(counts, 1)[:, None]


def held_out(doc_id: Column, modulus: int, rest: int) -> Column:
    """Whether crc32 of the id as text has this remainder; no for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus == rest, F.lit(False))


def sampled(rows: DataFrame, label: str, counts: dict, most: int, seed: int) -> DataFrame:
    """About ``most`` rows of each label, by a hash of ``doc_id`` that doesn't depend on other rows."""
    rates = {k: most / max(1, n) for k, n in counts.items()}
    rate = F.lit(0.0)
    for k, r in sorted(rates.items(), key=lambda x: str(x[0])):
        rate = F.when(F.col(label) == k, F.lit(float(r))).otherwise(rate)
    return rows.filter(F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1 << 20)) < rate * (1 << 20))


def train(docs: DataFrame, rules: LanguageRules = LanguageRules()) -> LanguageModel:  # noqa: B008
    """Fit on ``docs(doc_id, text, lang)``; rows without a language are left out.

    N-gram counts per language are gathered by Spark from the sample. A bit's classifier is
    the smoothed log-odds of an n-gram between the languages on either side of the bit, each
    language with the same weight. A second look at the sample tells how far to trust each bit.
    """
    labelled = docs.select("doc_id", "text", "lang").filter("lang is not null and text is not null")
    counts = {r.lang: r.n for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).limit(rules.most_langs + 1).collect()}
    if len(counts) > rules.most_langs:
        raise ValueError(f"more than {rules.most_langs} languages")
    langs = tuple(sorted(counts))
    sample = sampled(labelled, "lang", counts, rules.train_docs, rules.seed).select("text", "lang")
    codes = codewords(len(langs), rules.seed)
    n_bits = codes.shape[1]
    if len(langs) < 2:
        return LanguageModel(langs, codes, np.zeros((rules.buckets, 0)), np.zeros(0), np.zeros((len(langs), 0)), rules)
    number = {x: k for k, x in enumerate(langs)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(langs), rules.buckets), dtype=np.int64)
        for batch in batches:
            for start, stop in text_slices(batch.column("text")):
                part = batch.slice(start, stop - start)
                ids, owner = gram_ids(part.column("text").to_pylist(), rules)
                of = np.array([number[x] for x in part.column("lang").to_pylist()])[owner]
                np.add.at(total.reshape(-1), of * rules.buckets + ids, 1)
        lang, bucket = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(lang, pa.int64()), pa.array(bucket, pa.int64()), pa.array(total[lang, bucket])],
                                         names=["lang", "bucket", "n"])

    rows = sample.mapInArrow(count, "lang long, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    total = np.zeros((len(langs), rules.buckets))
    total[rows["lang"].to_numpy(dtype=int), rows["bucket"].to_numpy(dtype=int)] = rows["n"].to_numpy(dtype=float)
    share = total + rules.smoothing
    share /= share.sum(axis=1, keepdims=True)
    weights = np.stack([np.log(share[codes[:, b] > 0].mean(axis=0)) - np.log(share[codes[:, b] < 0].mean(axis=0))
                        for b in range(n_bits)], axis=1).astype(np.float32)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        right, size, n = np.zeros((len(langs), n_bits)), np.zeros((len(langs), n_bits)), np.zeros(len(langs))
        for batch in batches:
            for start, stop in text_slices(batch.column("text")):
                part = batch.slice(start, stop - start)
                of = np.array([number[x] for x in part.column("lang").to_pylist()])
                values = bit_values(part.column("text").to_pylist(), weights, rules)
                np.add.at(right, of, (values * codes[of] > 0).astype(float))
                np.add.at(size, of, np.abs(values))
                np.add.at(n, of, 1)
        lang, bit = np.indices(right.shape).reshape(2, -1)
        yield pa.RecordBatch.from_arrays([pa.array(lang), pa.array(bit), pa.array(right.reshape(-1)), pa.array(size.reshape(-1)),
                                          pa.array(np.repeat(n, n_bits))], names=["lang", "bit", "correct", "size", "n"])

    seen = (sample.mapInArrow(look, "lang long, bit long, correct double, size double, n double")
            .groupBy("lang", "bit").agg(F.sum("correct").alias("correct"), F.sum("size").alias("size"), F.sum("n").alias("n")).toPandas())
    right, size, n = (np.zeros((len(langs), n_bits)) for _ in range(3))
    at = (seen["lang"].to_numpy(dtype=int), seen["bit"].to_numpy(dtype=int))
    right[at], size[at], n[at] = (seen[c].to_numpy(dtype=float) for c in ("correct", "size", "n"))
    trust = (right + 1) / (n + 2)
    scale = 1 / np.maximum((size / np.maximum(n, 1)).mean(axis=0), 1e-9)
    return LanguageModel(langs, codes, weights, scale, trust / trust.sum(axis=1, keepdims=True), rules)


def losses(values: np.ndarray, model: LanguageModel) -> np.ndarray:
    """Loss of each language: exponential loss of every bit, weighted by the trust in it."""
    margin = np.clip(values * model.scale, -3, 3)
    return np.einsum("lb,tlb->tl", model.trust, np.exp(-margin[:, None, :] * model.codes[None, :, :]))


def predict(docs: DataFrame, model: LanguageModel, carry: list[str] | None = None) -> DataFrame:
    """``doc_id`` (and ``carry``), ``lang_pred, score, ambiguous, second_lang``, a row per row of ``docs``.

    Null texts and texts without a letter are ``und`` with score 0 and ambiguous; so is all
    text when the model has learnt no language. Ties go to the first language by name.
    """
    carry, rules = carry or ["doc_id"], model.rules

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            lettered = np.array([bool(t and _LETTER.search(t)) for t in texts], dtype=bool)
            lang, second, score, unsure = ["und"] * len(texts), [None] * len(texts), np.zeros(len(texts)), np.ones(len(texts), dtype=bool)
            for start, stop in text_slices(batch.column("text")):
                rows = [k for k in range(start, stop) if lettered[k]]
                if not rows or not model.langs:
                    continue
                if len(model.langs) == 1:
                    loss = np.zeros((len(rows), 1))
                else:
                    loss = losses(bit_values([texts[k] for k in rows], model.weights, rules), model)
                order = np.argsort(loss, axis=1, kind="stable")
                share = np.exp(-rules.sharpness * (loss - loss.min(axis=1, keepdims=True)))
                share /= share.sum(axis=1, keepdims=True)
                for k, row in enumerate(rows):
                    best = order[k, 0]
                    lang[row], score[row] = model.langs[best], share[k, best]
                    if len(model.langs) > 1:
                        second[row] = model.langs[order[k, 1]]
                        unsure[row] = loss[k, order[k, 1]] - loss[k, best] < rules.ambiguous
                    else:
                        unsure[row] = False
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in carry), pa.array(lang, pa.string()), pa.array(score), pa.array(unsure), pa.array(second, pa.string())],
                names=[*carry, "lang_pred", "score", "ambiguous", "second_lang"])

    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in carry)
    return docs.select(*carry, "text").mapInArrow(
        run, f"{kinds}, lang_pred string, score double, ambiguous boolean, second_lang string")


def identify(docs: DataFrame, rules: LanguageRules = LanguageRules()) -> DataFrame:  # noqa: B008
    """``doc_id, held_out, lang_pred, score, ambiguous, second_lang``: learn from four fifths, predict all."""
    out = held_out(F.col("doc_id"), 5, 0)
    model = train(docs.select("doc_id", "text", "lang").filter(~out), rules)
    named = predict(docs.select("doc_id", "text"), model)
    return named.select("doc_id", out.alias("held_out"), "lang_pred", "score", "ambiguous", "second_lang")
