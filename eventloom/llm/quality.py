"""Quality rules: base counts of a text, and zstandard ratios that must stay inside a band fitted to the corpus."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import joined, mix, owners, span_hashes, text_slices, word_spans


@dataclass(frozen=True)
class Fitted:
    """Limits at some lengths, fitted to a corpus: log2 of bytes, lower and upper limit, in order of length."""

    at: tuple[float, ...]
    low: tuple[float, ...]
    high: tuple[float, ...]
    #: Octaves of bytes that were fitted; texts of other lengths have the fixed limits alone.
    octaves: tuple[int, ...]


@dataclass(frozen=True)
class Bands:
    """Limits of compressed size / size by length, straight lines between knots on log2(bytes).

    Prose loses its redundancy slowly: short texts hardly compress, long ones level off. Text
    under ``low`` repeats itself, text over ``high`` is noise. Beyond the outer knots the
    outer limits hold. ``low`` is per code point: scripts of two or three bytes a letter repeat
    their lead bytes, which says nothing of the text. It lies under natural prose of any kind
    (documentation, licences, copyright files).

    ``fit_bands`` narrows the lower limits to a corpus: ``spreads`` times the distance from the
    median ratio to the lower quartile, below the median, by octave of length and bytes per code
    point, but never above the ratio that ``most`` of the texts there are under. The upper limits are
    widened in the same way where a corpus needs it. Lengths with fewer than ``least_texts`` texts keep
    the fixed limits.
    """

    level: int = 3
    chunk_bytes: int = 4096
    #: A last chunk shorter than this is judged only as part of the whole.
    least_chunk: int = 1024
    #: Share of chunks outside their band above which a text of two chunks or more goes.
    bad_chunks: float = 0.5
    low: tuple[tuple[int, float], ...] = (
        (64, 0.40), (256, 0.40), (512, 0.36), (1024, 0.30), (2048, 0.26), (4096, 0.21),
        (8192, 0.20), (16384, 0.19), (32768, 0.17), (65536, 0.15), (262144, 0.12))
    high: tuple[tuple[int, float], ...] = (
        (64, 1.30), (128, 1.00), (256, 0.85), (512, 0.82), (1024, 0.74), (4096, 0.66), (16384, 0.62))
    spreads: float = 3.0
    most: float = 0.08
    least_texts: int = 100
    #: What ``fit_bands`` found, by (is a chunk, bytes per code point).
    fitted: tuple[tuple[tuple[bool, int], Fitted], ...] = ()

    def limits(self, sizes: np.ndarray, points: np.ndarray | None = None, chunks: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Limits of the ratio of bytes, for texts of so many bytes and code points (one byte each if not given)."""
        points = sizes if points is None else points
        low, high = (np.interp(np.log2(np.maximum(n, 1)), [np.log2(k) for k, _ in knots], [r for _, r in knots])
                     for n, knots in ((points, self.low), (sizes, self.high)))
        low = low * points / np.maximum(sizes, 1)
        length, width = np.log2(np.maximum(sizes, 1)), widths(sizes, points)
        for (of_chunks, of_width), fit in self.fitted:
            if of_chunks == chunks:
                mine = (width == of_width) & np.isin(length.astype(np.int64), fit.octaves)
                low[mine] = np.maximum(low[mine], np.interp(length[mine], fit.at, fit.low))
                high[mine] = np.maximum(high[mine], np.interp(length[mine], fit.at, fit.high))
        return low, high


def widths(sizes: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Bytes per code point, rounded: 1 for Latin letters, 2 for Greek or Cyrillic ones, 3 for Chinese."""
    return (sizes / np.maximum(points, 1) + 0.5).astype(np.int64)


FIELDS = [
    ("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()),
    ("n_repeat_words", pa.int64()), ("base_failed", pa.bool_()), ("ratio", pa.float64()),
    ("n_chunks", pa.int64()), ("n_bad_chunks", pa.int64()), ("band", pa.string()), ("kept", pa.bool_()),
]
SCHEMA = ", ".join(f"{n} {'long' if t == pa.int64() else 'double' if t == pa.float64() else 'string' if t == pa.string() else 'boolean'}"
                   for n, t in FIELDS)


def repeated(owner: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key whether its owner has it more than once, and whether this is not the first."""
    both = mix(keys + owner.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    order = np.argsort(both, kind="stable")
    same = np.concatenate(([False], both[order][1:] == both[order][:-1]))
    twice, later = np.empty(len(keys), dtype=bool), np.empty(len(keys), dtype=bool)
    twice[order] = same | np.concatenate((same[1:], [False]))
    later[order] = same
    return twice, later


def base_counts(texts: list[bytes]) -> dict[str, np.ndarray]:
    """The counts of many texts at once, an array each."""
    n = len(texts)
    buf, starts = joined(texts)
    at, to = word_spans(buf)
    word_owner = owners(starts, at)
    blank = (buf == 32) | ((buf >= 9) & (buf <= 13))
    symbol = np.zeros(256, dtype=bool)
    symbol[np.frombuffer(b"#*$%&|<>", dtype=np.uint8)] = True
    per_text = lambda flags: np.add.reduceat(flags, starts[:-1], dtype=np.int64) if n else np.zeros(0, np.int64)
    out = {
        "n_words": np.bincount(word_owner, minlength=n),
        "word_chars": per_text(~blank & ((buf & 0xC0) != 0x80)),
        "n_symbols": per_text(symbol[buf]),
    }

    ends = np.flatnonzero(buf == 10)
    begins = np.concatenate(([0], ends[:-1] + 1)) if len(ends) else ends
    full = np.searchsorted(at, ends) > np.searchsorted(at, begins)
    begins, ends = begins[full], ends[full]
    line_owner = owners(starts, begins)
    _, later = repeated(line_owner, span_hashes(buf, begins, ends))
    out["n_dup_lines"] = np.bincount(line_owner[later], minlength=n)

    words = span_hashes(buf, at, to)
    in_window = np.zeros(len(words), dtype=bool)
    if len(words) > 2:
        whole = np.flatnonzero(word_owner[2:] == word_owner[:-2])
        window = mix(mix(mix(words[whole]) + words[whole + 1]) + words[whole + 2])
        twice, _ = repeated(word_owner[whole], window)
        for k in range(3):
            in_window[whole[twice] + k] = True
    out["n_repeat_words"] = np.bincount(word_owner[in_window], minlength=n)
    # Near copies share the least hash of their 5-word windows more often than not.
    out["near"] = np.zeros(n, dtype=np.uint64)
    if len(words) > 4:
        whole = np.flatnonzero(word_owner[4:] == word_owner[:-4])
        window = words[whole]
        for k in range(1, 5):
            window = mix(window) + words[whole + k]
        window, owner = mix(window), word_owner[whole]
        heads = np.flatnonzero(np.diff(owner, prepend=-1))
        out["near"][owner[heads]] = np.minimum.reduceat(window, heads) if len(heads) else 0
    return out


def code_points(text: bytes) -> int:
    """Code points that begin in ``text``."""
    return int(np.count_nonzero((np.frombuffer(text, dtype=np.uint8) & 0xC0) != 0x80))


def ratios_of(text: bytes, bands: Bands, packer: zstandard.ZstdCompressor) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, code points and ratio of a text that isn't empty, then of each of its chunks that is judged."""
    parts = [text]
    if len(text) > bands.chunk_bytes:
        parts += [c for k in range(0, len(text), bands.chunk_bytes) if len(c := text[k:k + bands.chunk_bytes]) >= bands.least_chunk]
    sizes = np.array([len(c) for c in parts], dtype=np.int64)
    points = np.array([code_points(c) for c in parts], dtype=np.int64)
    return sizes, points, np.array([len(packer.compress(c)) for c in parts]) / sizes


def compression(text: bytes, bands: Bands, packer: zstandard.ZstdCompressor) -> tuple[float, int, int, str]:
    """Whole ratio, chunks judged, chunks outside their band, and the verdict's name."""
    if not text:
        return 0.0, 0, 0, "empty"
    sizes, points, ratios = ratios_of(text, bands, packer)
    low, high = bands.limits(sizes[:1], points[:1])
    chunk_low, chunk_high = bands.limits(sizes[1:], points[1:], chunks=True)
    under, over = int(np.sum(ratios[1:] < chunk_low)), int(np.sum(ratios[1:] > chunk_high))
    ratio, n_chunks = float(ratios[0]), len(sizes) - 1
    if ratio < low[0]:
        band = "repetitive"
    elif ratio > high[0]:
        band = "incompressible"
    elif n_chunks > 1 and under + over > bands.bad_chunks * n_chunks:
        band = "repetitive chunks" if under >= over else "incompressible chunks"
    else:
        band = "inside"
    return ratio, n_chunks, under + over, band


def base_failed(counts: dict[str, np.ndarray]) -> np.ndarray:
    return (counts["n_words"] < 50) | (100 * counts["n_repeat_words"] > 50 * counts["n_words"])


SAMPLED = "chunk boolean, octave long, width long, near long, ratio long, length long"


def ratio_rows(docs: DataFrame, bands: Bands) -> DataFrame:
    """``SAMPLED`` rows of ``docs(text)``: each text that passes the base rules, and each of its chunks.

    ``ratio`` counts ten-thousandths, ``length`` thousandths of log2(bytes).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=bands.level)
        for batch in batches:
            texts = batch.column("text")
            for start, stop in text_slices(texts):
                raw = [(t or "").encode() for t in texts.slice(start, stop - start).to_pylist()]
                counts = base_counts(raw)
                for k in np.flatnonzero(~base_failed(counts)).tolist():
                    sizes, points, ratios = ratios_of(raw[k], bands, packer)
                    length, place = np.log2(sizes), np.arange(len(sizes))
                    near = mix(counts["near"][k:k + 1] + place.astype(np.uint64)).view(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x) for x in (place > 0, length.astype(np.int64), widths(sizes, points), near,
                                               (ratios * 10_000).astype(np.int64), (length * 1000).astype(np.int64))],
                        names=["chunk", "octave", "width", "near", "ratio", "length"])

    return docs.select("text").mapInArrow(run, SAMPLED)


def fit_bands(docs: DataFrame, bands: Bands = Bands()) -> Bands:  # noqa: B008
    """``bands`` with limits fitted to all texts of ``docs`` that pass the base rules.

    Of near copies, those that share the least hash of their word windows, the least ratio counts, once: a large group
    does not draw the limits to itself. Quantiles are exact over ratios rounded to ten-thousandths.
    A few numbers per octave of length come to the driver. Tables without texts give ``bands`` back.
    """
    group = ["chunk", "octave", "width"]
    one = ratio_rows(docs, bands).groupBy(*group, "near").agg(F.min(F.struct("ratio", "length")).alias("least"))
    counted = one.groupBy(*group, F.col("least.ratio").alias("ratio")).agg(
        F.count("*").alias("n"), F.sum("least.length").alias("length"))
    shares = ", ".join(str(x) for x in (bands.most, 0.25, 0.5, 0.75, 1 - bands.most))
    rows = counted.groupBy(*group).agg(
        F.sum("n").alias("n"), F.sum("length").alias("length"), F.expr(f"percentile(ratio, array({shares}), n)").alias("at")
    ).filter(F.col("n") >= bands.least_texts).orderBy(*group).collect()
    found: dict[tuple[bool, int], list[tuple[float, float, float, int]]] = {}
    for r in rows:
        least, lower, middle, upper, greatest = (x / 10_000 for x in r["at"])
        found.setdefault((r["chunk"], r["width"]), []).append((
            r["length"] / r["n"] / 1000, min(least, middle - bands.spreads * (middle - lower)),
            max(greatest, middle + bands.spreads * (upper - middle)), r["octave"]))
    return replace(bands, fitted=tuple((k, Fitted(*zip(*v, strict=True))) for k, v in found.items()))


def score_batch(texts: pa.Array, bands: Bands) -> list[pa.Array]:
    """The columns of ``FIELDS`` for a batch of texts."""
    packer = zstandard.ZstdCompressor(level=bands.level)
    columns: dict[str, list] = {name: [] for name, _ in FIELDS}
    for start, stop in text_slices(texts):
        raw = [(t or "").encode() for t in texts.slice(start, stop - start).to_pylist()]
        counts = base_counts(raw)
        failed = base_failed(counts)
        packed = [compression(t, bands, packer) for t in raw]
        for name, values in counts.items():
            if name in columns:
                columns[name].append(values)
        columns["base_failed"].append(failed)
        for name, values in zip(("ratio", "n_chunks", "n_bad_chunks", "band"), zip(*packed), strict=True):
            columns[name].append(np.array(values, dtype=object if name == "band" else None))
        columns["kept"].append(~failed & np.array([p[3] == "inside" for p in packed]))
    return [pa.array(np.concatenate(v) if v else [], type=kind) for (_, kind), v in zip(FIELDS, columns.values(), strict=True)]


def quality_rules(docs: DataFrame, bands: Bands | None = None) -> DataFrame:
    """``(doc_id, n_words, ..., ratio, n_chunks, n_bad_chunks, band, kept)``, a row per document.

    Null and empty texts have no words and so fail the base rules. Repeated rows are judged
    alike; other columns of ``docs`` are not read. Without ``bands`` the limits are fitted to ``docs``,
    which reads the texts once more; with them there is no shuffle.
    """
    return with_quality(docs.select("doc_id", "text"), bands or fit_bands(docs), ["doc_id"])


def with_quality(docs: DataFrame, bands: Bands, carry: list[str]) -> DataFrame:
    """The columns ``carry``, then those of ``FIELDS``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c) for c in carry] + score_batch(batch.column("text"), bands)
            yield pa.RecordBatch.from_arrays(columns, names=carry + [n for n, _ in FIELDS])

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*carry).schema)
    return docs.mapInArrow(run, f"{kept}, {SCHEMA}")


def quality_filter(docs: DataFrame, bands: Bands | None = None) -> DataFrame:
    """The documents that pass, with their own columns unchanged; limits as in ``quality_rules``."""
    names, bands = docs.columns, bands or fit_bands(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(score_batch(batch.column(names.index("text")), bands)[-1])

    return docs.mapInArrow(run, docs.schema)
