"""Align the tokens of two tokenizers by byte offsets: groups, links, and how often the corpus has each link.

Both token streams of a text cover a space and the text. Offsets where tokens of both end cut them into
groups. A byte range shows a fragment of that: an open head up to its first cut, closed groups, and an
open tail behind its last cut. Fragments compose, in any bracketing, by joining a tail to the next head;
so a very long text is cut into byte ranges, which are worked on by many tasks and composed in a tree.

Tokens never reach over a space behind a character that isn't white space: not those of the byte-level
vocabulary, whose words take white space in front only, and not pieces, which have the mark of a space
only in front. So texts are cut into units there, and a unit is tokenized once per task.
"""

from __future__ import annotations

import hashlib
import re
import secrets
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, replace
from itertools import accumulate

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import text_slices, written

#: White space beyond ASCII; behind it, a space need not begin a token.
_RARE_SPACE = re.compile(r"[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
MARK = "\u2581"


@dataclass(frozen=True)
class AlignRules:
    """Texts above ``chunk_bytes`` are cut into byte ranges of that size, and ``fan_in`` fragments are composed at a time.

    Links of about ``slice_bytes`` of text ask for their counts together. ``units_kept`` bounds what a
    task remembers of units.
    """

    chunk_bytes: int = 64 << 10
    fan_in: int = 8
    slice_bytes: int = 4 << 20
    units_kept: int = 400_000


# --- fragments ---------------------------------------------------------------------


def _group(a: list[int], b: list[int]) -> bytes:
    return f"{','.join(map(str, a))}|{','.join(map(str, b))}".encode()


def _pair(a: int, b: int) -> int:
    return a << 32 | b


def _merged(pairs: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    distinct, at = np.unique(pairs, return_inverse=True)
    total = np.zeros(len(distinct), dtype=np.int64)
    np.add.at(total, at, counts)
    return distinct, total


@dataclass(frozen=True)
class Fragment:
    """The tokens that end in a byte range. Without a cut, all of them are in the head.

    ``pairs`` and ``counts`` are the links at the cuts, the first one's too.
    """

    cut: bool
    head: tuple[list[int], list[int]]
    closed: list[bytes]
    tail: tuple[list[int], list[int]]
    pairs: np.ndarray
    counts: np.ndarray
    n_a: int
    n_b: int
    n_closed: int
    good: bool = True

    def __add__(self, other: Fragment) -> Fragment:
        def both(x, y):
            return [*x[0], *y[0]], [*x[1], *y[1]]

        pairs, counts = _merged(np.concatenate((self.pairs, other.pairs)), np.concatenate((self.counts, other.counts)))
        total = {"pairs": pairs, "counts": counts, "n_a": self.n_a + other.n_a, "n_b": self.n_b + other.n_b, "good": self.good and other.good}
        if not self.cut:
            return replace(other, head=both(self.head, other.head), **total)
        if not other.cut:
            return replace(self, tail=both(self.tail, other.head), **total)
        middle = _group(*both(self.tail, other.head))
        return replace(self, closed=[*self.closed, middle, *other.closed], tail=other.tail,
                       n_closed=self.n_closed + 1 + other.n_closed, **total)

    def groups(self) -> bytes:
        """All groups of a whole text, whose end is a cut."""
        return b";".join([_group(*self.head), *self.closed]) if self.cut else b""


def fragment(a: list[int], a_ends: list[int], b: list[int], b_ends: list[int], good: bool = True) -> Fragment:
    """The fragment of two token streams of one byte range, by their ends."""
    ends = set(a_ends)
    cuts = [e for e in b_ends if e in ends]
    groups: list[tuple[list[int], list[int]]] = []
    i = j = 0
    for cut in cuts:
        p, q = i, j
        while a_ends[i] != cut:
            i += 1
        while b_ends[j] != cut:
            j += 1
        i, j = i + 1, j + 1
        groups.append((a[p:i], b[q:j]))
    pairs, counts = np.unique(np.array([_pair(x[-1], y[-1]) for x, y in groups], dtype=np.int64), return_counts=True)
    rest = (a[i:], b[j:])
    return Fragment(bool(cuts), groups[0] if cuts else rest, [_group(*g) for g in groups[1:]], rest if cuts else ([], []),
                    pairs, counts.astype(np.int64), len(a), len(b), max(0, len(groups) - 1), good)


# --- tokenizers --------------------------------------------------------------------


def _byte_letters() -> dict[str, int]:
    """The byte of each letter of a byte-level vocabulary: printable Latin-1 stands for itself, the others for U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class Pair:
    """Two tokenizers, the bytes of their tokens, and what is known of units."""

    def __init__(self, byte_json: str, piece_model: bytes, kept: int):
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(byte_json)
        self.a.encode_special_tokens = True
        letters = _byte_letters()
        self.a_bytes = [bytes(letters.get(c, 63) for c in self.a.id_to_token(k) or "") for k in range(self.a.get_vocab_size())]
        self.b = sentencepiece.SentencePieceProcessor(model_proto=piece_model)
        pieces = [self.b.id_to_piece(k) for k in range(self.b.get_piece_size())]
        if any(MARK in p.lstrip(MARK) for p in pieces):
            raise ValueError("pieces that reach over a space are not supported")
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(k) else p.replace(MARK, " ").encode() for k, p in enumerate(pieces)]
        self.a_sizes, self.b_sizes = [len(x) for x in self.a_bytes], [len(x) for x in self.b_bytes]
        self.digits = [str(k) for k in range(max(len(self.a_bytes), len(self.b_bytes)))]
        self.space = self.b.piece_to_id(MARK)
        self.kept = kept
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.texts: list[bytes] = []
        self.links: list[bytes] = []
        self.n_a, self.n_b, self.n_groups = array("q"), array("q"), array("q")

    def tokens(self, units: list[bytes]) -> Iterator[tuple[list[int], list[int]]]:
        """Ids of both tokenizers for each unit, a text that begins with a space."""
        texts = [u.decode() for u in units]
        first = [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]
        second = self.b.encode([t[1:] for t in texts], num_threads=1)
        for t, a, b in zip(texts, first, second, strict=True):
            yield a, [self.space] if t == " " else b

    def exact(self, unit: bytes, a: list[int], b: list[int]) -> bool:
        return b"".join([self.a_bytes[k] for k in a]) == unit == b"".join([self.b_bytes[k] for k in b])

    def ends(self, a: list[int], b: list[int], start: int = 0) -> tuple[list[int], list[int]]:
        return (list(accumulate([self.a_sizes[k] for k in a], initial=start))[1:],
                list(accumulate([self.b_sizes[k] for k in b], initial=start))[1:])

    def closed(self, a: list[int], b: list[int]) -> tuple[bytes, list[int]]:
        """The groups of a unit, whose end is a cut, as text, and its links."""
        sizes, others, digits = self.a_sizes, self.b_sizes, self.digits
        groups, links = [], []
        j = p = q = x = y = 0
        for i, k in enumerate(a, 1):
            x += sizes[k]
            while y < x:
                y += others[b[j]]
                j += 1
            if x == y:
                groups.append(",".join([digits[t] for t in a[p:i]]) + "|" + ",".join([digits[t] for t in b[q:j]]))
                links.append(_pair(k, b[j - 1]))
                p, q = i, j
        return ";".join(groups).encode(), links

    def learn(self, units: list[list[bytes]]) -> None:
        """Work out all units not known yet. A unit whose tokens don't give its bytes gets no text."""
        new = list({u for us in units for u in us if u not in self.known})
        if new and len(self.known) + len(new) > self.kept:
            self._forget()
            new = list({u for us in units for u in us})
        for at in range(0, len(new), 10_000):
            piece = new[at:at + 10_000]
            for unit, (a, b) in zip(piece, self.tokens(piece), strict=True):
                text, links = self.closed(a, b) if self.exact(unit, a, b) else (b"", None)
                self.known[unit] = len(self.texts)
                self.texts.append(text)
                self.links.append(array("q", links or []).tobytes())
                self.n_a.append(len(a))
                self.n_b.append(len(b))
                self.n_groups.append(-1 if links is None else len(links))


_PAIRS: dict[tuple[int, int, int], Pair] = {}


def pair_of(byte_json: str, piece_model: bytes, kept: int) -> Pair:
    """One pair per process and models."""
    key = (hash(byte_json), hash(piece_model), kept)
    if key not in _PAIRS:
        _PAIRS[key] = Pair(byte_json, piece_model, kept)
    return _PAIRS[key]


def unit_starts(text: bytes) -> np.ndarray:
    """Where units of a space and a text begin: at its own start, and at spaces behind what isn't white space."""
    buf = np.frombuffer(text, dtype=np.uint8)
    before = buf[:-1]
    solid = (before > 32) & (before != 127) | (before < 9) | (before > 13) & (before < 28)
    if not text.isascii() and _RARE_SPACE.search(text.decode()):
        solid &= before < 128
    return np.concatenate(([0], np.flatnonzero((buf[1:] == 32) & solid) + 1))


# --- documents ---------------------------------------------------------------------


_DIGEST = "n_a long, n_b long, n_groups long, groups_sha256 string"
_LINKS = "slice long, links binary, pairs array<struct<pair: long, n: long>>"
_CHUNK = "row long, chunk int, at long, lo long, hi long, part binary"
_FRAGMENT = ("row long, chunk int, good boolean, cut boolean, head_a array<int>, head_b array<int>, tail_a array<int>, "
             "tail_b array<int>, closed binary, n_closed long, n_a long, n_b long, pairs array<struct<pair: long, n: long>>")


def _pair_lists(lists: list[tuple[np.ndarray, np.ndarray] | None]) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum([len(p[0]) if p else 0 for p in lists]))).astype(np.int32)
    mine = [p for p in lists if p]
    items = pa.StructArray.from_arrays(
        [pa.array(np.concatenate([np.zeros(0, dtype=np.int64), *[p[k] for p in mine]]), pa.int64()) for k in (0, 1)], names=["pair", "n"])
    return pa.ListArray.from_arrays(offsets, items)


def _new_id() -> int:
    return secrets.randbits(63)


def _linked(pairs: list[np.ndarray]) -> tuple[list[bytes], tuple[np.ndarray, np.ndarray]]:
    """Per text its links as places in the slice's sorted pairs, and these pairs with their numbers."""
    flat = np.concatenate([np.zeros(0, dtype=np.int64), *pairs])
    distinct, place, counts = np.unique(flat, return_inverse=True, return_counts=True)
    bounds = np.cumsum([0, *map(len, pairs)])
    return ([np.sort(place[s:e]).astype("<u4").tobytes() for s, e in zip(bounds, bounds[1:], strict=False)],
            (distinct, counts.astype(np.int64)))


def _chunks(row: int, text: bytes, starts: np.ndarray, size: int) -> Iterator[tuple]:
    """Byte ranges of a text, each with the units that reach into it. A unit is cut once at most."""
    edges = np.concatenate((starts, [len(text)]))
    bounds, unit = [0], -1
    for bound in range(size, len(text), size):
        mine = int(np.searchsorted(starts, bound, side="right"))
        if mine != unit:
            bounds.append(bound)
            unit = mine
    bounds.append(len(text))
    for no, (lo, hi) in enumerate(zip(bounds, bounds[1:], strict=False)):
        begin = int(starts[np.searchsorted(starts, lo, side="right") - 1])
        end = int(edges[np.searchsorted(edges, hi, side="left")])
        yield row, no, begin, lo, hi, text[begin:end]


def _split(models: tuple[str, bytes], rules: AlignRules):
    """Documents to rows: short ones aligned, long ones as byte ranges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = pair_of(*models, rules.units_kept)
        for batch in batches:
            column = batch.column("text").cast(pa.binary()).fill_null(b"")
            for first, stop in text_slices(batch.column("text"), rules.slice_bytes):
                texts = column.slice(first, stop - first).to_pylist()
                ids = batch.column("doc_id").slice(first, stop - first)
                units, chunks, owner = [], [], []
                for k, text in enumerate(texts):
                    units.append([])
                    if not text or MARK.encode() in text:
                        continue
                    text = b" " + text
                    starts = unit_starts(text)
                    if len(text) > rules.chunk_bytes:
                        mine = list(_chunks(_new_id(), text, starts, rules.chunk_bytes))
                        chunks += mine
                        owner += [k] * len(mine)
                        units[k] = None
                        continue
                    edges = [*starts.tolist(), len(text)]
                    units[k] = [text[s:e] for s, e in zip(edges, edges[1:], strict=False)]
                pair.learn([u for u in units if u])
                yield _short(pair, ids, units)
                if chunks:
                    yield _long(ids.take(pa.array(owner)), chunks)

    names = ["doc_id", *[c.split()[0] for c in f"{_DIGEST}, slice long, links binary, pairs x, {_CHUNK}".split(", ")]]

    def _short(pair: Pair, ids: pa.Array, units: list) -> pa.RecordBatch:
        n_a, n_b, n_groups = (np.frombuffer(x, dtype=np.int64) for x in (pair.n_a, pair.n_b, pair.n_groups))
        rows, pairs, kept = [], [], [k for k, u in enumerate(units) if u is not None]
        for k in kept:
            at = [pair.known[u] for u in units[k]]
            groups = n_groups[at] if at else np.zeros(0, dtype=np.int64)
            if not at or groups.min() < 0:
                rows.append((0, 0, 0, ""))
                pairs.append(np.zeros(0, dtype=np.int64))
                continue
            digest = hashlib.sha256(b";".join([pair.texts[u] for u in at])).hexdigest()
            rows.append((int(n_a[at].sum()), int(n_b[at].sum()), int(groups.sum()), digest))
            pairs.append(np.frombuffer(b"".join([pair.links[u] for u in at]), dtype=np.int64))
        links, distinct = _linked(pairs)
        n = len(rows)
        none = [pa.nulls(n, t) for t in (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())]
        return pa.RecordBatch.from_arrays(
            [ids.take(pa.array(kept, pa.int64())), *[pa.array([r[k] for r in rows], pa.int64()) for k in range(3)], pa.array([r[3] for r in rows], pa.string()),
             pa.array(np.full(n, _new_id()), pa.int64()), pa.array(links, pa.binary()),
             _pair_lists([distinct, *[None] * (n - 1)] if n else []), *none], names=names)

    def _long(ids: pa.Array, chunks: list[tuple]) -> pa.RecordBatch:
        n = len(chunks)
        none = [*[pa.nulls(n, pa.int64())] * 3, pa.nulls(n, pa.string()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary()), _pair_lists([None] * n)]
        types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays([ids, *none, *[pa.array([c[k] for c in chunks], t) for k, t in enumerate(types)]], names=names)

    return run


# --- fragments as rows ---------------------------------------------------------------


def _rows(keys: list[tuple[int, int]], found: list[Fragment]) -> pa.RecordBatch:
    def lists(values):
        return pa.array(values, pa.list_(pa.int32()))

    return pa.RecordBatch.from_arrays(
        [pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int32()), pa.array([f.good for f in found], pa.bool_()),
         pa.array([f.cut for f in found], pa.bool_()), lists([f.head[0] for f in found]), lists([f.head[1] for f in found]),
         lists([f.tail[0] for f in found]), lists([f.tail[1] for f in found]), pa.array([b";".join(f.closed) for f in found], pa.binary()),
         *[pa.array([getattr(f, c) for f in found], pa.int64()) for c in ("n_closed", "n_a", "n_b")],
         _pair_lists([(f.pairs, f.counts) for f in found])],
        names=["row", "chunk", "good", "cut", "head_a", "head_b", "tail_a", "tail_b", "closed", "n_closed", "n_a", "n_b", "pairs"])


def _read(row: dict) -> Fragment:
    links = row["pairs"]
    return Fragment(
        row["cut"], (row["head_a"], row["head_b"]), [row["closed"]] if row["n_closed"] else [], (row["tail_a"], row["tail_b"]),
        np.array([x["pair"] for x in links], dtype=np.int64), np.array([x["n"] for x in links], dtype=np.int64),
        row["n_a"], row["n_b"], row["n_closed"], row["good"])


def _fragments(models: tuple[str, bytes], rules: AlignRules):
    """Byte ranges to their fragments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = pair_of(*models, rules.units_kept)
        for batch in batches:
            for row in batch.to_pylist():
                part, at = row["part"], row["at"]
                starts = [*unit_starts(part).tolist(), len(part)]
                units = [part[s:e] for s, e in zip(starts, starts[1:], strict=False)]
                ids = list(pair.tokens(units))
                good = all(pair.exact(u, a, b) for u, (a, b) in zip(units, ids, strict=True))
                a, b = [k for x, _ in ids for k in x], [k for _, x in ids for k in x]
                a_ends, b_ends = pair.ends(a, b, at)
                lo, hi = row["lo"], row["hi"]
                i, j = np.searchsorted(a_ends, [lo, hi], side="right")
                p, q = np.searchsorted(b_ends, [lo, hi], side="right")
                yield _rows([(row["row"], row["chunk"])], [fragment(a[i:j], a_ends[i:j], b[p:q], b_ends[p:q], good)])

    return run


def _composed(key: tuple, group: pa.Table) -> pa.Table:
    total = None
    for row in group.sort_by("chunk").drop_columns(["parent"]).to_pylist():
        total = _read(row) if total is None else total + _read(row)
    return pa.Table.from_batches([_rows([(key[0].as_py(), key[1].as_py())], [total])])


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fragments of whole texts to the digests and links of their documents, each a slice of its own."""
    for batch in batches:
        for row in batch.to_pylist():
            found = _read(row)
            good = found.good and found.cut
            pairs, counts = (found.pairs, found.counts) if good else (found.pairs[:0], found.counts[:0])
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["row"]], pa.int64()), *[pa.array([n if good else 0], pa.int64()) for n in (found.n_a, found.n_b, found.n_closed + 1)],
                 pa.array([hashlib.sha256(found.groups()).hexdigest() if good else ""]), pa.array([_new_id()], pa.int64()),
                 pa.array([np.repeat(np.arange(len(pairs)), counts).astype("<u4").tobytes()], pa.binary()), _pair_lists([(pairs, counts)])],
                names=["row", "n_a", "n_b", "n_groups", "groups_sha256", "slice", "links", "pairs"])


def _composed_texts(parts: DataFrame, models: tuple[str, bytes], rules: AlignRules) -> DataFrame:
    """Byte ranges of long texts to a row per text: fragments in many tasks, then a tree of compositions."""
    found = written(parts.repartition("row", "chunk").mapInArrow(_fragments(models, rules), _FRAGMENT), "fragments")
    most = int(parts.agg(F.max("chunk")).first()[0] or 0) + 1
    while most > 1:
        parent = F.floor(F.col("chunk") / rules.fan_in).cast("int")
        found = written(found.withColumn("parent", parent).groupBy("row", "parent").applyInArrow(_composed, _FRAGMENT), "fragments")
        most = -(-most // rules.fan_in)
    return found.mapInArrow(_whole, f"row long, {_DIGEST}, {_LINKS}")


# --- the corpus ----------------------------------------------------------------------


def _scored(key: tuple, docs: pa.Table, asked: pa.Table) -> pa.Table:
    """The documents of a slice with the counts of their links."""
    asked = asked.sort_by("pair")
    count, best = asked["total"].to_numpy(), asked["best"].to_numpy(zero_copy_only=False)
    n_links, n_best, count_sum = [], [], []
    for links in docs["links"].to_pylist():
        at = np.frombuffer(links, dtype="<u4")
        n_links.append(len(at))
        n_best.append(int(best[at].sum()))
        count_sum.append(int(count[at].sum()))
    out = docs.select(["doc_id", "n_a", "n_b", "n_groups"])
    for name, values in (("n_links", n_links), ("n_best", n_best), ("count_sum", count_sum)):
        out = out.append_column(name, pa.array(values, pa.int64()))
    return out.append_column("groups_sha256", docs["groups_sha256"])


def default_models() -> tuple[str, str]:
    """Paths of the byte-level vocabulary and the piece model."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def align(docs: DataFrame, byte_path: str | None = None, piece_path: str | None = None, rules: AlignRules = AlignRules()) -> DataFrame:  # noqa: B008
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``, a row per row of ``docs``.

    Texts that are null, empty or not given back by the bytes of both token streams have zeros and an
    empty digest. A link is a cut's pair of tokens; ``n_best`` counts a document's links whose pair is
    its second token's most frequent in the whole corpus (ties too), and ``count_sum`` adds up their
    pairs' counts. Repeated and null ids are rows like others; other columns are not read. The files
    are read once, on the driver.

    Pairs are counted once per slice of texts before they are shuffled, and each slice asks once for
    each of its pairs. Very long texts are cut into byte ranges; one that is a single unit of
    characters, without a space, is tokenized in two tasks at most.
    """
    byte_default, piece_default = (None, None) if byte_path and piece_path else default_models()
    with open(byte_path or byte_default, encoding="utf-8") as f:
        byte_json = f.read()
    with open(piece_path or piece_default, "rb") as f:
        models = (byte_json, f.read())
    kind = docs.schema["doc_id"].dataType.simpleString()
    parts = written(docs.select("doc_id", "text").mapInArrow(
        _split(models, rules), f"doc_id {kind}, {_DIGEST}, {_LINKS}, {_CHUNK}"), "aligned", compression="zstd")
    columns = ["doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "slice", "links", "pairs"]
    short = parts.filter("row is null").select(columns)
    chunks = parts.filter("row is not null")
    long = _composed_texts(chunks.select("row", "chunk", "at", "lo", "hi", "part"), models, rules)
    owners = chunks.filter("chunk = 0").select("row", "doc_id")
    whole = written(long.join(owners, "row").select(columns), "aligned-long", compression="zstd")
    rows = short.unionByName(whole)
    asked = rows.select("slice", F.explode("pairs").alias("p")).select("slice", "p.pair", "p.n")
    counts = asked.groupBy("pair").agg(F.sum("n").alias("total"))
    second = F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))
    counts = counts.withColumn("best", F.col("total") == F.max("total").over(Window.partitionBy(second)))
    answers = asked.select(F.col("slice").alias("asker"), "pair").join(counts, "pair").select("asker", "pair", "total", "best")
    out = f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return rows.drop("pairs").groupBy("slice").cogroup(answers.groupBy("asker")).applyInArrow(_scored, out)
