"""Token ids of documents in binary files: a range asymmetric numeral system over one frequency table.

A folder holds ``table`` (the frequencies, counted over all tokens), ``shards`` (files of blocks in
ascending ``doc_id`` order) and ``manifest`` (each file's place and totals, written last). A block
has up to 65,536 tokens of one document and can be decoded alone: token ``j`` belongs to lane
``j % lanes``, every lane is a coder with a 64-bit state of its own, and all lanes share one stream
of 32-bit words. Every 256 steps the states are stored, so that decoding can begin there. A
checksum covers each block, and the table's checksum stands in it.

All numbers are little-endian. Spark's own writer commits the files, so that a task that is
repeated leaves nothing behind; it puts a line feed after each block.
"""

from __future__ import annotations

import re
import struct
import unicodedata
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import SLICE_BYTES, joined, parts_for, text_slices, word_spans, written

_LOW = np.uint64(1 << 31)
_HALF = np.uint64(32)
_HEAD = struct.Struct("<4sBBHHHqIII")
_CHECK = struct.Struct("<II")
_TABLE = struct.Struct("<4sIII")
_MAGIC, _TABLE_MAGIC = b"TRB1", b"TRT1"
_NULL_ID, _LAST = 1, 2
SEPARATOR = b"\n"


@dataclass(frozen=True)
class FileRules:
    """A frequency is a share of ``2 ** bits``; lanes follow a block's length, so that it takes about ``steps``.

    ``shard_tokens`` is the mean size of a file. ``words_kept`` bounds what a task remembers of words' parts.
    """

    bits: int = 20
    block_tokens: int = 1 << 16
    steps: int = 512
    check_every: int = 256
    least_lanes: int = 4
    shard_tokens: int = 4_000_000
    words_kept: int = 800_000


# --- ids of texts ------------------------------------------------------------------


# Bytes are blank, part of a letter, or other ASCII. A word with an odd byte is not cut: an apostrophe can
# begin a token with letters in it, "<|" a special token, and of other characters little is known.
_BLANK, _LETTER, _OTHER, _ODD = range(4)
_KINDS = np.full(256, _OTHER, dtype=np.uint8)
_KINDS[[9, 10, 11, 12, 13, 32]] = _BLANK
_KINDS[[*range(65, 91), *range(97, 123)]] = _LETTER
_KINDS[[ord("'"), *range(128, 256)]] = _ODD
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_ASCII_LETTERS = bytes(range(97, 123)).decode()
# Behind any letters before ASCII punctuation, a token ends, but for an apostrophe.
_LETTERS_THEN_MARKS = re.compile(r"([^\W\d_]+)([!-&(-/:-@\[-`{-~]+)")


class WordEncoder:
    """Ids of whole texts, by way of their words' parts: runs of letters, and of what is between them.

    Only for a tokenizer that ignores case, drops white space, tells letters from other characters and
    lets no token reach over either border, so that a text's ids are those of its parts one after the
    other. The parts of many texts are found, told apart and replaced as columns; each distinct one is
    looked up once per call. They are remembered; the memory starts over at ``kept`` entries.
    """

    def __init__(self, model: str, kept: int):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(model)
        for text, parts in (("Ab c\n 9", ["ab", "c", "9"]), ("x  \t y,(z12", ["x", "y", ",(", "z", "12"])):
            alone = [i for p in parts for i in self._ids([p])[0]]
            if self._ids([text])[0] != alone:
                raise ValueError("a tokenizer that keeps white space or case is not supported")
        self.model = self.tokenizer.model
        # Letters go to the model by the tokenizer's own steps, which leave ASCII letters as they are.
        self.direct = self._steps([_ASCII_LETTERS]) == [_ASCII_LETTERS] and \
            [t.id for t in self.model.tokenize(_ASCII_LETTERS)] == self._ids([_ASCII_LETTERS])[0] and \
            all("<|" in t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        self.letters = self._two_byte_letters()
        self.kept = kept
        self.parts: dict[bytes, bytes] = {}

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _steps(self, texts: list[str]) -> list[str] | None:
        """What the model gets of each text; None unless that is one piece each, or if the tokenizer lacks a step."""
        first, second = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        if first is None or second is None:
            return None
        pieces = second.pre_tokenize_str(first.normalize_str(" ".join(texts)))
        return [p for p, _ in pieces] if len(pieces) == len(texts) else None

    def _two_byte_letters(self) -> np.ndarray:
        """Which code points below 0x800 are letters to the tokenizer as to Python, and stay one letter in lower case."""
        found = np.zeros(0x800, dtype=bool)
        for c in range(0x80, 0x800):
            lower = unicodedata.normalize("NFC", chr(c)).lower()
            found[c] = chr(c).isalpha() and len(lower) == 1 and lower.isalpha() and self._steps([f"a{chr(c)}a"]) is not None
        return found

    @staticmethod
    def _parts_of(part: bytes) -> list[bytes]:
        if part.isascii() or b"'" in part or b"<|" in part:
            return [part]
        found = _LETTERS_THEN_MARKS.fullmatch(part.decode())
        # Some letters become a letter and a mark, which would go with what follows.
        if found and unicodedata.normalize("NFC", found[1]).lower().isalnum():
            return [found[1].encode(), found[2].encode()]
        return [part]

    def _encode_parts(self, parts: list[bytes]) -> list[list[int]]:
        """The ids of each: letters by the tokenizer's steps if they allow it, all else by itself as a whole text."""
        texts = [p.decode() for p in parts]
        out: list = [None] * len(texts)
        letters = [k for k, t in enumerate(texts) if t.isalpha()] if self.direct else []
        ready = [(k, texts[k]) for k in letters if parts[k].isascii()]
        letters = [k for k in letters if not parts[k].isascii()]
        for at in range(0, len(letters), 1_000):
            some = letters[at:at + 1_000]
            ready += zip(some, self._steps([texts[k] for k in some]) or [], strict=False)
        tokens = self.model.tokenize
        for k, t in ready:
            out[k] = [x.id for x in tokens(t)]
        rest = [k for k, ids in enumerate(out) if ids is None]
        for at in range(0, len(rest), 5_000):
            some = rest[at:at + 5_000]
            for k, ids in zip(some, self._ids([texts[k] for k in some]), strict=True):
                out[k] = ids
        return out

    def _learn(self, new: list[bytes]) -> list[bytes]:
        """Remember distinct parts that are not known, and return their ids."""
        several = {p: ps for p in new if not p.isascii() and len(ps := self._parts_of(p)) > 1}
        once = [p for p in new if p not in several]
        once += set(chain.from_iterable(several.values())).difference(once, self.parts)
        ids = self._encode_parts(once)
        data = np.fromiter(chain.from_iterable(ids), dtype="<u4").tobytes()
        known = dict(zip(once, _pieces(data, 4 * np.cumsum([0, *map(len, ids)])), strict=True))
        for p, ps in several.items():
            known[p] = b"".join([known[x] if x in known else self.parts[x] for x in ps])
        if len(self.parts) + len(known) > self.kept:
            self.parts = {}
        self.parts.update(known)
        return [known[p] for p in new]

    def _cut(self, buf: np.ndarray) -> tuple[np.ndarray, pa.Array]:
        """Where the parts of a buffer begin, and the parts. The buffer ends with a blank."""
        kind, low = _KINDS[buf], _LOWER[buf]
        lead = np.flatnonzero(buf >> 5 == 6)
        after = buf[lead + 1]
        lead = lead[self.letters[(buf[lead] & 31).astype(np.int64) << 6 | after & 63] & (after >> 6 == 2)]
        kind[lead] = kind[lead + 1] = _LETTER
        special = np.flatnonzero(buf == ord("<"))
        kind[special[buf[special + 1] == ord("|")]] = _ODD
        odd = np.flatnonzero(kind == _ODD)
        if len(odd):
            begin, end = word_spans(buf)
            words = np.unique(np.searchsorted(begin, odd, side="right") - 1)
            size = end[words] - begin[words]
            span = np.repeat(begin[words] - np.cumsum(size) + size, size) + np.arange(size.sum())
            kind[span], low[span] = _ODD, buf[span]
        edge = np.concatenate(([0], np.flatnonzero(kind[1:] != kind[:-1]) + 1))
        solid = np.flatnonzero(kind[edge] != _BLANK)
        starts = edge[solid]
        offsets = np.zeros(len(starts) + 1, dtype=np.int64)
        np.cumsum(edge[solid + 1] - starts, out=offsets[1:])
        return starts, _binary(offsets, pa.py_buffer(low[kind != _BLANK]))

    def encode_column(self, texts: pa.Array, end: bytes) -> pa.Array:
        """The ids of each text as little-endian 32-bit integers, and ``end`` after them. One text at least."""
        buf, begins = joined(texts.to_pylist())
        starts, parts = self._cut(buf)
        coded = parts.dictionary_encode()
        _, offsets, data = coded.dictionary.buffers()
        distinct = _pieces(data.to_pybytes(), np.frombuffer(offsets, dtype=np.int64, count=len(coded.dictionary) + 1))
        ids = list(map(self.parts.get, distinct))
        new = [k for k, x in enumerate(ids) if x is None]
        if new:
            for k, x in zip(new, self._learn([distinct[k] for k in new]), strict=True):
                ids[k] = x
        stops = np.searchsorted(starts, begins[1:])
        which = np.insert(coded.indices.to_numpy(), stops, len(ids))
        found = pa.array([*ids, end], pa.large_binary()).take(pa.array(which))
        offsets = np.frombuffer(found.buffers()[1], dtype=np.int64)
        ends = offsets[stops + np.arange(1, len(stops) + 1)]
        return _binary(np.concatenate(([0], ends)), found.buffers()[2]).cast(pa.binary())

    def encode(self, texts: list[bytes], end: bytes) -> list[bytes]:
        """As ``encode_column``, of lists."""
        return self.encode_column(pa.array(texts, pa.binary()), end).to_pylist()


def _pieces(data: bytes, offsets: np.ndarray) -> list[bytes]:
    ends = offsets.tolist()
    return [data[begin:end] for begin, end in pairwise(ends)]


def _binary(offsets: np.ndarray, data: pa.Buffer) -> pa.Array:
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), data])


_ENCODERS: dict[tuple[int, int], WordEncoder] = {}


def word_encoder(model: str, kept: int) -> WordEncoder:
    """One encoder per process and model."""
    key = (hash(model), kept)
    if key not in _ENCODERS:
        _ENCODERS[key] = WordEncoder(model, kept)
    return _ENCODERS[key]


def default_tokenizer() -> str:
    """Path of the word vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def tokenize(docs: DataFrame, end_id: int = 2, tokenizer_path: str | None = None, rules: FileRules = FileRules()) -> DataFrame:  # noqa: B008
    """``doc_id long, ids binary``, a row per row of ``docs``: 32-bit ids with ``end_id`` after them.

    A null or empty text has the end id alone. Other columns are not read. The tokenizer's file
    is read once, on the driver. No shuffle.
    """
    with open(tokenizer_path or default_tokenizer(), encoding="utf-8") as f:
        model = f.read()
    end = struct.pack("<I", end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(model, rules.words_kept)
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).fill_null(b"")
            for start, stop in text_slices(texts, 2 * SLICE_BYTES):
                ids = encoder.encode_column(texts.slice(start, stop - start), end)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(start, stop - start), ids], names=["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, ids binary")


# --- the coder ---------------------------------------------------------------------


def shares(counts: np.ndarray, bits: int) -> np.ndarray:
    """Frequencies that sum to ``2 ** bits``: at least 1 for every token that occurs, 0 for the others."""
    total, size = int(counts.sum()), 1 << bits
    if np.count_nonzero(counts) > size // 2:
        raise ValueError(f"more tokens than {bits} bits can tell apart")
    if not total:
        return np.zeros(len(counts), dtype=np.int64)
    freq = np.where(counts > 0, np.maximum(1, (counts / total * size).astype(np.int64)), 0)
    spare = size - int(freq.sum())
    order = np.argsort(-freq, kind="stable")
    if spare > 0:
        freq[order[0]] += spare
    while spare < 0:
        for k in order.tolist():
            take = min(int(freq[k]) // 2, -spare)
            freq[k] -= take
            spare += take
            if not spare or freq[k] < 2:
                break
    return freq


class Coder:
    """Encodes and decodes many blocks at a time; each step of numpy handles every lane of every block."""

    def __init__(self, freq: np.ndarray, rules: FileRules):
        self.rules = rules
        self.bits = np.uint64(rules.bits)
        self.freq = freq.astype(np.uint64)
        self.below = np.concatenate(([0], np.cumsum(freq)[:-1])).astype(np.uint64)
        self.table = freq.astype("<u4").tobytes()
        self.crc = zlib.crc32(self.table)
        self.most = int(np.argmax(freq)) if len(freq) else 0
        self._slots: np.ndarray | None = None

    @property
    def slots(self) -> np.ndarray:
        if self._slots is None:
            self._slots = np.repeat(np.arange(len(self.freq), dtype=np.uint32), self.freq.astype(np.int64))
        return self._slots

    def table_record(self) -> bytes:
        return _TABLE.pack(_TABLE_MAGIC, self.rules.bits, len(self.freq), self.crc) + self.table

    @staticmethod
    def from_record(record: bytes, rules: FileRules) -> Coder:
        magic, bits, n, crc = _TABLE.unpack_from(record)
        table = record[_TABLE.size:_TABLE.size + 4 * n]
        if magic != _TABLE_MAGIC or zlib.crc32(table) != crc:
            raise ValueError("the frequency table is damaged")
        return Coder(np.frombuffer(table, dtype="<u4").astype(np.int64), FileRules(**{**rules.__dict__, "bits": bits}))

    def lanes_for(self, n: int) -> int:
        lanes = self.rules.least_lanes
        while lanes * self.rules.steps < n:
            lanes *= 2
        return lanes

    @staticmethod
    def _layout(sizes: list[int], lanes: list[int]):
        """Blocks by falling number of steps, and per lane: its block's first token, stride and steps."""
        steps = [-(-n // k) for n, k in zip(sizes, lanes, strict=True)]
        order = sorted(range(len(sizes)), key=lambda b: -steps[b])
        width = [lanes[b] for b in order]
        edge = np.concatenate(([0], np.cumsum(width))).astype(np.int64)
        per_lane = np.repeat([steps[b] for b in order], width)
        # Lanes that still run at step t: a prefix, as blocks come by falling number of steps.
        running = np.searchsorted(-per_lane, -np.arange(steps[order[0]]), side="left") if order else np.zeros(0, int)
        return order, steps, edge, np.repeat(width, width), running

    def encode(self, blocks: list[np.ndarray]) -> list[tuple[int, bytes]]:
        """(lanes, payload) of each block of ids, none of them empty."""
        every = self.rules.check_every
        sizes = [len(b) for b in blocks]
        lanes = [self.lanes_for(n) for n in sizes]
        order, steps, edge, stride, running = self._layout(sizes, lanes)
        padded, first = [], np.zeros(len(order), dtype=np.int64)
        at = 0
        for k, b in enumerate(order):
            first[k] = at
            padded += [blocks[b], np.full(steps[b] * lanes[b] - sizes[b], self.most, dtype=blocks[b].dtype)]
            at += steps[b] * lanes[b]
        ids = np.concatenate(padded).astype(np.int64)
        place = np.repeat(first, np.diff(edge)) + np.arange(edge[-1]) - np.repeat(edge[:-1], np.diff(edge))
        x = np.full(edge[-1], _LOW, dtype=np.uint64)
        words = np.zeros((len(running), edge[-1]), dtype=np.uint32)
        used = np.zeros(words.shape, dtype=bool)
        limit = self.freq << (np.uint64(63) - self.bits)
        kept = {}
        for t in range(len(running) - 1, -1, -1):
            m = running[t]
            ids_now = ids[place[:m] + t * stride[:m]]
            f, mine = self.freq[ids_now], x[:m]
            big = mine >= limit[ids_now]
            words[t, :m], used[t, :m] = mine & np.uint64(0xFFFFFFFF), big
            mine = np.where(big, mine >> _HALF, mine)
            whole = mine // f
            x[:m] = (whole << self.bits) + (mine - whole * f) + self.below[ids_now]
            if t and t % every == 0:
                kept[t] = x[:m].copy()
        out: list = [None] * len(blocks)
        for k, b in enumerate(order):
            lo, hi, deep = edge[k], edge[k + 1], steps[b]
            mask = used[:deep, lo:hi]
            parts = [x[lo:hi].astype("<u8").tobytes()]
            for t in range(every, deep, every):
                parts += [struct.pack("<I", int(np.count_nonzero(mask[:t]))), kept[t][lo:hi].astype("<u8").tobytes()]
            parts.append(words[:deep, lo:hi][mask].astype("<u4").tobytes())
            out[b] = (lanes[b], b"".join(parts))
        return out

    def decode(self, blocks: list[tuple[int, int, bytes]], begin: int = 0) -> list[np.ndarray]:
        """Ids of (lanes, size, payload) blocks. ``begin`` skips that many checkpoints, and the ids before them."""
        every = self.rules.check_every
        sizes, lanes = [], []
        starts, streams = [], []
        for width, n, payload in blocks:
            checks = (-(-n // width) - 1) // every
            if begin > checks:
                raise ValueError("no such checkpoint")
            at = 8 * width + (begin - 1) * (4 + 8 * width) if begin else 0
            pos = struct.unpack_from("<I", payload, at)[0] if begin else 0
            at += 4 if begin else 0
            starts.append(np.frombuffer(payload, "<u8", width, at))
            streams.append(np.frombuffer(payload, "<u4", -1, 8 * width + checks * (4 + 8 * width))[pos:])
            sizes.append(n - begin * every * width)
            lanes.append(width)
        order, steps, edge, stride, running = self._layout(sizes, lanes)
        if not order:
            return []
        x = np.concatenate([starts[b] for b in order]).astype(np.uint64)
        stream = np.concatenate([*[streams[b] for b in order], np.zeros(1, dtype=np.uint32)]).astype(np.uint64)
        at = np.concatenate(([0], np.cumsum([len(streams[b]) for b in order])[:-1])).astype(np.int64)
        owner = np.repeat(np.arange(len(order)), np.diff(edge))
        ids = np.zeros((len(running), edge[-1]), dtype=np.uint32)
        mask, slots = np.uint64((1 << self.rules.bits) - 1), self.slots
        for t in range(len(running)):
            m = running[t]
            mine = x[:m]
            slot = mine & mask
            ids_now = slots[slot]
            ids[t, :m] = ids_now
            mine = self.freq[ids_now] * (mine >> self.bits) + slot - self.below[ids_now]
            need = np.flatnonzero(mine < _LOW)
            if len(need):
                of = owner[need]
                count = np.bincount(of, minlength=len(order))
                before = np.concatenate(([0], np.cumsum(count)[:-1]))
                mine[need] = (mine[need] << _HALF) | stream[at[of] + np.arange(len(need)) - before[of]]
                at += count
            x[:m] = mine
        out: list = [None] * len(blocks)
        for k, b in enumerate(order):
            out[b] = ids[:steps[b], edge[k]:edge[k + 1]].reshape(-1)[:sizes[b]]
        return out


# --- blocks ------------------------------------------------------------------------


@dataclass(frozen=True)
class Block:
    """A block as read: ``end`` is where the next one begins in the file."""

    doc_id: int | None
    last: bool
    no: int
    lanes: int
    size: int
    payload: bytes
    table_crc: int
    end: int


def pack_block(doc_id: int | None, no: int, last: bool, lanes: int, size: int, payload: bytes, coder: Coder) -> bytes:
    flags = (_NULL_ID if doc_id is None else 0) | (_LAST if last else 0)
    head = _HEAD.pack(_MAGIC, flags, coder.rules.bits, lanes, coder.rules.check_every, 0, doc_id or 0, no, size, len(payload))
    return head + _CHECK.pack(coder.crc, zlib.crc32(payload, zlib.crc32(head))) + payload


def read_block(data: bytes | memoryview, at: int = 0) -> Block:
    """The block that begins at ``at``; a wrong checksum is an error."""
    head = bytes(data[at:at + _HEAD.size])
    magic, flags, _, lanes, _, _, doc_id, no, size, length = _HEAD.unpack(head)
    table_crc, crc = _CHECK.unpack_from(data, at + _HEAD.size)
    begin = at + _HEAD.size + _CHECK.size
    payload = bytes(data[begin:begin + length])
    if magic != _MAGIC or len(payload) != length or zlib.crc32(payload, zlib.crc32(head)) != crc:
        raise ValueError(f"a damaged block at byte {at}")
    return Block(None if flags & _NULL_ID else doc_id, bool(flags & _LAST), no, lanes, size, payload, table_crc,
                 begin + length + len(SEPARATOR))


def blocks_of(data: bytes | memoryview) -> Iterator[Block]:
    at = 0
    while at < len(data):
        block = read_block(data, at)
        yield block
        at = block.end


def block_tokens(block: Block, coder: Coder, start: int, stop: int) -> np.ndarray:
    """Ids ``start`` to ``stop`` of a block, decoded from the last checkpoint before them."""
    if block.table_crc != coder.crc:
        raise ValueError("a block of another frequency table")
    span = coder.rules.check_every * block.lanes
    begin = min(start // span, (-(-block.size // block.lanes) - 1) // coder.rules.check_every)
    ids = coder.decode([(block.lanes, block.size, block.payload)], begin)[0]
    return ids[start - begin * span:stop - begin * span]


# --- files -------------------------------------------------------------------------


def _histogram(tokens: DataFrame) -> np.ndarray:
    """How often each id occurs: one row per id and task, then one per id. As long as the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(0, dtype=np.int64)
        for batch in batches:
            ids = batch.column("ids")
            for start, stop in text_slices(ids, 4 << 20):
                seen = np.bincount(np.frombuffer(b"".join(ids.slice(start, stop - start).to_pylist()), dtype="<u4"))
                if len(seen) > len(counts):
                    counts = np.concatenate((counts, np.zeros(len(seen) - len(counts), dtype=np.int64)))
                counts[:len(seen)] += seen
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(counts[at], pa.int64())], names=["id", "n"])

    rows = tokens.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    ids, n = rows["id"].to_numpy(), rows["n"].to_numpy()
    counts = np.zeros(int(ids.max()) + 1 if len(ids) else 0, dtype=np.int64)
    counts[ids] = n
    return counts


def _shard_of(ids: pa.Array, ties: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The file of each document. An id that fills several files is dealt to them by its rows' ties."""
    known = ids.fill_null(np.iinfo(np.int64).min).to_numpy(zero_copy_only=False)
    first, last = np.searchsorted(bounds, known, side="left"), np.searchsorted(bounds, known, side="right")
    return first + ties % (last - first + 1)


def _coded(freq: np.ndarray, bounds: np.ndarray, rules: FileRules):
    """Arrow batches of documents to batches of their blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(freq, rules)
        for batch in batches:
            for start, stop in text_slices(batch.column("ids"), 4 << 20):
                part = batch.slice(start, stop - start)
                rows, blocks = [], []
                ties = part.column("tie").to_numpy()
                shards = _shard_of(part.column("doc_id"), ties, bounds).tolist()
                for doc_id, tie, shard, ids in zip(part.column("doc_id").to_pylist(), ties.tolist(), shards, part.column("ids"), strict=True):
                    ids = np.frombuffer(ids.as_buffer(), dtype="<u4")
                    for no, at in enumerate(range(0, len(ids), rules.block_tokens)):
                        piece = ids[at:at + rules.block_tokens]
                        rows.append((doc_id, tie, no, at + rules.block_tokens >= len(ids), shard))
                        blocks.append(piece)
                packed = [pack_block(doc_id, no, last, lanes, len(ids), payload, coder)
                          for (doc_id, _, no, last, _), ids, (lanes, payload) in zip(rows, blocks, coder.encode(blocks), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
                     pa.array([r[2] for r in rows], pa.int32()), pa.array([r[4] for r in rows], pa.int32()), pa.array(packed, pa.binary())],
                    names=["doc_id", "tie", "no", "shard", "block"])

    return run


def _write_bytes(rows: DataFrame, path: str) -> None:
    """Files of the rows' bytes, each followed by a line feed."""
    rows.select(F.col(rows.columns[0]).cast("string").alias("value")).write.option("compression", "none").text(path)


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
            docs = tokens = 0
            for block in blocks_of(memoryview(content.as_buffer())):
                docs, tokens = docs + block.last, tokens + block.size
            name = path.rsplit("/", 1)[1]
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(name.split("-")[1])], pa.int64()), pa.array([name]), pa.array([docs], pa.int64()), pa.array([tokens], pa.int64())],
                names=["shard", "file", "n_docs", "n_tokens"])


def write_token_files(tokens: DataFrame, path: str, rules: FileRules = FileRules()) -> None:  # noqa: B008
    """Write ``doc_id long, ids binary`` (32-bit ids, at least one per row) to a new folder, in ascending ``doc_id`` order.

    Null ids come first; rows with equal ids keep an order that doesn't change when a task is
    repeated. Blocks are coded before the shuffle that sorts them, which moves packed bytes only
    and splits rows of one id over files. The manifest is written last, after every block's
    checksum has been tried: a folder without it isn't whole. An empty table gives no blocks.
    """
    spark = tokens.sparkSession
    kept = written(tokens.select("doc_id", "ids"), "tokens", compression="zstd")
    freq = shares(_histogram(kept), rules.bits)
    coder = Coder(freq, rules)
    _write_bytes(spark.createDataFrame([(bytearray(coder.table_record()),)], "value binary").coalesce(1), f"{path}/table")
    total = int(kept.agg(F.sum(F.length("ids"))).first()[0] or 0) // 4
    tie = F.xxhash64(F.col("_metadata.file_path"), F.col("_metadata.row_index"))
    n = parts_for(spark, total, rules.shard_tokens)
    # Bounds come from the ids alone: a range partitioning of the blocks would code them a first time to sample them.
    cuts = kept.agg(F.percentile_approx("doc_id", [k / n for k in range(1, n)], 10 * n)).first()[0] if n > 1 else None
    coded = kept.withColumn("tie", tie).select("doc_id", "tie", "ids").mapInArrow(
        _coded(freq, np.array(cuts or [], dtype=np.int64), rules), "doc_id long, tie long, no int, shard int, block binary")
    placed = coded.repartitionById(n, "shard").sortWithinPartitions("doc_id", "tie", "no")
    _write_bytes(placed.select("block"), f"{path}/shards")
    files = _files(spark, path).mapInArrow(_totals, "shard long, file string, n_docs long, n_tokens long")
    written(files, "token-shards").withColumn(
        "first", F.coalesce(F.sum("n_tokens").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
    ).write.parquet(f"{path}/manifest")


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{path}/shards").filter("length > 0").select("path", "content")


def read_coder(spark: SparkSession, path: str, rules: FileRules = FileRules()) -> Coder:  # noqa: B008
    """The coder of a folder's frequency table."""
    record = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{path}/table").select("content").first()[0]
    return Coder.from_record(bytes(record), rules)


def read_token_files(spark: SparkSession, path: str, rules: FileRules = FileRules()) -> DataFrame:  # noqa: B008
    """``doc_id, start, n_tokens, ids`` of a whole folder: ``start`` counts the ids of all documents before it.

    A task decodes whole files, some blocks at a time. A damaged block is an error. The manifest
    has a row per file and is joined by name. No shuffle of ids.
    """
    coder = read_coder(spark, path, rules)
    freq, rules = coder.freq.astype(np.int64), coder.rules

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(freq, rules)

        def decoded(name: str, data: memoryview) -> Iterator[pa.RecordBatch]:
            at, open_ids, held, tokens = 0, [], [], 0

            def emit() -> pa.RecordBatch:
                nonlocal at, open_ids
                rows = []
                for block, ids in zip(held, coder.decode([(b.lanes, b.size, b.payload) for b in held]), strict=True):
                    open_ids.append(ids)
                    if block.last:
                        whole = np.concatenate(open_ids).astype("<u4")
                        rows.append((block.doc_id, at, len(whole), whole.tobytes()))
                        at, open_ids = at + len(whole), []
                return pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(rows), pa.string()), *[pa.array([r[k] for r in rows], pa.int64()) for k in range(3)],
                     pa.array([r[3] for r in rows], pa.binary())], names=["file", "doc_id", "at", "n_tokens", "ids"])

            for block in blocks_of(data):
                if block.table_crc != coder.crc:
                    raise ValueError("a block of another frequency table")
                held.append(block)
                tokens += block.size
                if tokens >= 1 << 20:
                    yield emit()
                    held, tokens = [], 0
            if held:
                yield emit()

        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                yield from decoded(path.rsplit("/", 1)[1], memoryview(content.as_buffer()))

    docs = _files(spark, path).mapInArrow(run, "file string, doc_id long, at long, n_tokens long, ids binary")
    places = spark.read.parquet(f"{path}/manifest").select("file", "first")
    return docs.join(places, "file").select("doc_id", (F.col("first") + F.col("at")).alias("start"), "n_tokens", "ids")
