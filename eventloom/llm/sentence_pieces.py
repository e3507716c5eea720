"""Encode and decode texts with a piece vocabulary: Viterbi forward, A-star backward for the N best.

A text becomes a mark for each space, with one more mark in front, and a lattice of pieces over
its characters. Characters without a piece are spelled in bytes. A segmentation's score is the
sum of its pieces' scores in the model file. No piece has a mark behind another character, so the
lattice falls apart into segments; equal segments are worked out once.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix, span_hashes, text_slices

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
_BASE = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class PieceRules:
    """``n_best`` segmentations are scored. A byte costs ``byte_cost`` more than the worst piece.

    ``cached`` segments at most are remembered by a task; it starts over beyond that.
    """

    n_best: int = 4
    byte_cost: float = 10.0
    cached: int = 400_000


class Vocabulary:
    """Pieces, scores and prefixes of a model file, as tables."""

    def __init__(self, model: bytes, rules: PieceRules):
        pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
        if pieces.normalize("ﬁ  x") != f"{MARK}ﬁ{MARK}{MARK}x":
            raise ValueError("a model that rewrites its text can't be decoded exactly")
        self.pieces = [pieces.id_to_piece(k) for k in range(pieces.get_piece_size())]
        usable = [k for k in range(len(self.pieces)) if not (
            pieces.is_control(k) or pieces.is_unknown(k) or pieces.is_byte(k) or pieces.is_unused(k))]
        if any(MARK in self.pieces[k].lstrip(MARK) for k in usable):
            raise ValueError("pieces that reach over a space are not supported")
        self.scores = np.array([pieces.get_score(k) for k in range(len(self.pieces))])
        ordinary = [self.scores[k] for k in usable if self.scores[k] > -1e8]
        self.byte_score = min(ordinary) - rules.byte_cost
        self.byte_ids = np.array([pieces.piece_to_id(f"<0x{b:02X}>") for b in range(256)])
        self.ids = {self.pieces[k]: k for k in usable}
        self.longest = max(map(len, self.ids))
        self.bytes_of = [p.replace(MARK, " ").encode() for p in self.pieces]
        for b, k in enumerate(self.byte_ids.tolist()):
            self.bytes_of[k] = bytes([b])
        #: Characters that stand in no longer piece: the lattice has an edge on either side of them.
        self.alone = np.ones(0x110000, dtype=bool)
        for piece in self.ids:
            if len(piece) > 1:
                self.alone[[ord(c) for c in piece]] = False

        prefixes = {p[:n] for p in self.ids for n in range(1, len(p) + 1)}
        names = sorted(prefixes)
        self.prefix_hash = np.array([self._hash(p) for p in names], dtype=np.uint64)
        self.prefix_piece = np.array([self.ids.get(p, -1) for p in names], dtype=np.int32)
        self.size = np.uint64((1 << 21) - 1)
        self.slots = [np.full(1 << 21, -1, dtype=np.int32) for _ in range(2)]
        rest = np.arange(len(names))
        for turn, table in enumerate(self.slots):
            at = self._slot(self.prefix_hash[rest], turn)
            table[at[::-1]] = rest[::-1]
            rest = rest[table[at] != rest]
        if len(rest):
            raise ValueError("two prefixes share both places")

    @staticmethod
    def _hash(piece: str) -> int:
        h = 0
        for c in piece:
            h = (h * int(_BASE) + ord(c) + 1) & 0xFFFFFFFFFFFFFFFF
        return h

    def _slot(self, hashes: np.ndarray, turn: int) -> np.ndarray:
        return (mix(hashes) >> np.uint64(0 if turn else 32)) & self.size

    def prefix(self, hashes: np.ndarray) -> np.ndarray:
        """Number of the prefix with each hash, -1 for none."""
        found = self.slots[0][self._slot(hashes, 0)]
        wrong = np.flatnonzero((found < 0) | (self.prefix_hash[found] != hashes))
        again = self.slots[1][self._slot(hashes[wrong], 1)]
        found[wrong] = np.where((again >= 0) & (self.prefix_hash[again] == hashes[wrong]), again, -1)
        return found


def code_points(text: str) -> np.ndarray:
    """A text as the lattice sees it, a number per character."""
    return np.frombuffer((MARK + text.replace(" ", MARK)).encode("utf-32-le", "surrogatepass"), dtype=np.uint32) if text else np.zeros(0, np.uint32)


def segment_starts(points: np.ndarray, text_starts: np.ndarray, vocabulary: Vocabulary) -> np.ndarray:
    """Where segments begin: at texts, at runs of marks, and on both sides of lonely characters."""
    cut = np.zeros(len(points), dtype=bool)
    mark = points == ord(MARK)
    alone = vocabulary.alone[points]
    cut[1:] = (mark[1:] & ~mark[:-1]) | alone[1:] | alone[:-1]
    cut[text_starts[text_starts < len(points)]] = True
    return np.flatnonzero(cut)


@dataclass
class Lattice:
    """Edges over many segments: node numbers, piece ids (-1: bytes), scores, in order of their ends."""

    node_starts: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    piece: np.ndarray
    score: np.ndarray
    point: np.ndarray


def build_lattice(points: np.ndarray, starts: np.ndarray, vocabulary: Vocabulary) -> Lattice:
    """All edges of segments that lie one after the other in ``points``; a segment has a node more than characters."""
    ends = np.append(starts[1:], len(points))
    sizes = ends - starts
    of = np.repeat(np.arange(len(starts)), sizes)
    live = np.arange(len(points))
    hashes = np.zeros(len(points), dtype=np.uint64)
    begins, stops, pieces = [], [], []
    single = np.zeros(len(points), dtype=bool)
    for n in range(vocabulary.longest):
        if not len(live):
            break
        hashes = hashes * _BASE + points[live + n].astype(np.uint64) + np.uint64(1)
        at = vocabulary.prefix(hashes)
        ids = np.where(at >= 0, vocabulary.prefix_piece[at], -1)
        hit = ids >= 0
        begins.append(live[hit])
        stops.append(live[hit] + n + 1)
        pieces.append(ids[hit])
        if n == 0:
            single[live[hit]] = True
        keep = (at >= 0) & (live + n + 1 < ends[of[live]])
        live, hashes = live[keep], hashes[keep]
    spelled = np.flatnonzero(~single)
    begin = np.concatenate([*begins, spelled])
    end = np.concatenate([*stops, spelled + 1])
    piece = np.concatenate([*pieces, np.full(len(spelled), -1)])
    order = np.lexsort((begin, end))
    begin, end, piece = begin[order], end[order], piece[order]
    point = points[begin]
    width = 1 + (point >= 0x80).astype(np.int64) + (point >= 0x800) + (point >= 0x10000)
    score = np.where(piece >= 0, vocabulary.scores[piece], vocabulary.byte_score * width)
    shift = of[begin]
    return Lattice(starts + np.arange(len(starts)), begin + shift, end + shift, piece, score, point)


def _waves(depth: np.ndarray) -> Iterator[np.ndarray]:
    """Edge numbers of equal depth, shallow ones first; inside a wave they keep their order."""
    order = np.argsort(depth, kind="stable")
    cuts = np.flatnonzero(np.diff(depth[order], prepend=-1))
    yield from np.split(order, cuts[1:]) if len(order) else ()


def forward(lattice: Lattice, n_nodes: int, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best score from the segment's begin to each node, and the edge it comes by (the longest piece on ties)."""
    best, via = np.zeros(n_nodes), np.full(n_nodes, -1)
    for edges in _waves(depth[lattice.end]):
        to = lattice.end[edges]
        heads = np.flatnonzero(np.diff(to, prepend=-1))
        value = best[lattice.begin[edges]] + lattice.score[edges]
        top = np.maximum.reduceat(value, heads)
        group = np.repeat(np.arange(len(heads)), np.diff(np.append(heads, len(to))))
        first = np.flatnonzero(value == top[group])
        _, where = np.unique(group[first], return_index=True)
        best[to[heads]], via[to[heads]] = top, edges[first[where]]
    return best, via


def backward(lattice: Lattice, n_nodes: int, depth: np.ndarray) -> np.ndarray:
    """Best score from each node to its segment's end."""
    best = np.zeros(n_nodes)
    by_begin = np.lexsort((lattice.end, lattice.begin))
    for edges in reversed(list(_waves(depth[lattice.begin[by_begin]]))):
        edges = by_begin[edges]
        start = lattice.begin[edges]
        heads = np.flatnonzero(np.diff(start, prepend=-1))
        best[start[heads]] = np.maximum.reduceat(lattice.score[edges] + best[lattice.end[edges]], heads)
    return best


def segment_all(points: np.ndarray, starts: np.ndarray, vocabulary: Vocabulary) -> tuple[np.ndarray, ...]:
    """For each segment: tokens (offsets and ids), best score, and how much the second best loses."""
    lattice = build_lattice(points, starts, vocabulary)
    sizes = np.diff(np.append(starts, len(points)))
    n_nodes = len(points) + len(starts)
    depth = np.arange(n_nodes) - np.repeat(lattice.node_starts, sizes + 1)
    alpha, via = forward(lattice, n_nodes, depth)
    beta = backward(lattice, n_nodes, depth)
    last = lattice.node_starts + sizes

    on_best = np.zeros(len(lattice.begin), dtype=bool)
    node = last[sizes > 0]
    while len(node):
        edge = via[node]
        on_best[edge] = True
        node = lattice.begin[edge]
        node = node[depth[node] > 0]
    through = np.where(on_best, -np.inf, alpha[lattice.begin] + lattice.score + beta[lattice.end])
    of_edge = np.searchsorted(lattice.node_starts, lattice.begin, side="right") - 1
    heads = np.searchsorted(of_edge, np.arange(len(starts)))
    second = np.maximum.reduceat(through, heads) if len(starts) else np.zeros(0)
    loss = np.where(np.isfinite(second), alpha[last] - second, np.inf)

    chosen = np.flatnonzero(on_best)
    point, piece = lattice.point[chosen], lattice.piece[chosen]
    width = np.where(piece >= 0, 1, 1 + (point >= 0x80).astype(np.int64) + (point >= 0x800) + (point >= 0x10000))
    counts = np.bincount(of_edge[chosen], weights=width, minlength=len(starts)).astype(np.int64)
    offsets = np.concatenate(([0], np.cumsum(counts)))
    ids = np.repeat(piece, width).astype(np.int32)
    spelled = np.flatnonzero(piece < 0)
    if len(spelled):
        ids[ids < 0] = vocabulary.byte_ids[np.frombuffer(
            "".join(map(chr, point[spelled].tolist())).encode("utf-8", "surrogatepass"), dtype=np.uint8)]
    return offsets, ids, alpha[last], loss


def n_best_paths(points: np.ndarray, starts: np.ndarray, n: int, vocabulary: Vocabulary) -> list[list[tuple[float, list[int]]]]:
    """For each segment its n best segmentations, best first: a backward A-star search over one lattice of all.

    A partial path's bound is its own score plus the forward Viterbi score of the node it has
    reached. That bound is exact, so paths come out in order of their scores. Of paths with the
    same bound the one nearest to the begin goes on, so that a run of equal characters, which
    has very many equally good paths, is walked through once per path that is asked for.
    """
    lattice = build_lattice(points, starts, vocabulary)
    sizes = np.diff(np.append(starts, len(points)))
    n_nodes = len(points) + len(starts)
    alpha, _ = forward(lattice, n_nodes, np.arange(n_nodes) - np.repeat(lattice.node_starts, sizes + 1))
    # Edges are in order of their ends: those that arrive at a node are neighbours.
    arriving = np.searchsorted(lattice.end, np.arange(n_nodes + 1)).tolist()
    begin, score, bound = lattice.begin.tolist(), lattice.score.tolist(), alpha.tolist()
    out = []
    for root, last in zip(lattice.node_starts.tolist(), (lattice.node_starts + sizes).tolist(), strict=True):
        heap: list[tuple] = [(-round(bound[last], 6), last, 0, 0.0, None)]
        found: list[tuple[float, list[int]]] = []
        pushed = 0
        while heap and len(found) < n:
            _, node, _, done, path = heapq.heappop(heap)
            if node == root:
                ids = []
                while path is not None:
                    edge, path = path
                    piece = int(lattice.piece[edge])
                    ids.extend([piece] if piece >= 0 else vocabulary.byte_ids[list(chr(lattice.point[edge]).encode())].tolist())
                found.append((done, ids))
                continue
            for edge in range(arriving[node], arriving[node + 1]):
                pushed += 1
                now = done + score[edge]
                heapq.heappush(heap, (-round(bound[begin[edge]] + now, 6), begin[edge], pushed, now, (edge, path)))
        out.append(found)
    return out


def merged_best(choices: list[list[float]], n: int) -> list[tuple[float, tuple[int, ...]]]:
    """The n smallest sums that take one loss of each list, with the number taken from each."""
    best: list[tuple[float, tuple[int, ...]]] = [(0.0, ())]
    for losses in choices:
        best = heapq.nsmallest(n, [(s + x, (*picked, k)) for s, picked in best for k, x in enumerate(losses)])
    return best


#: Score, number of tokens, and what differs from the best ids: (first token, tokens that go, ids that come), in order.
Best = tuple[float, int, list[tuple[int, int, list[int]]]]


class Encoder:
    """Encodes batches of texts; keeps the segments it has seen."""

    def __init__(self, model: bytes, rules: PieceRules):
        self.rules, self.vocabulary = rules, Vocabulary(model, rules)
        self._forget()

    def _forget(self) -> None:
        self.keys = np.zeros(0, dtype=np.uint64)
        self.at = np.zeros(0, dtype=np.int64)
        self.offsets, self.ids = np.zeros(1, dtype=np.int64), np.zeros(0, dtype=np.int32)
        self.score, self.loss, self.exact = np.zeros(0), np.zeros(0), np.zeros(0, dtype=bool)
        #: Losses and ids of the N best paths, by row of a segment that was asked for; the Viterbi path is the first.
        self.paths: dict[int, list[tuple[float, list[int]]]] = {}

    def _learn(self, keys: np.ndarray, points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        """Work out segments not seen before; ``keys`` are distinct and in order."""
        if len(self.keys) + len(keys) > self.rules.cached:
            self._forget()
        sizes = ends - starts
        begins = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        flat = points[np.repeat(starts - begins, sizes) + np.arange(sizes.sum())]
        offsets, ids, score, loss = segment_all(flat, begins, self.vocabulary)
        rows = np.arange(len(keys)) + len(self.score)
        self.offsets = np.concatenate((self.offsets, self.offsets[-1] + offsets[1:]))
        self.ids = np.concatenate((self.ids, ids))
        self.score, self.loss = np.concatenate((self.score, score)), np.concatenate((self.loss, loss))
        self.exact = np.concatenate((self.exact, self._restored(flat, begins, offsets, ids)))
        between = np.searchsorted(self.keys, keys)
        self.keys, self.at = np.insert(self.keys, between, keys), np.insert(self.at, between, rows)

    def _restored(self, points: np.ndarray, starts: np.ndarray, offsets: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """For each segment whether the bytes of its ids are its characters, a mark for a space."""
        table = self.vocabulary.bytes_of
        want = np.where(points == ord(MARK), ord(" "), points).astype("<u4").tobytes()
        parts = [table[k] for k in ids.tolist()]
        if b"".join(parts) == want.decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass"):
            return np.ones(len(starts), dtype=bool)
        ends = np.append(starts[1:], len(points)).tolist()
        return np.array([b"".join(parts[offsets[k]:offsets[k + 1]])
                         == want[4 * a:4 * z].decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass")
                         for k, (a, z) in enumerate(zip(starts.tolist(), ends, strict=True))], dtype=bool)

    def _rows(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(keys), -1)
        where = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[where] == keys, self.at[where], -1)

    def encode(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, float, list[Best], bool]]:
        """For each text its ids, its score, its N best segmentations, and whether the ids decode to it."""
        each = [code_points(t or "") for t in texts]
        text_starts = np.concatenate(([0], np.cumsum([len(x) for x in each])))
        points = np.concatenate([*each, np.zeros(0, np.uint32)])
        starts = segment_starts(points, text_starts[:-1], self.vocabulary)
        ends = np.append(starts[1:], len(points))
        keys, sample, inverse = np.unique(span_hashes(points, starts, ends), return_index=True, return_inverse=True)
        new = np.flatnonzero(self._rows(keys) < 0)
        if len(new):
            kept = len(self.keys)
            self._learn(keys[new], points, starts[sample[new]], ends[sample[new]])
            if len(self.keys) < kept + len(new):  # it started over: the others are gone too
                rest = np.flatnonzero(self._rows(keys) < 0)
                if len(rest):
                    self._learn_on_top(keys[rest], points, starts[sample[rest]], ends[sample[rest]])
        row = self._rows(keys)[inverse]
        counts = np.diff(self.offsets)[row]
        token_ends = np.cumsum(counts)
        total = int(token_ends[-1]) if len(row) else 0
        ids = self.ids[np.repeat(self.offsets[row] - (token_ends - counts), counts) + np.arange(total)]
        score, loss, exact = self.score[row], self.loss[row], self.exact[row]
        cuts = np.searchsorted(starts, text_starts)
        at_token = np.concatenate(([0], token_ends))
        closest = [self._closest(loss[a:z]) + a for a, z in zip(cuts[:-1], cuts[1:], strict=True)]
        self._search(np.concatenate([*closest, np.zeros(0, np.int64)]), row, points, starts, ends)
        for k, text in enumerate(texts):
            first, stop = cuts[k], cuts[k + 1]
            begin = at_token[first]
            mine = ids[begin:at_token[stop]]
            if first == stop:
                yield mine, 0.0, [], True
                continue
            whole = float(np.sum(score[first:stop]))
            places = closest[k].tolist()
            choices = [self.paths[int(row[p])] for p in places]
            best = []
            for lost, picked in merged_best([[x for x, _ in c] for c in choices], self.rules.n_best):
                changes = [(int(at_token[p] - begin), int(counts[p]), c[way][1])
                           for p, c, way in zip(places, choices, picked, strict=True) if way]
                best.append((whole - lost, len(mine) + sum(len(x) - n for _, n, x in changes), changes))
            yield mine, whole, best, MARK not in text and bool(exact[first:stop].all())

    def _search(self, places: np.ndarray, row: np.ndarray, points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        """Find the N best paths of the segments at ``places``, each distinct one once, all in one lattice."""
        rows, first = np.unique(row[places], return_index=True)
        new = np.array([r not in self.paths for r in rows.tolist()], dtype=bool)
        if not new.any():
            return
        rows, at = rows[new], places[first[new]]
        sizes = ends[at] - starts[at]
        begins = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        flat = points[np.repeat(starts[at] - begins, sizes) + np.arange(sizes.sum())]
        for r, found in zip(rows.tolist(), n_best_paths(flat, begins, self.rules.n_best, self.vocabulary), strict=True):
            own = self.ids[self.offsets[r]:self.offsets[r + 1]].tolist()
            # Among equally good paths the search may find another one first.
            others = [(found[0][0] - s, x) for s, x in found if x != own]
            self.paths[r] = [(0.0, own), *others][:self.rules.n_best]

    def _learn_on_top(self, keys: np.ndarray, points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        cached, self.rules = self.rules, PieceRules(self.rules.n_best, self.rules.byte_cost, 1 << 62)
        self._learn(keys, points, starts, ends)
        self.rules = cached

    def _closest(self, losses: np.ndarray) -> np.ndarray:
        """Segments that the n best can differ in: the n - 1 with the least loss, earlier ones first on ties."""
        n = self.rules.n_best - 1
        if n < 1:
            return np.zeros(0, dtype=np.int64)
        if len(losses) > n:
            limit = np.partition(losses, n - 1)[n - 1]
            under, equal = np.flatnonzero(losses < limit), np.flatnonzero(losses == limit)
            places = np.sort(np.concatenate((under, equal[:n - len(under)])))
        else:
            places = np.arange(len(losses))
        return places[np.isfinite(losses[places])]

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids, without the mark in front; broken bytes become replacement characters."""
        table = self.vocabulary.bytes_of
        text = b"".join([table[k] for k in ids.tolist()]).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


_ENCODERS: dict[tuple, Encoder] = {}


def encoder_for(model: bytes, rules: PieceRules) -> Encoder:
    """One encoder per process, model and rules."""
    key = (hash(model), rules)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(model, rules)
    return _ENCODERS[key]


def _model(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


ENCODED = ("n_tokens long, score double, "
           "n_best array<struct<score: double, n_tokens: int, changes: array<struct<at: int, n: int, ids: array<int>>>>>, "
           "restored boolean, ids array<int>")
_CHANGE = pa.struct([("at", pa.int32()), ("n", pa.int32()), ("ids", pa.list_(pa.int32()))])
_BEST = pa.list_(pa.struct([("score", pa.float64()), ("n_tokens", pa.int32()), ("changes", pa.list_(_CHANGE))]))


def encode_documents(docs: DataFrame, model_path: str = MODEL, rules: PieceRules = PieceRules()) -> DataFrame:  # noqa: B008
    """``doc_id, n_tokens, score, n_best, restored, ids``, a row per row of ``docs``.

    ``n_best`` has the best segmentations, best first, fewer where there are no more: score, length, and
    how they differ from ``ids`` (``n_best_ids`` gives the ids of each). ``restored``: decoding gives the text back, which holds but for texts with the
    mark character itself. Null and empty texts have no ids, and are restored. The model file is
    read once, on the driver. Other columns are not read. No shuffle.
    """
    model = _model(model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_for(model, rules)
        for batch in batches:
            for start, stop in text_slices(batch.column("text")):
                texts = batch.column("text").slice(start, stop - start).to_pylist()
                ids, scores, best, restored = [], [], [], []
                for mine, score, top, same in encoder.encode(texts):
                    ids.append(mine)
                    scores.append(score)
                    best.append([{"score": s, "n_tokens": k, "changes": [dict(zip(("at", "n", "ids"), c, strict=True)) for c in changes]}
                                 for s, k, changes in top])
                    restored.append(same)
                offsets = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(start, stop - start), pa.array(np.diff(offsets), pa.int64()),
                     pa.array(scores, pa.float64()), pa.array(best, _BEST),
                     pa.array(restored, pa.bool_()), pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(ids)))],
                    names=["doc_id", "n_tokens", "score", "n_best", "restored", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, {ENCODED}")


def n_best_ids(encoded: DataFrame) -> DataFrame:
    """``doc_id, rank, score, ids``: a row per segmentation in ``n_best``, the best with rank 1. No shuffle.

    ``decode_documents`` gives the text back from any of them. Texts without ids have no rows.
    """
    each = encoded.select("doc_id", F.col("ids").alias("first"), F.posexplode("n_best").alias("rank", "one"))
    # From the last change to the first, so that the places of the others stay right.
    ids = F.aggregate(F.reverse("one.changes"), F.col("first"), lambda ids, c: F.concat(
        F.slice(ids, F.lit(1), c["at"]), c["ids"], F.slice(ids, c["at"] + c["n"] + 1, F.size(ids))))
    return each.select("doc_id", (F.col("rank") + 1).alias("rank"), F.col("one.score").alias("score"), ids.alias("ids"))


def decode_documents(encoded: DataFrame, model_path: str = MODEL, rules: PieceRules = PieceRules()) -> DataFrame:  # noqa: B008
    """``doc_id, text`` from ``doc_id, ids``; null ids give a null text. No shuffle."""
    model = _model(model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_for(model, rules)
        for batch in batches:
            texts = [None if x is None else encoder.decode(np.array(x, dtype=np.int64)) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", F.col("ids").cast("array<int>").alias("ids")).mapInArrow(run, f"doc_id {kind}, text string")
