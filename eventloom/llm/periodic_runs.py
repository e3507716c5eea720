"""Periodic runs of words: maximal stretches that repeat a period four times or more.

Every run has a root that is a Lyndon word under the order of the words or its reverse, and is the
longest one from its first word on. So each position gives two candidate roots; each is extended
forward and backward by longest common extensions, which are depths of lowest common ancestors in
the suffix trees of the text and of its reversal. Ukkonen's algorithm builds the trees; an Euler
tour with a table of range minima answers each query in constant time.

A run of period q holds at least 4 q words, so that each of its 3-word windows occurs at least
three times in it. Windows that occur less often in their stretch cut the text into stretches, none
of which a run can leave, and trees are built over these only. That loses no run.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import joined, mix, owners, span_hashes, text_slices, word_spans

LEAST_WORDS, LEAST_EXPONENT = 6, 4
_WINDOW, _TIMES = 3, 3


# --- suffix tree --------------------------------------------------------------------


@dataclass(frozen=True)
class SuffixTree:
    """A suffix tree as arrays: node 0 is the root. ``suffix`` is -1 at inner nodes.

    Children are sorted by parent and first symbol; ``symbol`` is that of the edge to them.
    """

    parent: np.ndarray
    symbol: np.ndarray
    child: np.ndarray
    depth: np.ndarray
    suffix: np.ndarray


def suffix_tree(text: list[int]) -> SuffixTree:
    """Ukkonen's tree of positive numbers, with a 0 put at the end. Linear time, no recursion."""
    text = [*text, 0]
    n, base = len(text), max(text) + 1
    begin, end, link = [0], [0], [0]
    edges: dict[int, int] = {}
    node = edge_at = length = 0
    waiting = 0
    for i in range(n):
        c = text[i]
        waiting += 1
        made = 0
        while waiting:
            if not length:
                edge_at = i
            key = node * base + text[edge_at]
            nxt = edges.get(key)
            if nxt is None:
                edges[key] = len(begin)
                begin.append(i)
                end.append(n)
                link.append(0)
                if made:
                    link[made] = node
                    made = 0
            else:
                stop = end[nxt]
                span = (stop if stop <= i else i + 1) - begin[nxt]
                if length >= span:
                    node, edge_at, length = nxt, edge_at + span, length - span
                    continue
                at = begin[nxt]
                if text[at + length] == c:
                    length += 1
                    if made:
                        link[made] = node
                    break
                split = len(begin)
                edges[key] = split
                begin += [at, i]
                end += [at + length, n]
                link += [0, 0]
                edges[split * base + c] = split + 1
                begin[nxt] = at + length
                edges[split * base + text[at + length]] = nxt
                if made:
                    link[made] = split
                made = split
            waiting -= 1
            if node:
                node = link[node]
            elif length:
                length -= 1
                edge_at = i - waiting + 1
    keys = np.fromiter(edges.keys(), dtype=np.int64, count=len(edges))
    child = np.fromiter(edges.values(), dtype=np.int64, count=len(edges))
    order = np.argsort(keys)
    parent, symbol, child = keys[order] // base, keys[order] % base, child[order]
    span = np.array(end) - np.array(begin)
    up = np.zeros(len(begin), dtype=np.int64)
    up[child] = parent
    depth, far = span.copy(), up.copy()
    while far.any():  # each node adds the depth of ever farther ancestors
        depth = depth + depth[far]
        far = far[far]
    leaf = np.ones(len(begin), dtype=bool)
    leaf[parent] = False
    leaf[0] = False
    return SuffixTree(parent, symbol, child, depth, np.where(leaf, n - depth, -1))


class Tour:
    """Euler tour over a tree, with range minima of depths between leaves.

    The tour's depths between two leaves that follow each other matter only by their least one,
    so the table has a column per leaf.
    """

    def __init__(self, tree: SuffixTree, backward: bool = False):
        size = len(tree.depth)
        order = np.arange(len(tree.child))
        if backward:  # symbols from high to low, the end still first
            order = np.lexsort((np.where(tree.symbol == 0, -1, -tree.symbol + tree.symbol.max()), tree.parent))
        child = tree.child[order].tolist()
        first = np.searchsorted(tree.parent, np.arange(size + 1)).tolist()
        depth, suffix = tree.depth.tolist(), tree.suffix.tolist()
        leaves: list[int] = []
        lows: list[int] = []
        low = 0
        stack = [(0, first[0])]
        while stack:
            node, at = stack.pop()
            if depth[node] < low:
                low = depth[node]
            if at < first[node + 1]:
                stack.append((node, at + 1))
                nxt = child[at]
                if suffix[nxt] >= 0:
                    leaves.append(suffix[nxt])
                    lows.append(low)
                    low = depth[node]
                else:
                    stack.append((nxt, first[nxt]))
        self.rank = np.empty(len(leaves), dtype=np.int64)
        self.rank[leaves] = np.arange(len(leaves))
        # lows[k] is the least depth on the way from leaf k - 1 to leaf k.
        table = [np.array(lows, dtype=np.int32)]
        while 2 << len(table) - 1 <= len(lows):
            half = 1 << len(table) - 1
            table.append(np.minimum(table[-1][:-half], table[-1][half:]))
        self.table = table

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Longest common extension from positions ``a`` and ``b``, different in each pair."""
        a, b = self.rank[a], self.rank[b]
        lo, hi = np.minimum(a, b) + 1, np.maximum(a, b) + 1
        level = np.frexp((hi - lo).astype(np.float64))[1] - 1
        out = np.empty(len(lo), dtype=np.int64)
        for k in np.unique(level).tolist():
            at = level == k
            out[at] = np.minimum(self.table[k][lo[at]], self.table[k][hi[at] - (1 << k)])
        return out


def _next_smaller(rank: list[int]) -> np.ndarray:
    """Next position with a smaller suffix: where the longest Lyndon word from here ends."""
    out = [0] * len(rank)
    stack: list[int] = []
    for i in range(len(rank) - 1, -1, -1):
        r = rank[i]
        while stack and rank[stack[-1]] > r:
            stack.pop()
        out[i] = stack[-1] if stack else len(rank)
        stack.append(i)
    return np.array(out, dtype=np.int64)


def runs_of(text: np.ndarray) -> np.ndarray:
    """Runs of a sequence of numbers as rows ``start, length, period``, by start and period."""
    n = len(text)
    if n < LEAST_WORDS:
        return np.zeros((0, 3), dtype=np.int64)
    ids = (np.unique(text, return_inverse=True)[1] + 1).tolist()
    tree = suffix_tree(ids)
    forward = Tour(tree)
    root = np.concatenate([_next_smaller(forward.rank.tolist())[:n], _next_smaller(Tour(tree, backward=True).rank.tolist())[:n]])
    del tree
    start = np.tile(np.arange(n), 2)
    roots = np.unique(np.stack((start, root), axis=1), axis=0)
    roots = roots[roots[:, 0] + LEAST_EXPONENT * (roots[:, 1] - roots[:, 0]) <= n + roots[:, 0]]
    i, j = roots[:, 0], roots[:, 1]
    right = forward.common(i, j)
    del forward
    back = Tour(suffix_tree(ids[::-1]))
    left = np.zeros(len(i), dtype=np.int64)
    inner = np.flatnonzero(i > 0)
    left[inner] = back.common(n - i[inner], n - j[inner])
    period = j - i
    length = left + period + right
    keep = length >= np.maximum(LEAST_WORDS, LEAST_EXPONENT * period)
    found = np.stack((i - left, length, period), axis=1)[keep]
    return np.unique(found[:, [0, 2, 1]], axis=0)[:, [0, 2, 1]] if len(found) else found


# --- stretches that can hold a run ---------------------------------------------------


def stretches(owner: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of the stretches of words that can hold a run, by ``owner`` (rising) and word hashes.

    Windows are counted by a hash; equal hashes of different windows keep more words, never fewer.
    """
    n = len(words)
    if n < LEAST_WORDS:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    last = n - _WINDOW + 1
    window = mix(mix(mix(words[:last]) + words[1:last + 1]) + words[2:])
    at = np.flatnonzero(owner[:last] == owner[2:])
    group = owner[at].astype(np.int64)
    while True:
        key = mix(window[at] ^ mix(group.astype(np.uint64)))
        order = np.argsort(key, kind="stable")
        edge = np.flatnonzero(np.concatenate(([True], np.diff(key[order]) != 0))) if len(order) else order
        count = np.diff(np.concatenate((edge, [len(order)])))
        often = np.empty(len(order), dtype=bool)
        often[order] = np.repeat(count >= _TIMES, count)
        kept = at[often]
        # A gap between windows, or another text, begins a new stretch; short ones can't hold a run.
        new = np.concatenate(([True], (np.diff(kept) != 1) | (np.diff(owner[kept]) != 0))) if len(kept) else np.zeros(0, dtype=bool)
        stretch = np.cumsum(new) - 1
        size = np.bincount(stretch) if len(kept) else np.zeros(0, dtype=np.int64)
        enough = size >= LEAST_WORDS - _WINDOW + 1
        if often.all() and enough.all():
            return kept[new], kept[new] + size + _WINDOW - 1
        inside = enough[stretch] if len(kept) else np.zeros(0, dtype=bool)
        at, group = kept[inside], stretch[inside]


# --- documents ---------------------------------------------------------------------


RUNS = "n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def periodic_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, runs, collapsed``, a row per row of ``docs``.

    ``runs`` is sorted by start and period. ``collapsed`` is the text's words, joined by one space,
    without those that any run contains after its first period. A null or empty text has no words,
    no runs and an empty ``collapsed``; null and repeated ids are rows like others. Other columns
    are not read. No shuffle; texts are worked on in slices, a longer one alone.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("text").cast(pa.binary()).fill_null(b"")
            for start, stop in text_slices(batch.column("text")):
                texts = column.slice(start, stop - start).to_pylist()
                buf, starts = joined(texts)
                lo, hi = word_spans(buf)
                owner = owners(starts, lo)
                first = np.searchsorted(owner, np.arange(len(texts) + 1))
                hashes = span_hashes(buf, lo, hi)
                del buf
                n_words, found, collapsed = np.diff(first), [[] for _ in texts], []
                for a, b in zip(*(x.tolist() for x in stretches(owner, hashes)), strict=True):
                    found[owner[a]].append((a, b))
                rows = []
                for k, text in enumerate(texts):
                    words = text.split()
                    runs = [_shifted(words, a - first[k], b - first[k]) for a, b in found[k]]
                    mine = np.concatenate(runs) if runs else np.zeros((0, 3), dtype=np.int64)
                    if len(mine):
                        mine = mine[np.lexsort((mine[:, 2], mine[:, 0]))]
                        gone = np.zeros(len(words) + 1, dtype=np.int64)
                        np.add.at(gone, mine[:, 0] + mine[:, 2], 1)
                        np.add.at(gone, mine[:, 0] + mine[:, 1], -1)
                        words = [words[w] for w in np.flatnonzero(np.cumsum(gone[:-1]) == 0).tolist()]
                    rows.append(mine)
                    collapsed.append(b" ".join(words))
                flat = np.concatenate([*rows, np.zeros((0, 3), dtype=np.int64)])
                offsets = np.concatenate(([0], np.cumsum([len(r) for r in rows]))).astype(np.int32)
                items = pa.StructArray.from_arrays([pa.array(flat[:, c], pa.int64()) for c in range(3)], names=["start", "length", "period"])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(start, stop - start), pa.array(n_words, pa.int64()),
                     pa.ListArray.from_arrays(offsets, items), pa.array(collapsed, pa.binary()).cast(pa.string())],
                    names=["doc_id", "n_words", "runs", "collapsed"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, {RUNS}")


def _shifted(words: list[bytes], a: int, b: int) -> np.ndarray:
    """Runs between words ``a`` and ``b``, told apart by their bytes, numbered in the whole text."""
    numbers: dict[bytes, int] = {}
    text = np.array([numbers.setdefault(w, len(numbers)) for w in words[a:b]], dtype=np.int64)
    found = runs_of(text)
    found[:, 0] += a
    return found


# --- the query's texts and digests -----------------------------------------------------


def made_periodic(docs: DataFrame) -> DataFrame:
    """``doc_id, text``; every tenth text, by a checksum of its id, is periodic from some word on.

    With h the checksum and g = floor(h / 10), word i >= a is word a + (i - a) % p, where a = g % n
    and p = 1 + floor((n - a) / (3 + g % 8)). Words are then joined by one space.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.regexp_extract_all(F.col("text"), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))

    def altered(w: Column) -> Column:
        n, g = F.size(w).cast("long"), F.floor(h / 10)
        a = F.pmod(g, n)
        p = F.lit(1) + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))
        tail = F.transform(F.sequence(a, n - 1), lambda i: F.get(w, (a + F.pmod(i - a, p)).cast("int")))
        return F.array_join(F.concat(F.slice(w, F.lit(1), a.cast("int")), tail), " ")

    # One cell holds the words, so that they are cut out once.
    text = F.element_at(F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, altered(w)).otherwise(F.lit(""))), 1)
    return docs.select("doc_id", F.when((F.pmod(h, F.lit(10)) == 0) & F.col("text").isNotNull(), text).otherwise(F.col("text")).alias("text"))


def run_digests(found: DataFrame) -> DataFrame:
    """Per document: number of runs, the longest one (ties: smallest start, then period), and digests of runs and text."""
    best = F.element_at(F.array_sort(F.transform("runs", lambda r: F.struct(
        (-r["length"]).alias("shorter"), r["start"].alias("start"), r["period"].alias("period")))), 1)
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")))
    ended = F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), "")
    out = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), F.when(F.size("runs") > 0, best).alias("best"),
                       F.sha2(ended, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    length, period = -F.col("best.shorter"), F.col("best.period")
    return out.select(
        "doc_id", "n_runs", F.col("best.start").alias("start"), length.alias("length"), period.alias("period"),
        F.floor(length * 1000 / period).alias("exponent_milli"), "runs_sha256", "collapsed_sha256")
