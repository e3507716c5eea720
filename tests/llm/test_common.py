import random

import numpy as np

from eventloom.llm.common import components, joined, span_hashes, word_spans

from .brute import WORD, find


def test_words_and_hashes_do_not_depend_on_place():
    texts = ["a bb\tccc", "", "bb a", "é bb\x0b x\x1cy ", "a" * 5000 + " z"]
    buf, starts = joined([t.encode() for t in texts])
    at, to = word_spans(buf)
    words = [bytes(buf[a:b]).decode() for a, b in zip(at, to)]
    assert words == [w for t in texts for w in WORD.findall(t)]
    found = {}
    for w, h in zip(words, span_hashes(buf, at, to).tolist()):
        assert found.setdefault(w, h) == h
    assert len(set(found.values())) == len(found)


def test_long_buffers_hash_the_same_in_pieces(monkeypatch):
    from eventloom.llm import common

    buf = np.frombuffer(b"some words to hash in pieces " * 40, dtype=np.uint8)
    at, to = word_spans(buf)
    whole = span_hashes(buf, at, to)
    monkeypatch.setattr(common, "SLICE_BYTES", 16)
    assert (span_hashes(buf, at, to) == whole).all()


def test_components(spark):
    draw = random.Random(3)
    edges = [(draw.randrange(300), draw.randrange(300)) for _ in range(170)] + [(500 + k, 501 + k) for k in range(40)] + [(900, k) for k in range(901, 1300)]
    got = {r.id: r.component_id for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = {x for e in edges if e[0] != e[1] for x in e}
    assert got == {k: v for k, v in find(edges, {x for e in edges for x in e}).items() if k in nodes}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
