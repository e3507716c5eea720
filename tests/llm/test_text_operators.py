import hashlib
import random

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from eventloom.llm import line_dedup, minhash, mixing, quality
from eventloom.llm.line_dedup import CuckooFilter

from . import brute


def prose(seed, n, words=400):
    draw = random.Random(seed)
    pool = ["".join(draw.choice("abcdefghijklmnop") for _ in range(draw.randint(2, 9))) for _ in range(words)]
    return " ".join(draw.choice(pool) for _ in range(n))


# --- quality ---


def plain_counts(text):
    text = text or ""
    words = brute.WORD.findall(text)
    windows = [tuple(words[k:k + 3]) for k in range(len(words) - 2)]
    inside = {k + j for k, w in enumerate(windows) if windows.count(w) > 1 for j in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if brute.WORD.search(line):
            dup += line in seen
            seen.add(line)
    failed = len(words) < 50 or 100 * len(inside) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(inside), failed


def test_quality_counts(docs_of):
    texts = [None, "", "a b a b a b", "x\nx\n \n \ny x\nx", "é# <b> | ü", "a b c d a b c", prose(1, 300), prose(2, 60) + "\n" + prose(2, 60),
             "one\ntwo\none\n", "a\x0bb\x1cc d\r\ne", "\n".join([prose(3, 30)] * 5)]
    got = {r.doc_id: r for r in quality.quality_rules(docs_of(texts)).collect()}
    for k, t in enumerate(texts):
        r = got[k]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == plain_counts(t), t


def test_quality_bands(docs_of):
    draw = random.Random(8)
    noise = " ".join("".join(chr(draw.randrange(0x4E00, 0x9FFF)) for _ in range(6)) for _ in range(600))
    texts = [prose(1, 800, 3000), "### " + " ".join(f"{w}&&&" for w in prose(1, 800, 40).split()), noise]
    got = {r.doc_id: r for r in quality.quality_rules(docs_of(texts)).collect()}
    assert [got[k].kept for k in range(3)] == [True, False, False]
    assert (got[1].band, got[2].band) == ("repetitive", "incompressible")
    assert got[0].ratio == len(zstandard.ZstdCompressor(level=3).compress(texts[0].encode())) / len(texts[0].encode())
    assert [r.doc_id for r in quality.quality_filter(docs_of(texts)).collect()] == [0]


# --- lines ---


def test_cuckoo_filter():
    draw = np.random.default_rng(4)
    keys, others = draw.integers(0, 1 << 63, 5000, dtype=np.uint64), draw.integers(0, 1 << 63, 20000, dtype=np.uint64)
    made = CuckooFilter.of(keys)
    assert made.contains(keys).all() and made.contains(others).mean() < 0.01
    made = CuckooFilter.from_bytes(made.to_bytes())
    made.remove(keys[:2500])
    assert made.contains(keys[2500:]).all() and made.contains(keys[:2500]).mean() < 0.01
    made.add(keys[:2500])
    assert made.contains(keys).all()
    full = CuckooFilter.sized(1)
    with pytest.raises(line_dedup.Full):
        full.add(keys)


def line_texts(n, seed=5):
    draw = random.Random(seed)
    shared = [f"A passage number {k} that many of the documents share word for word" for k in range(12)]
    out = {}
    for k in range(n):
        lines = [f"own line {k} {j} {draw.random()} with some more text to be long enough" for j in range(draw.randint(0, 4))]
        lines += [draw.choice([str.upper, str, lambda s: f"  {s}\t\r"])(draw.choice(shared)) for _ in range(draw.randint(0, 3))] + ["short"] * draw.randint(0, 2)
        draw.shuffle(lines)
        out[k] = "\n".join(lines) if k % 17 else None
    return out


def test_lines(docs_of):
    texts = line_texts(120)
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.kept_text or "") for r in line_dedup.dedup_lines(docs_of([(k, t, "en", "s") for k, t in texts.items()])).collect()}
    assert got == brute.lines(texts)


def test_lines_are_reversible(spark, docs_of):
    texts = line_texts(90)
    frame = lambda keys: docs_of([(k, texts[k], "en", "s") for k in keys])
    index = line_dedup.insert_documents(line_dedup.build_index(frame(range(50))), frame(range(50, 90)))
    for gone in ([], range(60, 90), range(0, 20)):
        now = line_dedup.delete_documents(index, spark.createDataFrame([(k,) for k in gone], "doc_id long"))
        left = [k for k in texts if k not in gone]
        fresh = line_dedup.build_index(frame(left))
        assert sorted(now.counts.collect()) == sorted(fresh.counts.collect())
        pairs = lambda i: sorted(map(tuple, line_dedup.dropped_keys(i).collect()))
        assert pairs(now) == pairs(fresh)
        held = {r.shard: CuckooFilter.from_bytes(bytes(r.filter)) for r in now.filters.collect()}
        for r in now.frequent().collect():
            assert held[r.k2 % now.shards].contains(np.array([r.k1], dtype=np.int64).view(np.uint64)).all()


# --- near copies ---


def near_texts():
    draw, out = random.Random(6), {}
    for g in range(25):
        base = prose(100 + g, draw.randint(3, 260)).split()
        for _ in range(draw.randint(1, 7)):
            words = list(base)
            for _ in range(draw.choice([0, 0, 1, 2, 6])):
                words[draw.randrange(len(words))] = "changed" + str(draw.random())[:5]
            out[len(out)] = draw.choice([" ", "\n", " \t"]).join(w.upper() if draw.random() < 0.1 else w for w in words)
    return out | {200: None, 201: "", 202: " \n", 203: "one two", 204: "One  two", 205: "two one"}


def test_near_copies(docs_of):
    texts = near_texts()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_components(docs_of([(k, t, "en", "s") for k, t in texts.items()])).collect()}
    assert got == brute.near(texts)


def test_chains_are_followed_to_their_ends(docs_of):
    """Neighbours in a chain are near copies, its ends are not; ids in mixed order."""
    words = prose(9, 400).split()
    texts = {(k * 37) % 101: " ".join([f"n{k}x{j}" for j in range(6 * k)] + words[6 * k:]) for k in range(40)}
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_components(docs_of([(k, t, "en", "s") for k, t in texts.items()])).collect()}
    assert got == brute.near(texts)


def test_large_group_of_copies(docs_of):
    words = prose(11, 120).split()
    rows = [(k, " ".join(words[:-1] + [f"end{k}"]), "en", "s") for k in range(700)] + [(k, " ".join(words), "en", "s") for k in range(700, 1200)]
    got = minhash.near_components(docs_of(rows)).agg(F.min("component_id"), F.max("component_id"), F.count_if("kept")).first()
    assert tuple(got) == (0, 0, 1)


def test_estimate_is_unbiased():
    rules = minhash.NearRules()
    draw, guesses = random.Random(2), []
    for k in range(60):
        a = [f"{k}w{j}" for j in range(300)]
        b = a[:200] + [f"{k}v{j}" for j in range(100)]
        made = minhash.signatures([" ".join(x).encode() for x in (a, b)], rules)["signature"]
        parts = [(int(w) >> s) & 15 for w in made[0] ^ made[1] for s in range(0, 64, 4)]
        guesses.append((sum(p == 0 for p in parts) / 128 - 1 / 16) / (1 - 1 / 16))
    truth = 196 / (296 + 296 - 196)
    assert abs(np.mean(guesses) - truth) < 0.02, draw


def test_odd_rows(spark, odd):
    n = odd.count()
    assert quality.quality_rules(odd).count() == n
    assert quality.quality_filter(odd).columns == odd.columns
    out = {r.doc_id: r for r in line_dedup.dedup_lines(odd).collect()}
    assert len(out) == n - 1 and (out[1].n_lines, out[1].kept_text, out[2].n_lines) == (1, None, 1)
    assert line_dedup.dedup_filter(odd).columns == odd.columns and line_dedup.dedup_filter(odd).count() == n
    near = minhash.near_components(odd)
    assert near.count() == n and near.filter("doc_id = 1").first().n_shingles == 0
    assert sorted(r.doc_id or 0 for r in minhash.near_filter(odd).collect()) == [0, 1, 2, 3, 4, 5, 6, 7]
    none = odd.limit(0)
    for made in (quality.quality_rules(none), line_dedup.dedup_lines(none), minhash.near_components(none), minhash.near_filter(none)):
        assert made.count() == 0
    sha = hashlib.sha256(b"").hexdigest()
    assert line_dedup.dedup_lines(odd).filter("doc_id = 1").select(F.sha2(F.coalesce("kept_text", F.lit("")), 256)).first()[0] == sha


def test_null_and_repeated_ids_lose_no_document(spark):
    """Five texts without an id and one id with two texts: each stays, but for the copy of another document."""
    words = [" ".join(f"w{k}x{j}" for j in range(60)) for k in range(8)]
    rows = [(1, words[0]), (None, words[0]), *[(None, w) for w in words[1:5]], (7, words[5]), (7, words[6]), (9, words[7]), (9, words[7]), (None, words[4])]
    df = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = minhash.near_filter(df)
    assert kept.columns == df.columns
    assert sorted(((r.doc_id or 0), r.text) for r in kept.collect()) == sorted(
        [(1, words[0]), *[(0, w) for w in words[1:5]], (7, words[5]), (7, words[6]), (9, words[7])])
    mixed = mixing.mixed_documents(kept).select("doc_id", "text").distinct().collect()
    assert {(r.doc_id, r.text) for r in mixed if r.text in words} == {(r.doc_id, r.text) for r in kept.collect()}
