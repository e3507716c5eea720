"""Files of token ids: exact round trips, damage, checkpoints, and the query against the tokenizer."""

import tempfile
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from eventloom.llm.queries import QUERIES
from eventloom.llm.token_files import (
    Coder, FileRules, WordEncoder, block_tokens, default_tokenizer, pack_block, read_block, read_token_files, shares, tokenize,
    write_token_files,
)


def _coder(counts, **rules):
    rules = FileRules(**rules)
    return Coder(shares(np.array(counts), rules.bits), rules)


def _plain(text):
    return [*Tokenizer.from_file(P.path("word_bpe_49k.json")).encode(text or "", add_special_tokens=False).ids, 2]


def test_blocks_of_all_lengths():
    rng = np.random.default_rng(1)
    counts = rng.integers(0, 1000, 500) ** 3
    coder = _coder(counts)
    blocks = [rng.choice(500, n, p=counts / counts.sum()).astype(np.uint32) for n in (1, 2, 3, 4, 5, 127, 1023, 1024, 1025, 5000, 65_536)]
    coded = coder.encode(blocks)
    back = coder.decode([(k, len(b), p) for b, (k, p) in zip(blocks, coded, strict=True)])
    assert all((b == r).all() for b, r in zip(blocks, back, strict=True))
    share = counts[counts > 0] / counts.sum()
    entropy = -(share * np.log2(share)).sum() / 8
    assert len(coded[-1][1]) < 1.06 * entropy * 65_536


def test_one_token_and_rare_ones():
    coder = _coder([0, 7], bits=12)
    (k, p), = coder.encode([np.ones(10_000, dtype=np.uint32)])
    assert (coder.decode([(k, 10_000, p)])[0] == 1).all() and len(p) < 600
    assert shares(np.array([10**12, 1, 0, 1]), 12).tolist() == [4094, 1, 0, 1]
    many = shares(np.array([1] * 2000 + [10**9]), 12)
    assert many.sum() == 4096 and many.min() == 1
    with pytest.raises(ValueError, match="more tokens"):
        shares(np.ones(5000, dtype=np.int64), 12)


def test_decode_from_checkpoints():
    rng = np.random.default_rng(2)
    ids = rng.integers(0, 300, 60_000).astype(np.uint32)
    coder = _coder(np.bincount(ids))
    (lanes, payload), = coder.encode([ids])
    block = read_block(pack_block(5, 0, True, lanes, len(ids), payload, coder))
    for a, b in ((0, 10), (33_000, 33_100), (59_990, 60_000), (32_768, 32_769)):
        assert block_tokens(block, coder, a, b).tolist() == ids[a:b].tolist()


def test_damage_is_found():
    coder = _coder([5, 5])
    (lanes, payload), = coder.encode([np.array([0, 1, 1, 0], dtype=np.uint32)])
    data = bytearray(pack_block(None, 0, True, lanes, 4, payload, coder))
    assert read_block(bytes(data)).doc_id is None
    for at in (0, 6, 20, len(data) - 1):
        bad = bytearray(data)
        bad[at] ^= 1
        with pytest.raises(ValueError, match="damaged"):
            read_block(bytes(bad))


def test_query_matches_tokenizer(spark, sf):
    docs = sorted(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    want, start = {}, 0
    for r in docs:
        ids = _plain(r.text)
        want[r.doc_id] = (start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes()))
        start += len(ids)
    got = QUERIES["op11_token_files"](spark, sf)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert {r.doc_id: tuple(r)[1:] for r in got.collect()} == want


def test_odd_rows_in_many_files(spark, odd):
    path = f"{tempfile.mkdtemp(prefix='eventloom-tests-')}/files"
    write_token_files(tokenize(odd), path, FileRules(shard_tokens=5000, block_tokens=4096))
    assert spark.read.parquet(f"{path}/manifest").filter("n_tokens > 0").count() > 1
    got = read_token_files(spark, path).orderBy("start").collect()
    texts = {r.doc_id: r.text for r in odd.collect()}
    assert [r.doc_id for r in got] == [None, 1, 2, 3, 4, 5, 5, 6, 7]
    assert [np.frombuffer(r.ids, dtype="<u4").tolist() for r in got] == [_plain(texts[r.doc_id]) for r in got]
    assert [r.start for r in got] == np.cumsum([0, *[r.n_tokens for r in got[:-1]]]).tolist()


def test_words_of_rare_space_and_special_strings(spark):
    texts = ["a b　c", "<|endoftext|>x <|startoftext|>", "I'LL don’t İSTANBUL ΣΣ", "é ́x", "\x1c\x1d", "12 345"]
    got = tokenize(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert [np.frombuffer(r.ids, dtype="<u4").tolist() for r in sorted(got)] == [_plain(t) for t in texts]


def test_empty_table(spark, odd):
    path = f"{tempfile.mkdtemp(prefix='eventloom-tests-')}/files"
    write_token_files(tokenize(odd.filter(F.lit(False))), path)
    assert read_token_files(spark, path).count() == 0


def test_words_and_their_parts():
    """Any mix of letters, marks, digits, case and combining characters, through memories that start over."""
    with open(default_tokenizer(), encoding="utf-8") as f:
        encoder = WordEncoder(f.read(), kept=50)
    rng = np.random.default_rng(6)
    letters = [*"abzAZ09.,;:'<|>=/-_^", "é", "É", "ẖ", "H̱", "̸", "…", "½", "İ", "Σ", "क़", "漢", "<|endoftext|>", "'s", "'LL", "</w>", " "]
    texts = ["".join(rng.choice(letters, rng.integers(0, 12))) for _ in range(1500)]
    tokenizer = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    for at in range(0, len(texts), 50):
        some = texts[at:at + 50]
        got = encoder.encode([t.encode() for t in some], b"")
        assert [np.frombuffer(x, dtype="<u4").tolist() for x in got] == [e.ids for e in tokenizer.encode_batch(some, add_special_tokens=False)]


def _same_as_plain(encoder, texts):
    tokenizer = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    got = encoder.encode([t.encode() for t in texts], b"")
    assert [np.frombuffer(x, dtype="<u4").tolist() for x in got] == [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_every_two_byte_character_next_to_others():
    with open(default_tokenizer(), encoding="utf-8") as f:
        encoder = WordEncoder(f.read(), kept=100_000)
    chars = [chr(c) for c in range(0x80, 0x800)]
    _same_as_plain(encoder, [f"a{c} {c}, {c}9{c}{c} B{c}B'{c} <{c}|{c}<| {c}" for c in chars])
    rng = np.random.default_rng(7)
    some = [*chars, *"aZ9.,'<| " * 60, *"漢é가K" * 20]
    _same_as_plain(encoder, ["".join(rng.choice(some, rng.integers(1, 40))) for _ in range(3000)])
    _same_as_plain(encoder, ["", "<", "a<", "é", "", "<|", "|<"])


def test_work_per_distinct_part():
    """Memories are asked once per distinct part, however often it occurs, and letters alone pass no whole encoding."""
    with open(default_tokenizer(), encoding="utf-8") as f:
        encoder = WordEncoder(f.read(), kept=1000)
    asked = []

    class Counted(dict):
        def get(self, key, default=None):
            asked.append(key)
            return super().get(key, default)

    for name, value in list(vars(encoder).items()):
        if isinstance(value, dict):
            setattr(encoder, name, Counted(value))
    whole, encoded = encoder._ids, []
    encoder._ids = lambda texts: encoded.extend(texts) or whole(texts)
    text = "Eins zwei drei, größer vier. " * 2000
    got, = encoder.encode([text.encode()], b"")
    assert np.frombuffer(got, dtype="<u4").tolist() == _plain(text)[:-1]
    assert len(asked) == 7 and set(encoded) == {",", "."}
