import itertools
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventloom.llm import language_id, lm_scoring, toxicity
from eventloom.llm.language_id import LanguageRules
from eventloom.llm.lm_scoring import ModelRules

from .brute import WORD, lower


@pytest.fixture(scope="module")
def tables(spark):
    read = lambda name: spark.read.parquet(f"/root/testdata/sf0.01/{name}.parquet")
    return read("documents"), read("labels")


# --- languages ---


@pytest.mark.parametrize("n", [2, 3, 5, 6, 20])
def test_codewords(n):
    code = language_id.codewords(n, 5)
    assert code.shape[0] == n and set(np.unique(code)) <= {-1, 1}
    assert all((code[a] != code[b]).sum() >= code.shape[1] // 4 for a, b in itertools.combinations(range(n), 2))
    assert (np.abs(code.sum(axis=0)) < n).all()


def test_languages_held_out(tables):
    docs, _ = tables
    got = language_id.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    out = [r for r in got if r.held_out]
    assert np.mean([r.lang_pred == r.lang for r in out]) > 0.98
    assert all(0 <= r.score <= 1 for r in got)


def test_labels_of_held_out_rows_are_not_seen(tables):
    docs, _ = tables
    blind = docs.withColumn("lang", F.when(~language_id.held_out(F.col("doc_id"), 5, 0), F.col("lang")).otherwise("xx"))
    a, b = ({r.doc_id: (r.lang_pred, r.score) for r in language_id.identify(d).collect()} for d in (docs, blind))
    assert a == b


def test_language_edges(docs_of, odd):
    rows = [(k, "der die das und ist nicht " * 5, "de", "s") for k in range(20)] + [(k, "the and that with from " * 5, "en", "s") for k in range(20, 40)]
    rows += [(50, None, "en", "s"), (51, "12 34 !", "en", "s"), (52, "", None, "s"), (53, "the die", None, "s")]
    got = {r.doc_id: r for r in language_id.identify(docs_of(rows)).collect()}
    assert {got[k].lang_pred for k in (50, 51, 52)} == {"und"} and got[50].score == 0 and got[50].ambiguous
    assert got[1].lang_pred == "de" and got[21].lang_pred == "en" and not got[1].ambiguous
    none = docs_of([(1, "text", None, "s")])
    assert language_id.identify(none).first().lang_pred == "und"
    assert language_id.identify(docs_of([(1, "text", "en", "s"), (2, "more", "en", "s")])).first().lang_pred == "en"
    assert language_id.identify(odd).count() == odd.count() and language_id.identify(odd.limit(0)).count() == 0
    with pytest.raises(ValueError):
        language_id.train(docs_of(rows), LanguageRules(most_langs=1))


# --- toxicity ---


def maximal(scores):
    """All maximum-scoring segments by their definition: the best one, then left and right of it."""
    best, at = 0, None
    for i in range(len(scores)):
        for j in range(i + 1, len(scores) + 1):
            s = sum(scores[i:j])
            if s > best + 1e-12:
                best, at = s, (i, j)
    if at is None:
        return []
    i, j = at
    return [(a, b) for a, b in maximal(scores[:i])] + [(i, j)] + [(a + j, b + j) for a, b in maximal(scores[j:])]


def test_segments():
    draw = np.random.default_rng(1)
    for _ in range(200):
        scores = np.round(draw.normal(-0.3, 1.5, draw.integers(0, 18)), 3) + draw.uniform(-1e-6, 1e-6)
        assert [(a, b) for a, b, _ in toxicity.best_segments(scores)] == maximal(scores.tolist())


def test_decay():
    value = toxicity.decay_of(np.array([1.0, -1.0]), np.array([0.25, 0.75]))
    assert value == pytest.approx(np.log(3))
    assert toxicity.decay_of(np.array([-1.0]), np.array([1.0])) == 1.0


def test_toxicity_held_out(tables):
    docs, labels = tables
    got = toxicity.toxicity(docs, labels).join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    out = [r for r in got if r.held_out]
    hits = [r.score for r in out if r.toxic == 1]
    rest = [r.score for r in out if r.toxic == 0]
    assert np.mean([a > b for a in hits for b in rest]) > 0.95
    assert np.mean([r.predicted == r.toxic for r in out]) > 0.95
    r = next(r for r in got if r.predicted and r.passages)
    text = docs.filter(F.col("doc_id") == r.doc_id).first().text
    assert all(text[p.begin:p.end].strip() and p.expected <= 0.05 for p in r.passages)


def test_toxicity_edges(spark, odd):
    labels = spark.createDataFrame([(3, 1), (5, 0), (5, 1), (6, 0), (9, 1), (None, 1), (7, None)], "doc_id long, toxic int")
    got = toxicity.toxicity(odd, labels)
    assert got.count() == odd.count() and got.filter("score between 0 and 1 and predicted in (0, 1)").count() == odd.count()
    assert toxicity.toxicity(odd, labels.limit(0)).filter("predicted = 1").count() == 0
    assert toxicity.toxicity(odd.limit(0), labels).count() == 0


# --- language models ---


def plain_losses(docs, target, rules):
    words = lambda t: WORD.findall(lower(t or ""))
    def tally(texts):
        counts = {}
        for t in texts:
            for w in words(t):
                counts[w] = counts.get(w, 0) + 1
        return counts

    one, two = tally(docs.values()), tally(target)
    both = {w: one.get(w, 0) + two.get(w, 0) for w in {*one, *two}}
    limit = min((n for n in set(both.values()) if sum(m >= n for m in both.values()) <= rules.vocabulary), default=None)
    vocabulary = {w for w, n in both.items() if limit is not None and n >= limit}
    model = []
    for texts in (target, list(docs.values())):
        uni, pairs = dict.fromkeys([*vocabulary, "<other>", "<end>"], 0), {}
        heads = {"<begin>": len(texts)}
        for t in texts:
            line = ["<begin>", *(w if w in vocabulary else "<other>" for w in words(t)), "<end>"]
            for a, b in zip(line, line[1:]):
                pairs[a, b] = pairs.get((a, b), 0) + 1
                uni[b] += 1
        heads |= uni
        total = sum(uni.values()) + rules.unigram_prior
        share = {w: (n + rules.unigram_prior / len(uni)) / total for w, n in uni.items()}
        model.append(lambda a, b, p=pairs, s=share, h=heads: -np.log((p.get((a, b), 0) + rules.bigram_prior * s[b]) / (h[a] + rules.bigram_prior)))
    out = {}
    for k, t in docs.items():
        line = ["<begin>", *(w if w in vocabulary else "<other>" for w in words(t)), "<end>"]
        out[k] = [np.mean([m(a, b) for a, b in zip(line, line[1:])]) for m in model]
    return out


@pytest.mark.parametrize("vocabulary", [65_000, 40, 0])
def test_losses(spark, docs_of, vocabulary):
    draw = np.random.default_rng(4)
    pool = [f"Word{k}" for k in range(60)]
    text = lambda n: " ".join(draw.choice(pool, n, p=np.arange(1, 61) / 1830))
    docs = {k: text(int(draw.integers(1, 40))) for k in range(60)} | {70: None, 71: "", 72: "unseen\nwords  here", 73: text(2000)}
    target = [text(20) for _ in range(8)] + ["only in target", None]
    rules = ModelRules(vocabulary=vocabulary)
    got = lm_scoring.cross_entropy(docs_of([(k, t, "en", "s") for k, t in docs.items()]),
                                   spark.createDataFrame([(t,) for t in target], "text string"), rules).collect()
    want = plain_losses(docs, target, rules)
    assert len(got) == len(docs)
    for r in got:
        assert (r.target_loss, r.background_loss) == pytest.approx(want[r.doc_id]), r.doc_id
        assert r.difference == pytest.approx(r.target_loss - r.background_loss)


def test_lm_edges(spark, odd):
    target = spark.createDataFrame([("some text",)], "text string")
    got = lm_scoring.cross_entropy(odd, target)
    assert got.count() == odd.count() and got.filter("doc_id is null").count() == 1
    assert lm_scoring.cross_entropy(odd.limit(0), target).count() == 0
    assert lm_scoring.cross_entropy(odd, target.limit(0)).filter("difference is not null").count() == odd.count()


def test_lm_tells_all_words_apart(spark, docs_of):
    words = [f"w{k}" for k in range(70_000)]
    docs = {k: " ".join(words[k * 7000:(k + 1) * 7000] * 2) for k in range(10)} | {10: "rare words of the target", 11: "rare words elsewhere"}
    target = ["rare words of the target"]
    got = lm_scoring.cross_entropy(docs_of([(k, t, "en", "s") for k, t in docs.items()]), spark.createDataFrame([(t,) for t in target], "text string")).collect()
    want = plain_losses(docs, target, ModelRules(vocabulary=1_000_000))
    for r in got:
        assert (r.target_loss, r.background_loss) == pytest.approx(want[r.doc_id]), r.doc_id


def test_lm_limit_beyond_a_million(spark, docs_of):
    docs, target = {0: "a " * 1_000_001 + "b " * 1_000_002, 1: "a b"}, ["b"]
    rules = ModelRules(vocabulary=1)
    got = lm_scoring.cross_entropy(docs_of([(k, t, "en", "s") for k, t in docs.items()]), spark.createDataFrame([(t,) for t in target], "text string"), rules).collect()
    want = plain_losses(docs, target, rules)
    for r in got:
        assert (r.target_loss, r.background_loss) == pytest.approx(want[r.doc_id]), r.doc_id


def test_lm_entries_do_not_grow_with_documents(spark, docs_of):
    slices = lm_scoring.text_rows(docs_of(["same words"] * 500).coalesce(1), False)
    rows = lm_scoring.requests(slices, 4, None).collect()
    assert slices.count() == 1 and sum(len(r["keys"]) // 8 for r in rows) == 4 + 3
