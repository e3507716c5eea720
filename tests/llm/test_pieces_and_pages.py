import itertools

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from eventloom.llm import html_text, sentence_pieces
from eventloom.llm.sentence_pieces import MODEL, Encoder, PieceRules, code_points, n_best_paths


@pytest.fixture(scope="module")
def encoder():
    with open(MODEL, "rb") as f:
        return Encoder(f.read(), PieceRules(n_best=5))


def all_paths(text, vocabulary):
    """Every segmentation of a marked text, best first."""
    def scores(n):
        return vocabulary.scores[vocabulary.ids[n]] if n in vocabulary.ids else len(n.encode()) * vocabulary.byte_score if len(n) == 1 else None

    if not text:
        return [0.0]
    out = []
    for n in range(1, min(len(text), vocabulary.longest) + 1):
        s = scores(text[:n])
        if s is not None:
            out += [s + rest for rest in all_paths(text[n:], vocabulary)]
    return sorted(out, reverse=True)


TEXTS = ["hello", "a b", "xylophone", "  two", "tab\tand\nline", "é漢", "", "the cat", "ab cd ef", "🙂!"]


@pytest.mark.parametrize("text", TEXTS)
def test_n_best_agrees_with_all_paths(encoder, text):
    ids, score, best, restored = next(encoder.encode([text]))
    marked = "▁" + text.replace(" ", "▁") if text else ""
    want = all_paths(marked, encoder.vocabulary)[:5] if text else []
    assert [s for s, *_ in best] == pytest.approx(want) and restored
    assert not text or score == pytest.approx(want[0])
    assert encoder.decode(ids) == text
    if text and not set(text) - set("abcdefghijklmnopqrstuvwxyz"):
        [found] = n_best_paths(code_points(text), np.zeros(1, dtype=np.int64), 5, encoder.vocabulary)
        assert [s for s, _ in found] == pytest.approx(want)
        assert len(found[0][1]) == best[0][1] == len(ids) and found[0][1] == ids.tolist()
        assert len({tuple(x) for _, x in found}) == len(found)


def test_batches_agree_with_single_texts_and_with_the_library(encoder):
    draw = np.random.default_rng(3)
    texts = [" ".join(draw.choice(["some", "words", "of", "a", "text", "größer", "ñandú", "漢字", "x" * 300, "--", "\n"], 30)) for _ in range(20)] + [None]
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for text, (ids, score, best, _) in zip(texts, list(encoder.encode(texts)), strict=True):
        alone = next(encoder.encode([text]))
        assert ids.tolist() == alone[0].tolist() and score == pytest.approx(alone[1]) and len(best) == len(alone[2])
        assert library.decode(ids.tolist()) == (text or "")


def test_a_small_cache_changes_nothing(encoder):
    with open(MODEL, "rb") as f:
        small = Encoder(f.read(), PieceRules(n_best=5, cached=3))
    texts = [f"number {a} and {b}" for a, b in itertools.product(range(5), range(5))]
    for _ in range(2):
        assert [x[0].tolist() for x in small.encode(texts)] == [x[0].tolist() for x in encoder.encode(texts)]


def test_encode_and_decode(spark, odd):
    out = sentence_pieces.encode_documents(odd)
    rows = out.collect()
    assert len(rows) == odd.count() and all(r.restored and r.n_tokens == len(r.ids) for r in rows)
    empty = next(r for r in rows if r.doc_id == 1)
    assert (empty.n_tokens, empty.n_best) == (0, [])
    back = sentence_pieces.decode_documents(out)
    assert sorted((r.doc_id or 0, r.text) for r in back.collect()) == sorted((r.doc_id or 0, r.text or "") for r in odd.collect())
    assert sentence_pieces.encode_documents(odd.limit(0)).count() == 0
    assert sentence_pieces.decode_documents(spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")).first().text is None


def scored_paths(text, vocabulary):
    """Every segmentation of a marked text as score and ids, best first."""
    if not text:
        return [(0.0, ())]
    out = []
    for n in range(1, min(len(text), vocabulary.longest) + 1):
        piece = text[:n]
        if piece in vocabulary.ids:
            score, ids = vocabulary.scores[vocabulary.ids[piece]], (vocabulary.ids[piece],)
        elif n == 1:
            score, ids = len(piece.encode()) * vocabulary.byte_score, tuple(vocabulary.byte_ids[list(piece.encode())].tolist())
        else:
            continue
        out += [(score + s, ids + rest) for s, rest in scored_paths(text[n:], vocabulary)]
    return sorted(out, key=lambda x: -x[0])


def test_ids_of_the_n_best(encoder, docs_of):
    texts = ["", "the cat", "ab cd ef", "a b", "  two", "aaaa", "on it 漢 is", "x▁y"]
    encoded = sentence_pieces.encode_documents(docs_of(texts), rules=PieceRules(n_best=5))
    got = sentence_pieces.n_best_ids(encoded)
    rows = got.orderBy("doc_id", "rank").collect()
    for k, text in enumerate(texts):
        mine = [(r.score, tuple(r.ids)) for r in rows if r.doc_id == k]
        if not text:
            assert mine == []
            continue
        paths = scored_paths("▁" + text.replace(" ", "▁"), encoder.vocabulary)
        score = {ids: s for s, ids in paths}
        assert [s for s, _ in mine] == pytest.approx([s for s, _ in paths[:5]])
        assert len({ids for _, ids in mine}) == len(mine) and all(score[ids] == pytest.approx(s) for s, ids in mine)
    assert all(r.text == texts[r.doc_id].replace("▁", " ") for r in sentence_pieces.decode_documents(got).collect())
    assert [r.restored for r in encoded.orderBy("doc_id").collect()] == [True] * 7 + [False]


# --- pages ---

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><p>no";</script></head><body>
<header class="site"><h2>Site name</h2></header><nav><ul><li><a href=/a>Home</a><li><a href=/b>News</a></ul></nav>
<div class="cookie-notice">We use cookies, dear reader, and we like them a lot, really.</div>
<article><header><h1>A title</h1></header><p>First&nbsp;paragraph &amp; more, with   <b>bold
 text</b> &lt;ok&gt;, and enough of it.<p>Second <a href=x>one</a> is unclosed, and goes on for a while.
<p>Short.</p><script>no()</script><!-- nor this --><aside>Related things to read, if you like.</aside>
<form><p>Sign up here, please, for more of it.</p></form></article>
<section id="comments"><p>A reader comment that is long enough to look like text, and more.</p></section>
<footer>Footer text, all rights reserved, of course.</footer></body></html>"""


def pages(spark, *htmls):
    return spark.createDataFrame([(k, f"u{k}", h) for k, h in enumerate(htmls)], "page_id long, url string, html string")


def test_article_is_kept_and_the_rest_is_not(spark):
    got = html_text.extract_text(pages(spark, PAGE)).first()
    assert got.text == ("A title First paragraph & more, with bold text <ok>, and enough of it. "
                        "Second one is unclosed, and goes on for a while. Short.")
    assert got.n_chars == len(got.text)


def test_pages_without_an_article_element(spark):
    body = "".join(f"<p>Paragraph {k} of the text, which is long enough, and has marks; it goes on.</p>" for k in range(6))
    page = f"<body><div class=menu><a href=1>One</a> <a href=2>Two</a></div><div id=main><h1>Head</h1>{body}</div><div class=sidebar><p>Side, text, here.</p></div></body>"
    want = "Head " + " ".join(f"Paragraph {k} of the text, which is long enough, and has marks; it goes on." for k in range(6))
    assert html_text.extract_text(pages(spark, page)).first().text == want


@pytest.mark.parametrize("page", [None, "", "<", "<<>>", "<p", "</p></div>", "<!--", "<script>x", "<a b='", "&#xZZ; &", "<table><tr><td>x<td>y"])
def test_broken_pages(spark, page):
    got = html_text.extract_text(pages(spark, page)).first()
    assert got.n_chars == len(got.text)


def test_page_edges(spark):
    df = pages(spark, PAGE, PAGE, None).withColumns({"text": F.lit(1), "n_chars": F.lit("x")})
    rows = html_text.extract_text(df).orderBy("page_id").collect()
    assert rows[0].text == rows[1].text and rows[2].text == "" and len(rows) == 3
    assert html_text.extract_text(df.limit(0)).count() == 0
    nested = "<div>" * 3000 + "deep text, and more of it." + "</div>" * 3000
    long = "<article>" + "<p>Some words, again and again.</p>" * 5000 + "</article>"
    rows = html_text.extract_text(pages(spark, nested, long)).orderBy("page_id").collect()
    assert rows[0].text == "deep text, and more of it." and rows[1].n_chars == 5000 * 29 - 1
