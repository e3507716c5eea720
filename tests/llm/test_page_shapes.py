"""Pages of many shapes against texts written by hand."""

import pytest

from eventloom.llm import html_text
from eventloom.llm.html_text import main_blocks

P = [f"Paragraph {k} of the article, which is long enough, and has marks; it goes on for a while." for k in range(4)]
ALL = " ".join(P)
BODY = "".join(f"<p>{p}</p>" for p in P)
NAV = "<nav><a href=/>Home</a> <a href=/n>News</a></nav>"
FOOT = "<footer><p>All rights reserved, of course, by us.</p></footer>"
TALK = "<p>A reader says that it is so, and then says it once more, at length.</p>"

SHAPES = {
    **{f"wrapper {name}": (f"<body>{NAV}<div class='{name}'><article>{BODY}</article></div>{FOOT}", ALL)
       for name in ("page has-sidebar", "no-sidebar", "with-comments", "menu-open", "entry tags-x", "legal", "social-layout", "sidebar-left")},
    **{f"box {name}": (f"<body><div><article>{BODY}</article></div><div class='{name}'><p>Beside the text, there is more.</p></div>", ALL)
       for name in ("sidebar", "site-footer", "cookie-notice", "related-posts", "newsletter-signup")},
    **{f"box inside, {name}": (f"<body><article>{BODY}<div class='{name}'><p>In the text, there is this, too.</p></div></article>", ALL)
       for name in ("ad", "ad-slot", "share", "social-share", "related", "promo-box", "comments")},
    "sources": (f"<article>{BODY}<h2>Sources</h2><ul><li><a href=x>One source</a><li><a href=y>Another one</a></ul></article>",
                f"{ALL} Sources One source Another one"),
    "a paragraph made of a link": (f"<article>{BODY}<p><a href=x>Read the report</a></p></article>", f"{ALL} Read the report"),
    "math": (f"<article>{BODY}<p>Let <math><mi>x</mi></math> be, and so on.</p></article>", f"{ALL} Let x be, and so on."),
    "comment articles": (f"<body><article>{BODY}</article><section><article class=comment>{TALK * 9}</article></section>", ALL),
    "comments as articles": (f"<body><article>{BODY}</article><section class=comments><article>{TALK}</article></section>", ALL),
    "comment body with an id": (f"<main><article>{BODY}</article><ol><li><article id=comment-12 class=comment-body>{TALK}</article></ol></main>", ALL),
    "short intro in an element of its own": (f"<article><div class=intro><p>In short.</p></div><div class=text>{BODY}</div></article>", f"In short. {ALL}"),
    "page in a form": (f"<body><form id=aspnet>{NAV}<div class=text>{BODY}</div></form>", ALL),
    "article in a form": (f"<body><form><article>{BODY}</article></form>{FOOT}", ALL),
    "named box with most of the text": (f"<body><div class=menu><a href=a>A</a></div><div class=notice>{BODY}</div>", ALL),
    "comments with most of the text": (f"<body><div class=text>{BODY}</div><div id=comments>{TALK * 20}</div>", ALL),
    "main element": (f"<body>{NAV}<main><h1>Title</h1>{BODY}</main><aside><p>Aside, as it were.</p></aside>", f"Title {ALL}"),
    "role main": (f"<body>{NAV}<div role=main>{BODY}</div><div role=complementary><p>Aside, as it were.</p></div>", ALL),
    "header of the article": (f"<body><header><p>Site, its name.</p></header><article><header><h1>Title</h1></header>{BODY}</article>", f"Title {ALL}"),
    "hidden": (f"<article>{BODY}<p hidden>No.</p><p style='display: none'>No.</p><p aria-hidden=true>No.</p></article>", ALL),
    "links in a plain page": (f"<body><div class=text>{BODY}</div><ul><li><a href=a>Another page</a></ul>", ALL),
    "only boxes": (f"<body>{NAV}{FOOT}", ""),
    "table in the article": (f"<article>{BODY}<table><tr><td>One<td>Two</table></article>", f"{ALL} One Two"),
    "references": (f"<article>{BODY}<p>Fish &amp; chips&nbsp;&#8212; &lt;b&gt;</p></article>", f"{ALL} Fish & chips — <b>"),
}


@pytest.mark.parametrize("shape", SHAPES)
def test_shape(shape):
    page, want = SHAPES[shape]
    assert " ".join(main_blocks(page)) == want


def plain_scores(found, rules):
    """The path scores once more, block by block."""
    marks = ".,;:!?¡¿、。，！？；：…"
    ratio = {}
    for path in {b.path for b in found}:
        mine = [b for b in found if b.path == path]
        n = sum(max(0, len(b.text) - b.link_chars) for b in mine if not b.noisy)
        m = sum(b.text.count(c) for b in mine if not b.noisy for c in marks)
        ratio[path] = n / len(mine) * (1 + 40 * m / max(1, n))
    weight = {d: 2.718281828459045 ** (-d * d / 2) for d in range(-rules.spread, rules.spread + 1)}
    smooth = [sum(w * ratio[found[k + d].path] for d, w in weight.items() if 0 <= k + d < len(found)) / sum(weight.values()) for k in range(len(found))]
    out = {}
    for path in ratio:
        own = [s for b, s in zip(found, smooth, strict=True) if b.path == path]
        out[path] = (ratio[path] * sum(own) / len(own)) ** 0.5
    return out


@pytest.mark.parametrize("shape", [s for s, (_, want) in SHAPES.items() if want])
def test_path_scores(shape):
    found, _ = html_text.blocks(SHAPES[shape][0])
    rules = html_text.PathRatios()
    got, want = html_text.path_scores(found, rules), plain_scores(found, rules)
    assert got.keys() == want.keys() and all(got[p] == pytest.approx(want[p]) for p in got)
