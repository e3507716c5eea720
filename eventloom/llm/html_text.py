"""Main text of web pages by tag-path ratios."""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

# Names of the HTML standard.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "xmp", "noembed", "noframes", "template", "svg", "annotation", "annotation-xml"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins",
    "kbd", "label", "mark", "nobr", "q", "ruby", "rt", "rp", "rb", "s", "samp", "small", "span", "strike", "strong", "sub", "sup",
    "time", "tt", "u", "var", "wbr", "img", "math", "mi", "mn", "mo", "ms", "mspace", "mtext", "mrow", "mfrac", "msqrt", "mroot",
    "mstyle", "msub", "msup", "msubsup", "munder", "mover", "munderover", "mpadded", "mphantom", "mmultiscripts", "semantics",
}
CLOSES_P = {
    "address", "article", "aside", "blockquote", "center", "details", "dialog", "dir", "div", "dl", "fieldset", "figcaption",
    "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "main", "menu", "nav", "ol",
    "p", "pre", "search", "section", "table", "ul",
}
#: A new one of the key ends an open one of the values, up to the nearest of the stops.
SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "thead": ({"thead", "tbody", "tfoot", "tr"}, {"table"}), "tbody": ({"thead", "tbody", "tfoot", "tr"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr"}, {"table"}), "option": ({"option"}, {"select"}),
}
#: Elements that never hold the article.
NOISE_TAGS = {
    "head", "nav", "footer", "aside", "form", "button", "select", "option", "menu", "dialog", "search",
    "fieldset", "input", "object", "audio", "video", "canvas", "applet",
} | RAW
#: Those of them that can also be a page's outer frame.
FRAME_TAGS = {"form", "fieldset", "aside", "dialog", "menu", "search", "header"}
NOISE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "alertdialog", "menu", "menubar", "form"}
#: Words of class and id names that mark boxes beside the article, where a name has no others but plain ones.
NOISE_WORDS = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "adbox", "adsense", "banner", "promo", "promotion", "sponsor",
    "sponsored", "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "header", "footer", "sidebar", "aside", "widget",
    "widgets", "related", "recommended", "cookie", "cookies", "consent", "gdpr", "notice", "popup", "modal", "overlay", "newsletter",
    "subscribe", "signup", "login", "share", "sharing", "social", "toolbar", "pagination", "pager", "masthead", "copyright",
    "hidden", "skip", "outbrain", "taboola", "tags", "topbar", "legal", "disclaimer",
}
COMMENT_WORDS = {"comment", "comments", "commentlist", "disqus", "reply", "replies", "respond"}
PLAIN_WORDS = {
    "area", "article", "articles", "bar", "block", "body", "bottom", "box", "col", "column", "container", "content", "form", "global", "group",
    "inner", "item", "items", "left", "links", "list", "main", "outer", "page", "panel", "policy", "post", "posts", "primary",
    "reader", "right", "secondary", "section", "site", "slot", "thread", "top", "unit", "user", "wrap", "wrapper",
}
CONTENT_TAGS = {"article", "main"}
MARKS = re.compile(r"[.,;:!?¡¿、。，！？；：…]")
_TOKEN = re.compile(
    r"<!--(?P<comment>.*?)(?:-->|--!>|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|</(?P<end>[a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
    r"|<(?P<start>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
_ATTR = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_WORDS = re.compile(r"[a-z]+")


@dataclass
class Block:
    """Text between two block edges, with the path of tags above it.

    ``noisy``: in a box beside the article. ``in_content``: in an article or main element; ``article``: path of
    the outermost article element round it, -1 for none.
    """

    path: int
    text: str
    noisy: bool
    in_content: bool
    article: int
    link_chars: int = 0


class Paths:
    """Root-to-leaf tag paths as numbers; 0 is the root."""

    def __init__(self) -> None:
        self.numbers: dict[tuple[int, str], int] = {}
        self.parent, self.depth = [0], [0]

    def child(self, path: int, label: str) -> int:
        number = self.numbers.setdefault((path, label), len(self.parent))
        if number == len(self.parent):
            self.parent.append(path)
            self.depth.append(self.depth[path] + 1)
        return number

    def shared(self, a: int, b: int) -> int:
        """The longest path that both begin with."""
        while a != b:
            if self.depth[a] >= self.depth[b]:
                a = self.parent[a]
            else:
                b = self.parent[b]
        return a

    def under(self, home: int) -> list[bool]:
        """For each path whether it begins with ``home``; a parent's number is lower than its children's."""
        out = [k == home for k in range(len(self.parent))]
        for k in range(1, len(out)):
            out[k] = out[k] or out[self.parent[k]]
        return out


class _Node:
    __slots__ = ("tag", "path", "up", "barred", "frame", "boxed", "heading", "talk", "is_main", "is_article",
                 "chars", "n_articles", "holds_main", "noisy", "in_content", "article")

    def __init__(self, tag: str, path: int, up: _Node | None = None):
        self.tag, self.path, self.up = tag, path, up
        #: No text of an article; a box by tag or role; a box by name; a page header; reader comments.
        self.barred = self.frame = self.boxed = self.heading = self.talk = False
        self.is_main = self.is_article = False
        #: Characters outside links, articles and a main element inside.
        self.chars, self.n_articles, self.holds_main = 0, 0, False
        self.noisy = self.in_content = False
        self.article = -1


def _named(name: str) -> tuple[bool, bool, bool]:
    """Whether a class or id name marks a box beside the article, a page header, and reader comments."""
    box = heading = talk = False
    for token in name.split():
        words = set(_WORDS.findall(token)) - PLAIN_WORDS
        if words == {"header"}:
            heading = True
        elif words and words <= NOISE_WORDS | COMMENT_WORDS:
            box, talk = True, talk or bool(words & COMMENT_WORDS)
    return box, heading, talk


def _node(tag: str, path: int, up: _Node, name: str, attrs: dict[str, str]) -> _Node:
    node, role = _Node(tag, path, up), attrs.get("role", "").lower()
    box, heading, node.talk = _named(name) if tag not in ("html", "body") else (False, False, False)
    node.is_main = tag == "main" or role == "main"
    node.is_article = tag == "article" and not node.talk
    node.boxed = box and not (node.is_main or node.is_article)
    node.heading = tag == "header" or (heading and not (node.is_main or node.is_article))
    node.frame = tag in FRAME_TAGS or role in NOISE_ROLES
    node.barred = bool(tag in NOISE_TAGS - FRAME_TAGS or "hidden" in attrs or attrs.get("aria-hidden") == "true"
                       or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attrs.get("style", "")))
    return node


def _mark(nodes: list[_Node]) -> None:
    """Tell noise from content, for all nodes in page order, by what each of them holds.

    A box is none if it holds the longest article of the page or a main element, or, on a page without
    either, most of the text outside links. Comments are noise whatever their length, unless the
    main element or all articles of the page are inside.
    """
    for node in reversed(nodes[1:]):
        up = node.up
        up.chars += 0 if node.barred or node.talk else node.chars
        up.holds_main |= not node.barred and (node.holds_main or node.is_main)
        up.n_articles += node.n_articles + node.is_article
    node = max((n for n in nodes if n.is_article), key=lambda n: n.chars, default=None)
    round_longest = set()
    while node is not None:
        round_longest.add(id(node))
        node = node.up
    top = nodes[0]
    framed = top.n_articles > 0 or top.holds_main
    for node in nodes[1:]:
        up = node.up
        if node.talk:
            noisy = not (node.holds_main or 0 < node.n_articles == top.n_articles)
        elif node.heading and not node.boxed:
            noisy = not (up.in_content or node.holds_main or id(node) in round_longest)
        elif node.frame or node.boxed:
            most = not framed and (node.boxed or node.tag == "form") and 2 * node.chars > top.chars
            noisy = not (node.is_main or node.is_article or node.holds_main or id(node) in round_longest or most)
        else:
            noisy = False
        node.noisy = up.noisy or node.barred or noisy
        node.in_content = up.in_content or node.is_main or node.is_article
        node.article = up.article if up.article >= 0 else node.path if node.is_article else -1


def _attributes(text: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for name, a, b, c in _ATTR.findall(text):
        out.setdefault(name.lower(), html.unescape(a or b or c))
    return out


def blocks(page: str) -> tuple[list[Block], Paths]:
    """Cut a page into text blocks in page order; unclosed and stray tags are tolerated.

    Inline tags do not end a block and take no part in its path, so a paragraph with links or
    bold words is one block.
    """
    paths, nodes = Paths(), [_Node("#root", 0)]
    stack = nodes[:]
    lines: list[tuple[_Node, str, int]] = []
    open_tags: Counter[str] = Counter()
    parts: list[str] = []
    link = link_chars = at = 0

    def end_block() -> None:
        nonlocal link_chars
        text = " ".join("".join(parts).split())
        if text:
            lines.append((stack[-1], text, link_chars))
            stack[-1].chars += max(0, len(text) - link_chars)
        parts.clear()
        link_chars = 0

    def add(text: str) -> None:
        nonlocal link_chars
        text = html.unescape(text)
        parts.append(text)
        if link:
            link_chars += len(text.strip())

    def close(names: set[str], stops: set[str]) -> None:
        if not any(open_tags[n] for n in names):
            return
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag in names:
                end_block()
                open_tags.subtract(n.tag for n in stack[k:])
                del stack[k:]
                return
            if stack[k].tag in stops:
                return

    find = _TOKEN.search
    while True:
        m = find(page, at)
        if m is None:
            add(page[at:])
            break
        if m.start() > at:
            add(page[at:m.start()])
        at = m.end()
        kind = m.lastgroup
        if m["end"] is not None:
            tag = m["end"].lower()
            if tag == "a":
                link = max(0, link - 1)
            elif tag in ("br", "hr"):
                end_block()
            elif tag == "p" and not open_tags["p"]:
                end_block()
            elif tag not in INLINE:
                close({tag}, {"table"} if tag in ("p", "li") else set())
        elif m["start"] is not None:
            tag = m["start"].lower()
            if tag in RAW:
                if not m["attrs"].rstrip().endswith("/"):
                    stop = re.compile(rf"</{re.escape(tag)}\s*[^>]*>", re.I).search(page, at)
                    at = stop.end() if stop else len(page)
                continue
            if tag == "a":
                link = 1
            if tag == "br" or tag == "hr":
                end_block()
                continue
            if tag in INLINE or tag in VOID:
                continue
            end_block()
            if tag in CLOSES_P:
                close({"p"}, {"table", "td", "th", "button"})
                if re.fullmatch("h[1-6]", tag):
                    close({"h1", "h2", "h3", "h4", "h5", "h6"}, {"div", "article", "section", "main", "body"})
            if tag in SIBLINGS:
                close(*SIBLINGS[tag])
            if tag in ("html", "body") and open_tags[tag]:
                continue
            if tag in ("body", "article", "main", "div", "section") and open_tags["head"]:
                close({"head"}, set())
            attrs = _attributes(m["attrs"]) if m["attrs"] else {}
            name = f"{attrs.get('class', '')} {attrs.get('id', '')}".lower()
            top = stack[-1]
            label = f"{tag}.{'.'.join(sorted(name.split()))}" if name.strip() else tag
            if m["attrs"].rstrip().endswith("/") and tag in NOISE_TAGS:
                continue
            stack.append(_node(tag, paths.child(top.path, label), top, name, attrs))
            nodes.append(stack[-1])
            open_tags[tag] += 1
        elif kind == "cdata" and m["cdata"]:
            add(m["cdata"])
    end_block()
    _mark(nodes)
    return [Block(n.path, text, n.noisy, n.in_content, n.article, link_chars) for n, text, link_chars in lines], paths


@dataclass(frozen=True)
class PathRatios:
    """Weights of the path scores.

    ``spread``: neighbours on either side that smoothing reaches. ``threshold``: share of the
    mean fused score above which a path is content. ``link_share``: share of text inside links
    above which a block counts as a list of links.
    """

    spread: int = 2
    threshold: float = 0.25
    link_share: float = 0.6


def path_scores(found: list[Block], rules: PathRatios) -> dict[int, float]:
    """The fused score of each root-to-leaf path.

    A path's ratio is its text length per node times its punctuation share; the blocks'
    ratios are smoothed in page order, and a path's own mean of smoothed ratios is fused with
    its raw ratio by a geometric mean.
    """
    chars: dict[int, list[int]] = {}
    for b in found:
        sums = chars.setdefault(b.path, [0, 0, 0])
        sums[0] += 0 if b.noisy else max(0, len(b.text) - b.link_chars)
        sums[1] += 0 if b.noisy else len(MARKS.findall(b.text))
        sums[2] += 1
    ratio = {p: n / k * (1 + marks / max(1, n) * 40) for p, (n, marks, k) in chars.items()}
    line = np.array([ratio[b.path] for b in found])
    reach = np.arange(-rules.spread, rules.spread + 1)
    kernel = np.exp(-reach**2 / 2.0)
    padded = np.concatenate((np.zeros(rules.spread), line, np.zeros(rules.spread)))
    smooth = np.convolve(padded, kernel / kernel.sum(), mode="valid")
    sums: dict[int, list[float]] = {}
    for b, s in zip(found, smooth, strict=True):
        pair = sums.setdefault(b.path, [0.0, 0])
        pair[0] += s
        pair[1] += 1
    return {p: float(np.sqrt(ratio[p] * total / k)) for p, (total, k) in sums.items()}


def main_blocks(page: str, rules: PathRatios = PathRatios()) -> list[str]:  # noqa: B008
    """The article's blocks in page order.

    Paths over the threshold are content. Their nearest common element is the article's own
    element; every block inside it that is not marked as noise stays, short headings included. It is no
    narrower than the article element that holds the best path, where there is one, and no text in that is
    dropped for its links; elsewhere lists of links stay only on a content path.
    """
    found, paths = blocks(page)
    if not found:
        return []
    scores = path_scores(found, rules)
    clean = [b for b in found if not b.noisy]
    if any(b.in_content for b in clean):
        clean = [b for b in clean if b.in_content]
    usable = [b for b in clean if b.link_chars <= rules.link_share * len(b.text)] or [b for b in clean if b.article >= 0]
    if not usable:
        return []
    weights = {b.path: scores[b.path] for b in usable}
    limit = rules.threshold * max(weights.values())
    content = {p for p, s in weights.items() if s >= limit}
    best = max(usable, key=lambda b: weights[b.path])
    # The leaf paragraph's own element is too narrow where one path alone is content.
    home = best.article if best.article >= 0 else paths.parent[best.path]
    for path in content:
        home = paths.shared(home, path)
    inside = paths.under(home)
    return [b.text for b in clean if inside[b.path] and (
        b.article >= 0 or b.path in content or b.link_chars <= rules.link_share * len(b.text))]


def extract_text(pages: DataFrame, rules: PathRatios = PathRatios()) -> DataFrame:  # noqa: B008
    """``(page_id, url, text, n_chars)``, a row per page.

    Null or empty html, or a page without an article, gives an empty text. Character
    references are decoded once; white space inside a block becomes one space, blocks are
    joined by one. Repeated pages give repeated rows. Other columns are not read. No shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [" ".join(main_blocks(h, rules)) if h else "" for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    wanted = pages.select("page_id", "url", "html")
    kinds = {f.name: f.dataType.simpleString() for f in wanted.schema}
    return wanted.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
