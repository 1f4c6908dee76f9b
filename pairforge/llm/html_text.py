"""Main text of web pages by the distribution of text over lines.

1. Markup is stripped in one pass of a regular expression. Every block becomes a line;
   a block of scripts, menus, adverts and the like, or one made of links, becomes a blank line.
2. Text lengths are summed over sliding windows of lines. The sums surge where text
   begins and dive to zero where only blank lines follow.
3. The lines between a surge and its dive are kept whole, short ones too. Sums surge at
   RISE. A line of a declared article weighs RISE more, so the sums dive below RISE there;
   without one they dive at zero. This holds if no more text surges outside of the
   article than lies in it; else its tag decides nothing (teasers beside a body).
4. Without a declared article, what lies between the first surge and the last dive is
   kept too, and so are paragraphs and sentences before and after, however short.

Elements that only their class or id names as boilerplate are judged once the page is
read: one that holds most of the text is a wrapper of the article and is kept.

A null page gives an empty text. Broken markup never fails: unclosed elements end with
their parents, a tag cut off at the end of a page is dropped, and so is an unclosed
comment. Repeated rows each give their text; nothing is cut, however long. An empty table
gives no rows. Only ``page_id``, ``url`` and ``html`` are read, so further columns may have any names.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pairforge.llm.words import small_batches

#: Lines of a window, and the sum that a stretch must reach.
WINDOW, RISE = 3, 86
#: A line with more than this share of its characters in links is a menu.
LINK_SHARE = 0.6

RAW = {"script", "style", "title", "textarea", "noscript", "iframe", "xmp", "noframes", "noembed", "template", "svg", "object", "canvas", "audio", "video", "annotation", "annotation-xml"}
VOID = {"br", "hr", "img", "input", "meta", "link", "area", "base", "col", "embed", "param", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd",
    "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt",
    "u", "var", "img", "wbr", "picture", "source", "nobr", "link", "meta",
    "math", "mi", "mn", "mo", "ms", "mtext", "mrow", "msup", "msub", "msubsup", "mfrac", "msqrt", "mroot", "mover", "munder",
    "munderover", "mmultiscripts", "mprescripts", "mstyle", "mspace", "mpadded", "mphantom", "menclose", "mfenced", "mtable", "mtr",
    "mtd", "semantics",
}
#: Elements of running text.
PROSE = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre", "li", "dt", "dd", "td", "th", "figcaption"}
SENTENCE = re.compile(r"[.!?\u2026\u3002\uff01\uff1f][\"'\u2019\u201d\u00bb)\]]*$")
BOILERPLATE_TAGS = {"head", "nav", "header", "footer", "aside", "button", "select", "option", "fieldset", "dialog", "menu", "datalist"}
BOILERPLATE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alertdialog", "alert", "menu", "menubar", "toolbar", "form"}
#: Parts of class names and ids that name what is not the article.
BOILERPLATE_NAMES = {
    "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "header", "masthead", "topbar", "footer", "sidebar", "aside",
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "adsbygoogle", "sponsor", "sponsored", "promo", "promotion", "banner",
    "cookie", "cookies", "consent", "gdpr", "notice", "popup", "modal", "overlay", "newsletter", "subscribe", "subscription", "signup",
    "login", "share", "sharing", "social", "related", "recommended", "recommendations", "widget", "pagination", "pager", "toolbar",
    "comment", "comments", "commentlist", "respond", "replies", "disqus", "form", "search", "copyright",
}
COMMENT_NAMES = {"comment", "comments", "commentlist", "reply", "replies", "respond", "disqus"}
#: Parts that are not the article even if they hold articles.
ASIDE_NAMES = COMMENT_NAMES | {"related", "recommended", "recommendations", "sidebar", "aside", "widget", "sponsored", "promo", "promotion"}
#: A class that begins so says what the element has or lacks, not what it is.
ABOUT = {"no", "not", "has", "with", "without", "hide", "show"}
#: Elements that end an open one of the same group.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "p": {"p"}}
LISTS = {"ul", "ol", "dl", "table", "select", "article", "main", "section", "div", "body"}

MARKUP = re.compile(
    r"""<!--(?:>|->|.*?(?:--!?>|\Z))"""
    r"""|<[!?][^>]*(?:>|\Z)"""
    r"""|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>"""
    r"""|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""",
    re.S,
)
ATTRIBUTE = re.compile(r"""([a-zA-Z][\w:-]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
HIDDEN_STYLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


@dataclass
class Line:
    """Text of a block: all of it, what of it lies in links, and whether and where it can be article text."""

    text: str
    linked: int
    blank: bool
    named: int  # the innermost open element that its names call boilerplate, or -1
    declared: bool
    prose: bool


@dataclass
class Named:
    """An element that its class or id calls boilerplate, what it lies in, and how many declared articles it holds."""

    names: set[str]
    layout: bool  # no class begins with the name, as in "page-header"
    parent: int = -1
    articles: int = 0


@dataclass
class Page:
    """The lines of a page, and the open elements while it is read."""

    lines: list[Line] = field(default_factory=list)
    open: list[tuple[str, bool, int, bool, bool]] = field(default_factory=list)  # name, dropped, named, article, prose
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    dropped: bool = False
    named: int = -1
    inside: bool = False
    prose: bool = False
    elements: list[Named] = field(default_factory=list)
    articles: int = 0

    def text(self, piece: str) -> None:
        if piece:
            piece = html.unescape(piece) if "&" in piece else piece
            self.parts.append(piece)
            if any(x[0] == "a" for x in self.open):
                self.linked += len(piece.strip())

    def end_line(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                prose = self.prose or bool(SENTENCE.search(text[-9:]))
                self.lines.append(Line(text, self.linked, self.dropped, self.named, self.inside, prose))
            self.parts, self.linked = [], 0

    def enter(self, name: str, attributes: str) -> None:
        if name not in INLINE:
            self.end_line()
        if name in VOID:
            return
        if name in CLOSES or name not in INLINE:
            self._imply_ends(name)
        values = _attributes(attributes) if attributes.strip() else {}
        kind = _kind(name, values, self.inside)
        dropped, named = self.dropped or kind == "boilerplate", self.named
        if isinstance(kind, Named):
            kind.parent, named = named, len(self.elements)
            self.elements.append(kind)
        if (dropped, named) != (self.dropped, self.named) and name in INLINE:
            self.end_line()
        if kind == "article" and not dropped:
            self.articles += 1
            if named >= 0:
                self.elements[named].articles += 1
        self.open.append((name, dropped, named, (kind == "article" or self.inside) and not dropped, self.prose or name in PROSE))
        self._refresh()

    def leave(self, name: str) -> None:
        if name == "br" or name not in INLINE:
            self.end_line()
        for k in range(len(self.open) - 1, -1, -1):
            own = self.open[k][0]
            if own == name:
                if name in INLINE and self.open[k][1:3] != (self.open[k - 1][1:3] if k else (False, -1)):
                    self.end_line()
                del self.open[k:]
                break
            if name in INLINE and own not in INLINE:
                break
        self._refresh()

    def _imply_ends(self, name: str) -> None:
        group = CLOSES.get(name, set())
        for k in range(len(self.open) - 1, -1, -1):
            own = self.open[k][0]
            if own in group or (own == "p" and name not in INLINE):
                del self.open[k:]
                break
            if own in LISTS or (own not in INLINE and own not in CLOSES):
                break
        self._refresh()

    def _refresh(self) -> None:
        _, self.dropped, self.named, self.inside, self.prose = self.open[-1] if self.open else ("", False, -1, False, False)


def _attributes(text: str) -> dict[str, str]:
    return {k.lower(): v.strip("\"'") for k, v in ATTRIBUTE.findall(text)}


def _named(values: dict[str, str]) -> tuple[set[str], bool]:
    """Names of boilerplate in class and id, and whether no class begins with one."""
    words = [w for w in (re.split(r"[^a-z0-9]+", c) for c in f"{values.get('class', '')} {values.get('id', '')}".lower().split()) if w[0] not in ABOUT]
    return {x for w in words for x in w} & (BOILERPLATE_NAMES | COMMENT_NAMES), not any(w[0] in BOILERPLATE_NAMES for w in words)


def _kind(name: str, values: dict[str, str], inside: bool) -> str | Named | None:
    """Whether an element declares the article, is not part of one, is named so, or none of these."""
    names, layout = _named(values) if values else (set(), True)
    role = values.get("role", "").lower()
    if "hidden" in values or values.get("aria-hidden") == "true" or HIDDEN_STYLE.search(values.get("style", "")):
        return "boilerplate"
    if name in ("html", "body"):
        return None
    if name in ("article", "main") or role in ("main", "article") or values.get("itemprop", "").lower() == "articlebody":
        return Named(names, False) if names & COMMENT_NAMES else "article"
    if name in BOILERPLATE_TAGS and not (name == "header" and inside):
        return "boilerplate"
    if role in BOILERPLATE_ROLES:
        return "boilerplate"
    if names & BOILERPLATE_NAMES:
        return Named(names, layout)
    return Named({"form"}, True) if name == "form" else None


def page_lines(source: str) -> list[Line]:
    """The lines of a page."""
    page, at, end = Page(), 0, len(source)
    while at < end:
        tag = MARKUP.search(source, at)
        if tag is None:
            page.text(source[at:])
            break
        page.text(source[at : tag.start()])
        at = tag.end()
        closing, name, attributes = tag.group(1, 2, 3) if tag.group(2) else tag.group(4, 5, 6)
        if not name:
            continue
        name = name.lower()
        if closing:
            page.leave(name)
        elif name in RAW and not attributes.rstrip().endswith("/"):
            page.end_line()
            stop = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(source, at)
            at = stop.end() if stop else end
        else:
            page.enter(name, attributes)
    page.end_line()
    _judge_named(page)
    return page.lines


def _is_menu(line: Line) -> bool:
    return not line.declared and line.linked > LINK_SHARE * len(line.text)


def _judge_named(page: Page) -> None:
    """Blank the lines of elements with names of boilerplate, except for wrappers that hold most of the text."""
    elements = page.elements
    own, outside = [0] * len(elements), 0
    for x in page.lines:
        if not x.blank and not _is_menu(x):
            if x.named < 0:
                outside += len(x.text)
            else:
                own[x.named] += len(x.text)
    held = own.copy()
    for k in range(len(elements) - 1, -1, -1):
        if (parent := elements[k].parent) >= 0:
            held[parent] += held[k]
            elements[parent].articles += elements[k].articles
    # What is kept by now is outside of each element that is still to be judged; parents come first.
    kept = {-1}
    for k in sorted(range(len(elements)), key=lambda k: (-held[k], k)):
        e = elements[k]
        if e.parent not in kept or held[k] <= outside:
            continue
        if e.articles:
            wrapper = e.layout or not e.names & ASIDE_NAMES or outside < RISE
        elif e.layout:
            wrapper = held[k] >= RISE and not e.names & COMMENT_NAMES
        else:
            wrapper = held[k] >= RISE > outside and e.articles == page.articles and not e.names & COMMENT_NAMES
        if wrapper:
            kept.add(k)
            outside += own[k]
    for x in page.lines:
        x.blank = x.blank or x.named not in kept


def stretches(weights: np.ndarray, rise: float, dive: float, window: int = WINDOW) -> list[tuple[int, int, bool]]:
    """First line and end of each stretch whose window sums reach ``dive`` throughout, and whether they surge to ``rise``."""
    sums = np.convolve(np.r_[np.zeros(window - 1), weights, np.zeros(window - 1)], np.ones(window), "valid")
    edges = np.flatnonzero(np.diff(np.r_[0, (sums >= dive).astype(int), 0]))
    return [(max(0, a - window + 1), b, bool(sums[a:b].max() >= rise)) for a, b in zip(edges[::2], edges[1::2], strict=True)]


def main_text(source: str | None) -> str:
    """The text of the article of a page."""
    lines = page_lines(source or "")
    if not lines:
        return ""
    weights = np.array([0 if x.blank or _is_menu(x) else len(x.text) for x in lines])
    inside = np.array([x.declared and not x.blank for x in lines])
    outside = np.where(inside, 0, weights)
    surging = sum(int(outside[a:b].sum()) for a, b, surges in stretches(outside, RISE, 1) if surges)
    keep = np.zeros(len(lines), bool)
    if inside.any() and surging <= weights[inside].sum():
        for a, b, _ in stretches(weights + RISE * inside, RISE, RISE):
            keep[a:b] = True
    else:
        weights = np.array([0 if x.linked > LINK_SHARE * len(x.text) else w for x, w in zip(lines, weights, strict=True)])
        found = stretches(weights, min(RISE, weights.sum() or 1), 1)
        body = [(a, b) for a, b, surges in found if surges]
        if body:
            keep[body[0][0] : body[-1][1]] = True
        for a, b, _ in found:
            keep[a:b] |= any(x.prose and w for x, w in zip(lines[a:b], weights[a:b], strict=True))
    return " ".join(x.text for x, k, w in zip(lines, keep, weights, strict=True) if k and w)


def extract_text(pages: DataFrame) -> DataFrame:
    """Per row of ``pages``: ``page_id, url, text, n_chars``."""
    small_batches(pages.sparkSession)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(v) for v in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    rows = pages.select(F.col("page_id").cast("bigint"), F.col("url").cast("string"), F.col("html").cast("string"))
    return rows.mapInArrow(each, "page_id bigint, url string, text string, n_chars bigint")
