"""Text blocks of one HTML page, each with the region it stands in."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import numpy as np

#: Regions of a block: inside the marked article, in marked boilerplate, or in neither.
ARTICLE, BOILERPLATE, OPEN = 0, 1, 2
#: For the time of parsing: in boilerplate that a name marks inside the article.
_NAMED = 3

# Elements and class names that mark what is not main text.
RAW = ("script", "style", "noscript", "template", "iframe", "svg", "canvas", "object", "textarea", "select", "title")
APART = {"nav", "footer", "aside", "form", "menu", "dialog", "button", "head"}
APART_NAMES = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "alert", "banner", "breadcrumb", "breadcrumbs",
    "comment", "comments", "complementary", "consent", "contentinfo", "cookie", "cookies", "copyright", "dialog", "disqus",
    "footer", "gdpr", "header", "login", "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice",
    "notices", "pager", "pagination", "popup", "promo", "related", "replies", "reply", "search", "share", "sharing",
    "sidebar", "signup", "social", "sponsor", "sponsored", "subscribe", "subscription", "toolbar", "widget",
}
#: Names that inside an article mark its own parts; there only whole names count ("share", not "share-prices").
OWN_NAMES = {"header", "banner", "masthead", "search", "notice", "notices", "alert", "widget", "social", "menu"}
INNER_NAMES = {"comment-list", "comments-area", "post-comments", "comment-form", "related-posts", "related-articles", "share-buttons",
               "social-links", "social-share", "ad-slot", "ad-container", "newsletter-signup"}
INNER_ROLES = {"banner", "complementary", "contentinfo", "navigation", "search", "form", "alert", "dialog"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
ARTICLE_ELEMENTS = {"article", "main"}
NESTING = APART | ARTICLE_ELEMENTS | {
    "header", "div", "section", "ul", "ol", "dl", "table", "figure", "details", "blockquote", "body", "center", "fieldset"}
BREAKING = NESTING | {
    "p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "dt", "dd", "tr", "caption", "thead", "tbody", "tfoot", "figcaption",
    "summary", "pre", "address", "hr", "html", "option", "legend"}
SPACING = {"br", "td", "th", "img", "wbr"}

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<raw>{'|'.join(RAW)})\b(?:[^>]*/>|.*?(?:</(?P=raw)\s*>|\Z))"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attributes>(?:\"[^\"]*\"|'[^']*'|[^>\"'])*+)>"
    r"|<[/!?][^>]*(?:>|\Z)"
    r"|<[a-zA-Z][^>]*(?:>|\Z)", re.S | re.I)
_NAMES = re.compile(r"""(?<![\w-])(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|/|$)|display\s*:\s*none""", re.I)
_WORD = re.compile(r"[a-z0-9]+")


def _mark(name: str, attributes: str, in_article: bool) -> int | None:
    """BOILERPLATE or _NAMED if an element is marked as apart from the main text, by what it is or by its names."""
    if name in APART or (name == "header" and not in_article):
        return BOILERPLATE
    if not attributes or name in ("body", "main", "html"):
        return None
    if _HIDDEN.search(attributes):
        return BOILERPLATE
    if name in HEADINGS:
        return None
    values = [(kind.lower(), v.strip("\"'").lower()) for kind, v in _NAMES.findall(attributes)]
    if in_article:
        whole = {n for kind, v in values if kind != "role" for n in v.split()}
        roles = {n for kind, v in values if kind == "role" for n in v.split()}
        return _NAMED if roles & INNER_ROLES or whole & (APART_NAMES - OWN_NAMES | INNER_NAMES) else None
    text = " ".join(v for _, v in values)
    # An article is often labelled by what stands around it ("post has-sidebar"), so only whole names count there.
    return None if APART_NAMES.isdisjoint(text.split() if name == "article" else _WORD.findall(text)) else BOILERPLATE


def text_blocks(html: str | None) -> list[tuple[str, int]]:
    """(text, region) of every non-empty block in page order.

    Character references are decoded and white space becomes one space.  Unclosed
    elements end with the element around them, unclosed inline ones with their block;
    a stray end tag is ignored.  A marked paragraph or inline element goes as a marked
    container does.  Names alone never take a heading out of an article, nor most of its text.
    """
    out: list[tuple[str, int]] = []
    stack: list[tuple[str, int]] = []  # (element, region its content has)
    parts: list[str] = []
    region, own = OPEN, None  # of the containers around, and the mark of the present block
    muted, depth_muted = "", 0  # a marked inline element, and how many of its name are open

    def flush() -> None:
        text = " ".join(unescape("".join(parts)).split())
        parts.clear()
        if text:
            out.append((text, region if own is None else own))

    at = 0
    html = html or ""
    for found in _MARKUP.finditer(html):
        if not muted:
            parts.append(html[at:found.start()])
        at = found.end()
        name, attributes = (found["name"] or "").lower(), found["attributes"] or ""
        if name in SPACING:
            parts.append(" ")
        if name not in BREAKING:
            if muted and name == muted:
                depth_muted += -1 if found["close"] else 1
                muted = muted if depth_muted else ""
            elif name and not muted and not found["close"] and name not in SPACING and not attributes.endswith("/"):
                if attributes and _mark(name, attributes, region == ARTICLE) is not None:
                    muted, depth_muted = name, 1
            continue
        flush()
        muted, own = "", None
        if name not in NESTING:
            if attributes and not found["close"] and region in (ARTICLE, OPEN):
                own = _mark(name, attributes, region == ARTICLE)
            continue
        if found["close"]:
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), None)
            if depth is not None:
                del stack[depth:]
        elif not attributes.endswith("/"):
            if name == "body":  # ends a head that was left open
                stack.clear()
            inside = stack[-1][1] if stack else OPEN
            if inside in (ARTICLE, OPEN):
                mark = _mark(name, attributes, inside == ARTICLE)
                if mark is not None:
                    inside = mark
                elif name in ARTICLE_ELEMENTS:
                    inside = ARTICLE
            stack.append((name, inside))
        region = stack[-1][1] if stack else OPEN
    if not muted:
        parts.append(html[at:])
    flush()
    size = lambda kind: sum(len(t) for t, r in out if r == kind)
    named = ARTICLE if size(_NAMED) > size(ARTICLE) else BOILERPLATE
    return [(t, named if r == _NAMED else r) for t, r in out]


#: Bits of alignment state kept at once; longer pairs of pages are halved first.
ALIGNED_BITS = 1 << 24


def common_lines(left: list[int], right: list[int]) -> tuple[list[int], list[int]]:
    """Places in ``left`` and ``right`` that a longest common subsequence aligns.

    Equal ends are cut off first.  The rest is solved with bit vectors, one a line; if
    they came to more than ``ALIGNED_BITS``, ``left`` is halved where the two halves' best
    prefix and suffix of ``right`` meet, so that memory grows with the lines and not with their product.
    """
    lefts, rights = [], []
    work = [(0, len(left), 0, len(right))]
    while work:
        start, n, at, m = work.pop()
        while start < n and at < m and left[start] == right[at]:
            lefts.append(start)
            rights.append(at)
            start, at = start + 1, at + 1
        while n > start and m > at and left[n - 1] == right[m - 1]:
            n, m = n - 1, m - 1
            lefts.append(n)
            rights.append(m)
        a, b = left[start:n], right[at:m]
        if not a or not b:
            continue
        if len(a) * len(b) <= ALIGNED_BITS or len(a) == 1:
            for i, j in _aligned(a, b):
                lefts.append(start + i)
                rights.append(at + j)
            continue
        middle = len(a) // 2
        ahead, back = _prefix_lengths(a[:middle], b), _prefix_lengths(a[:middle - 1 if middle else None:-1], b[::-1])[::-1]
        cut = int(np.argmax(ahead + back))
        work += [(start, start + middle, at, at + cut), (start + middle, n, at + cut, m)]
    return sorted(lefts), sorted(rights)


def _vectors(a: list[int], b: list[int]) -> Iterator[int]:
    """After each line of ``a`` a bit vector over ``b``: a zero bit counts one more common line."""
    places: dict[int, int] = {}
    wanted = set(a)
    for j, line in enumerate(b):
        if line in wanted:
            places[line] = places.get(line, 0) | (1 << j)
    vector = full = (1 << len(b)) - 1
    for line in a:
        if line in places:
            step = vector & places[line]
            vector = ((vector + step) | (vector - step)) & full
        yield vector


def _prefix_lengths(a: list[int], b: list[int]) -> np.ndarray:
    """Length of a longest common subsequence of ``a`` and every prefix of ``b``."""
    vector = (1 << len(b)) - 1
    for vector in _vectors(a, b):
        pass
    bits = np.unpackbits(np.frombuffer(vector.to_bytes(-(-len(b) // 8), "little"), np.uint8), bitorder="little")[:len(b)]
    return np.concatenate([[0], np.cumsum(1 - bits.astype(np.int64))])


def _aligned(a: list[int], b: list[int]) -> Iterator[tuple[int, int]]:
    rows = list(_vectors(a, b))
    i, j = len(a), len(b)

    def length(i: int, j: int) -> int:
        return j - (rows[i - 1] & ((1 << j) - 1)).bit_count() if i else 0

    while i and j:
        if length(i, j) == length(i - 1, j):
            i -= 1
        elif length(i, j) == length(i, j - 1):
            j -= 1
        else:
            i, j = i - 1, j - 1
            yield i, j
