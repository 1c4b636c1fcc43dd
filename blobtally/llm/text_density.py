"""Main text of web pages by composite text density.

A page becomes a tree. Every node has its characters and tags, those inside links among them,
and its density: characters per tag, scaled down by the share of link text. The sum of a node's
children's densities is largest at the node that holds the article. The least density on the path
from the body to that node is the threshold below which parts inside are not text.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element names of the HTML standard, by their role here.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "svg", "math", "object"}
SKIPPED = RAW | {"head", "nav", "header", "footer", "aside", "form", "button", "select", "option", "label", "input",
                 "dialog", "menu", "audio", "video", "canvas"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i",
          "ins", "kbd", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt",
          "u", "var", "wbr"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
CLOSES_P = {"address", "article", "aside", "blockquote", "details", "div", "dl", "fieldset", "figcaption", "figure",
            "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "menu", "nav", "ol", "p",
            "pre", "section", "table", "ul"}
KEEPS_P = ("button", "td", "th", "div", "article", "section")
CLOSES_SELF = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"),
               "th": ("tr", "table"), "option": ("select",)}
# Words of class, id and role names of what is often no part of an article. Inside
# one they count only for elements that hold others, and only if density or link share says so too.
HOLDERS = {"div", "ul", "ol", "dl", "table", "center", "details", "fieldset"}
NOTICE = {"ad", "ads", "advert", "advertisement", "adverts", "banner", "breadcrumb", "breadcrumbs", "comment",
          "comments", "consent", "contentinfo", "cookie", "cookies", "disqus", "footer", "gdpr", "masthead", "menu",
          "modal", "nav", "navbar", "navigation", "newsletter", "notice", "pagination", "popup", "promo",
          "promoted", "promotion", "recommended", "related", "replies", "respond", "share", "sharing", "sidebar",
          "signup", "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget"}

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*+>?|<\?[^>]*+>?|"
                    r"<(/?)([A-Za-z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)", re.S)
_BROKEN = re.compile(r"<(/?)([A-Za-z][^\s/>]*+)([^>]*+)(?:>|\Z)")
_NAME = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)(?:hidden(?=[\s=/]|$)|aria-hidden\s*=\s*["']?true|style\s*=\s*["'][^"']*display\s*:\s*none)""", re.I)
_SPLIT = re.compile(r"[^a-z0-9]+|(?<=[a-z])(?=[A-Z])")
_SPACE = re.compile(r"\s+")


class Node:
    __slots__ = ("tag", "parent", "kids", "skip", "notice", "chars", "tags", "link_chars", "link_tags", "density", "total")

    def __init__(self, tag: str, parent: "Node | None", skip: bool, notice: bool = False):
        self.tag, self.parent, self.skip, self.notice = tag, parent, skip, notice
        self.kids: list = []  # nodes and strings, in page order
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0


def _unwanted(tag: str, attrs: str) -> bool:
    return tag in SKIPPED or bool(attrs and tag not in ("html", "body", "article", "main") and _HIDDEN.search(attrs))


def _named_notice(tag: str, attrs: str) -> bool:
    return bool(attrs) and tag not in ("html", "body", "article", "main") and any(
        w.lower() in NOTICE for _, value in _NAME.findall(attrs)
        for w in _SPLIT.split(value.strip("\"'")))


class _Open:
    """The open elements of a page, with the places of each tag name among them."""

    def __init__(self, root: Node):
        self.path, self.places = [root], {}

    def push(self, node: Node) -> None:
        self.places.setdefault(node.tag, []).append(len(self.path))
        self.path.append(node)

    def nearest(self, names: Iterable[str]) -> int:
        """Place of the innermost open element with one of the names; 0 if there is none."""
        return max((at[-1] for at in map(self.places.get, names) if at), default=0)

    def close(self, place: int) -> None:
        """Close the element at a place and all inside it; the root stays open."""
        while 0 < place < len(self.path):
            self.places[self.path.pop().tag].pop()


def parse(page: str) -> Node:
    """Tree of a page; unclosed and stray tags are taken as a browser would in the common cases.

    Takes time in proportion to the page, however deep or broken its markup is.
    """
    root = Node("html", None, False)
    opened = _Open(root)
    pos, n = 0, len(page)
    while pos < n:
        at = opened.path[-1]
        lt = page.find("<", pos)
        if lt < 0:
            lt = n
        if lt > pos:
            at.kids.append(page[pos:lt])
            pos = lt
            continue
        m = _TOKEN.match(page, pos) or _BROKEN.match(page, pos)
        if not m:  # a bare "<"
            at.kids.append("<")
            pos += 1
            continue
        pos = m.end()
        if m.re is _TOKEN and m.group(2) is None:
            continue
        tag, attrs = m.group(2).lower(), m.group(3)
        if m.group(1):
            opened.close(opened.nearest((tag,)))
            continue
        if tag in ("html", "body"):
            continue
        ends, stops = ("p", KEEPS_P) if tag in CLOSES_P else (tag, CLOSES_SELF.get(tag))
        if stops is not None:
            place = opened.nearest((ends, *stops))
            if opened.path[place].tag == ends:
                opened.close(place)
        at = opened.path[-1]
        node = Node(tag, at, _unwanted(tag, attrs), _named_notice(tag, attrs))
        at.kids.append(node)
        if tag in VOID or attrs.endswith("/") and tag not in ("p", "div", "a"):
            continue
        if tag in RAW:  # nothing inside is markup
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*>?", re.I).search(page, pos)
            pos = end.end() if end else n
            continue
        opened.push(node)
    return root


def _measure(root: Node) -> None:
    """Characters, tags, densities and density sums of all nodes that count, from the leaves up."""
    order, todo = [], [(root, False)]
    while todo:
        node, link = todo.pop()
        link = link or node.tag == "a"
        order.append((node, link))
        todo += [(k, link) for k in node.kids if isinstance(k, Node) and not k.skip]
    for node, link in reversed(order):
        node.chars = node.tags = node.link_chars = node.link_tags = 0
        for k in node.kids:
            if isinstance(k, str):
                c = len(_SPACE.sub(" ", html.unescape(k)).strip())
                node.chars += c
                node.link_chars += c if link else 0
            elif not k.skip:
                node.chars += k.chars
                node.link_chars += k.link_chars
                node.tags += k.tags + 1
                node.link_tags += k.link_tags + (k.tag == "a" or link)
    body = max(root.chars, 1)
    share = root.link_chars / body
    for node, _ in reversed(order):
        c, t = node.chars, max(node.tags, 1)
        lc, lt, other = max(node.link_chars, 1), max(node.link_tags, 1), max(c - node.link_chars, 1)
        base = math.log(c / other * node.link_chars + share * c + math.e)
        node.density = c / t * math.log(max(c / lc * t / lt, 1.0)) / math.log(max(base, 1.0 + 1e-9)) if c else 0.0
        node.total = sum(k.density for k in node.kids if isinstance(k, Node) and not k.skip)


def _blocks(node: Node, threshold: float) -> list[str]:
    """Text blocks of a subtree in page order; inside it, blocks of mostly link text go."""
    out: list[list[str]] = [[]]
    todo: list = [node]
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            out[-1].append(x)
        elif x is None:
            out.append([])
        elif x.skip:
            if x.tag not in INLINE:
                out.append([])
        elif x.tag == "br":
            out.append([])
        else:
            block = x.tag not in INLINE
            if block and x is not node and x.density < threshold and x.link_chars > 0.5 * x.chars:
                out.append([])
                continue
            if block:
                out.append([])
                todo.append(None)
            todo += reversed(x.kids)
    return [t for t in (_SPACE.sub(" ", html.unescape("".join(b))).strip() for b in out) if t]


def _select(root: Node) -> tuple[Node, float]:
    """The node with the largest density sum, and the least density on its path."""
    _measure(root)
    best, todo = root, [root]
    while todo:
        x = todo.pop()
        if x.total > best.total:
            best = x
        todo += [k for k in x.kids if isinstance(k, Node) and not k.skip]
    return best, _least_density(best)


def _least_density(node: Node) -> float:
    """The least density on the path from the root to a node."""
    least = node.density
    while node.parent is not None:
        node = node.parent
        least = min(least, node.density)
    return least


def _nodes(root: Node, skipped: bool = False) -> list[Node]:
    """All elements of a subtree, parents first; those in skipped ones only if asked for."""
    out = [root]
    for x in out:
        out += [k for k in x.kids if isinstance(k, Node) and (skipped or not k.skip)]
    return out


def main_text(page: str | None) -> str:
    """Main text of one page: its blocks in page order, joined by one space. Empty for null."""
    if not page:
        return ""
    root = parse(page)
    nodes = _nodes(root)
    holders: set[Node] = set()
    for x in reversed(nodes):
        if x.parent is not None and (x in holders or x.tag in ("article", "main")):
            holders.add(x.parent)
    # What holds the article is no notice.
    notices = [x for x in nodes if x.notice and x not in holders]
    for x in notices:
        x.skip = True
    best, threshold = _select(root)
    # The least density on the path is the threshold. Where the page marks its article, that is
    # taken; else the nodes around the best one, without those parts of them below the threshold.
    top, marked = best, best
    while marked is not None and marked.tag not in ("article", "main"):
        marked = marked.parent
    while top.parent is not None and top.tag not in ("article", "main") and top.parent.tag in ("article", "main", "section", "div") \
            and not top.parent.skip:
        if marked is None:  # a part beside the best node must be dense enough by itself
            for k in top.parent.kids:
                if isinstance(k, Node) and k is not top and k.tag not in INLINE and k.tag not in HEADINGS:
                    # A short paragraph has few characters a tag, but belongs to its neighbours.
                    part = k.tag in HOLDERS or k.tag == "section" or k.link_chars > 0.5 * k.chars
                    k.skip = k.skip or part and k.density < threshold
        top = top.parent
    # Inside the article a name alone does not count.
    article = set(_nodes(top if marked else best, skipped=True))
    inside = [x for x in notices if x in article]
    if inside:
        for x in inside:
            x.skip = False
        _measure(root)
        threshold = _least_density(best)
        for x in inside:
            x.skip = x.tag in HOLDERS and (x.density < threshold or x.link_chars > 0.5 * x.chars)
    return " ".join(_blocks(top, threshold))


def extract(pages: DataFrame) -> DataFrame:
    """Main text of every page: page_id, url, text and n_chars (long, code points).

    Null or empty html, and pages of which nothing is left, give the empty string. Very long
    pages are taken whole. Repeated rows and null ids give a row each.
    """
    @F.pandas_udf("string")
    def text_of(pages_: pd.Series) -> pd.Series:
        return pd.Series([main_text(p) for p in pages_], dtype=object)

    return pages.select("page_id", "url", text_of("html").alias("text")) \
        .withColumn("n_chars", F.length("text").cast("long"))
