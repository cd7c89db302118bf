"""Main text of web pages by composite text density (CTD) over the DOM.

Every node gets the link-adjusted characters-per-tag density of Sun, Song and Liao (SIGIR 2011); a node's density
sum is the sum of its children's densities. The node of the largest sum is the content subtree; the smallest density
on the path from ``body`` down to it is the threshold, and nodes of that subtree that hold links and fall below the
threshold go with their subtrees. Plain text nodes stay whatever their density: the pure rule drops titles and short
paragraphs of the article, which the main text must keep. Pages are independent, so Spark spreads them over tasks and
no shuffle is needed.
"""

from __future__ import annotations

import math
import re
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carepanel.llm.shared import ship_package

# Fixed values (HTML): elements without text of the page, elements without content, and block elements.
NO_TEXT = {"head", "script", "style", "noscript", "template", "title", "svg", "iframe", "object", "canvas", "select", "textarea", "button"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCKS = {
    "address", "article", "aside", "blockquote", "body", "caption", "dd", "div", "dl", "dt", "fieldset", "figcaption", "figure",
    "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "html", "li", "main", "nav", "ol", "p", "pre",
    "section", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
# Elements that close an open paragraph when they start (HTML's "in button scope" rule), and the scope's borders.
CLOSE_P = {"address", "article", "aside", "blockquote", "div", "dl", "fieldset", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6",
           "header", "hr", "main", "nav", "ol", "p", "pre", "section", "table", "ul", "li", "dd", "dt", "figure", "figcaption"}
SCOPE = {"html", "body", "table", "td", "th", "caption", "button", "object", "template"}
# Boilerplate by its element or by a word of its class, id or role: menus, headers, footers, sidebars, forms, notices,
# adverts and reader comments. They leave the tree before densities are taken.
BOILERPLATE = {"nav", "header", "footer", "aside", "form", "menu", "dialog"}
HINTS = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert|advertisement|banner|sponsored|promo|comment|comments|sidebar|notice|cookie|cookies|"
    r"menu|navbar|nav|breadcrumb|footer|header|share|social|related|popup|modal|newsletter|subscribe|disqus|respond)(?:$|[\s_-])",
    re.I,
)
SPACE = re.compile(r"\s+")


class Node:
    __slots__ = ("tag", "name", "children", "parent", "chars", "tags", "link_chars", "link_tags", "density")

    def __init__(self, tag: str, parent: Node | None, name: str = ""):
        self.tag, self.name, self.parent, self.children = tag, name or tag, parent, []


class _Tree(HTMLParser):
    """A forgiving DOM: unclosed paragraphs and list items close as browsers close them, stray end tags are ignored."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("#root", None)
        self.open = [self.root]
        self.hidden = 0

    def _close_to(self, tag: str, borders: set[str]) -> None:
        for at in range(len(self.open) - 1, 0, -1):
            name = self.open[at].name
            if name == tag:
                self._pop(at)
                return
            if name in borders:
                return

    def _pop(self, at: int) -> None:
        for node in self.open[at:]:
            if node.name in NO_TEXT or node.tag == "#boiler":
                self.hidden -= 1
        del self.open[at:]

    def handle_starttag(self, tag, attrs):
        if tag in CLOSE_P:
            self._close_to("p", SCOPE)
        if tag == "li":
            self._close_to("li", SCOPE | {"ul", "ol"})
        if tag in ("dd", "dt"):
            self._close_to("dd", SCOPE | {"dl"})
            self._close_to("dt", SCOPE | {"dl"})
        words = " ".join(v for k, v in attrs if k in ("class", "id", "role") and v)
        boiler = tag in BOILERPLATE or bool(HINTS.search(words))
        node = Node("#boiler" if boiler else tag, self.open[-1], tag)
        self.open[-1].children.append(node)
        if tag in VOID:
            return
        self.open.append(node)
        if tag in NO_TEXT or boiler:
            self.hidden += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and len(self.open) > 1:
            self._pop(len(self.open) - 1)

    def handle_endtag(self, tag):
        for at in range(len(self.open) - 1, 0, -1):
            if self.open[at].name == tag:
                self._pop(at)
                return

    def handle_data(self, data):
        if not self.hidden and data:
            self.open[-1].children.append(data)


def parse(html: str) -> Node:
    tree = _Tree()
    tree.feed(html)
    tree.close()
    return tree.root


def _post_order(root: Node) -> list[Node]:
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack.extend(c for c in node.children if not isinstance(c, str))
    return order[::-1]


def _measure(root: Node) -> list[Node]:
    """Characters, tags, link characters and link tags of every element's subtree (text in normalised white space)."""
    nodes = _post_order(root)
    for node in nodes:
        own = sum(len(SPACE.sub(" ", c)) for c in node.children if isinstance(c, str))
        kids = [c for c in node.children if not isinstance(c, str) and c.tag != "#boiler"]
        node.chars = own + sum(k.chars for k in kids)
        node.tags = 1 + sum(k.tags for k in kids)
        if node.tag == "a":
            node.link_chars, node.link_tags = node.chars, 1 + sum(k.link_tags for k in kids)
        else:
            node.link_chars = sum(k.link_chars for k in kids)
            node.link_tags = sum(k.link_tags for k in kids)
    return nodes


def _density(node: Node, body_ratio: float) -> float:
    """Composite text density: (C/T) * log base ln(C/nLC * LC + LCb/Cb * C + e) of (C/LC * T/LT).

    Zero link characters or link tags count as one; a base of exactly 1 (no links at all) is taken as e.
    """
    c, t = node.chars, max(node.tags, 1)
    if c == 0:
        return 0.0
    lc, lt = max(node.link_chars, 1), max(node.link_tags, 1)
    non_link = max(c - node.link_chars, 1)
    shift = c / non_link * node.link_chars + body_ratio * c
    base = math.log(shift + math.e) if shift > 0 else 1.0
    value = math.log(c / lc * t / lt)
    return c / t * (value / math.log(base) if base > 1.0 else value)


_END = object()


def _blocks(top: Node, threshold: float) -> list[str]:
    """Text of the kept part of ``top`` in page order, one entry per block, white space made one space, trimmed."""
    blocks, current = [], []
    stack: list = [top]
    while stack:
        item = stack.pop()
        if item is _END:
            blocks.append("".join(current))
            current = []
            continue
        if isinstance(item, str):
            current.append(item)
            continue
        if item.tag == "#boiler" or (item is not top and item.link_tags and item.density < threshold):
            continue
        if item.tag == "br":
            current.append(" ")
            continue
        if item.tag in BLOCKS:
            blocks.append("".join(current))
            current = []
            stack.append(_END)
        stack.extend(reversed(item.children))
    blocks.append("".join(current))
    return [b for b in (SPACE.sub(" ", b).strip() for b in blocks) if b]


def main_text(html: str | None) -> str:
    """The main text of one page; empty when the page is null, empty or has no text outside boilerplate.

    Character references are decoded, white space inside a block becomes one space, blocks are trimmed and joined in
    page order by two newlines; nothing is cut.
    """
    if not html:
        return ""
    root = parse(html)
    nodes = _measure(root)
    body = next((n for n in reversed(nodes) if n.tag == "body"), root)
    ratio = body.link_chars / body.chars if body.chars else 0.0
    for node in nodes:
        node.density = _density(node, ratio)
    best, best_sum, stack = body, -1.0, [body]
    while stack:  # pre-order: ties go to the node higher and earlier in the page
        node = stack.pop()
        kids = [c for c in node.children if not isinstance(c, str) and c.tag != "#boiler"]
        total = sum(k.density for k in kids)
        if total > best_sum:
            best, best_sum = node, total
        stack.extend(reversed(kids))
    threshold, node = best.density, best
    while node is not None and node is not body.parent:
        threshold = min(threshold, node.density)
        node = node.parent
    return "\n\n".join(_blocks(best, threshold))


def with_main_text(pages: DataFrame, html_col: str = "html", into: str = "main_text") -> DataFrame:
    """Every row with ``into``: the main text of its whole html (null html: empty text); all other columns stay.

    A column already named ``into`` is replaced.
    """
    ship_package(pages.sparkSession)

    @F.arrow_udf("string")
    def extracted(values: pa.Array) -> pa.Array:
        return pa.array([main_text(v.as_py()) for v in values], pa.string())

    return pages.withColumn(into, extracted(F.col(html_col).cast("string")))
