"""Visible text of web pages by layout-aware rendering.

A tokenizer feeds a tree builder that closes elements whose end tags may be left out
(paragraphs before blocks, list items, table parts, options) and ignores end tags that
match nothing. The tree is then walked once, without recursion, by a renderer that skips
what a browser does not show (of drawings and formulas too, whose text is kept), collapses white space outside preformatted text, keeps
blocks apart as their margins do, marks and indents list items, and aligns table cells.
Nothing is classified or left out as boilerplate: all visible text stays.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Cells are padded to the widest of their column, up to this width; longer ones keep all their text.
PAD_WIDTH = 60

#: An attribute: a quote opens a value only behind the equals sign, elsewhere it is a plain character.
_VALUED = (
    r"([^ \t\n\r\f/>][^ \t\n\r\f/>=]*+)"
    r"(?:[ \t\n\r\f]*+=[ \t\n\r\f]*+(?:\"([^\"]*+)(?:\"|\Z)|'([^']*+)(?:'|\Z)|([^ \t\n\r\f>\"'][^ \t\n\r\f>]*+))?+)?+"
)
_ATTRIBUTE = re.compile(_VALUED)
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<![^>]*(?:>|\Z)|<\?[^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)"
    rf"((?:[ \t\n\r\f/]++|{re.sub(r'[(](?=\[)', '(?:', _VALUED)})*+)(?:>|\Z)", re.S
)
_SPACES = re.compile(r"[ \t\n\r\f]+")
_HIDDEN_STYLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse)", re.I)

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = frozenset(
    "head script style template title noscript iframe noembed noframes object video audio canvas datalist".split()
)
#: Parts of drawings and formulas that are not shown where they stand; elsewhere these names mean nothing.
UNSEEN_FOREIGN = {
    "svg": frozenset("title desc metadata defs symbol clippath mask marker pattern".split()),
    "math": frozenset("annotation annotation-xml mphantom".split()),
}
#: Elements of drawings and formulas whose content is read as HTML again.
HTML_INSIDE = frozenset("foreignobject desc title annotation-xml mi mo mn ms mtext".split())
#: HTML elements that end a drawing or formula left open.
ENDS_FOREIGN = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol "
    "p pre ruby s small span strong strike sub sup table tt u ul var".split()
)
#: Blocks by the blank lines around them.
MARGIN = {
    **dict.fromkeys("p h1 h2 h3 h4 h5 h6 ul ol dl pre blockquote table figure hr menu".split(), 1),
    **dict.fromkeys(
        "html body div li dt dd article section nav header footer main aside form fieldset legend address center "
        "details summary figcaption caption tr thead tbody tfoot option optgroup hgroup search dialog text foreignobject mtr".split(), 0),
}
#: Elements whose start closes an open paragraph.
ENDS_P = frozenset(MARGIN) - set("html body tr thead tbody tfoot caption option optgroup legend text foreignobject mtr".split())
_ROWS, _CELLS, _PARTS = {"tr"}, {"td", "th"}, {"thead", "tbody", "tfoot"}
#: For a start tag: which open elements it closes, and where the search for them stops.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}), "optgroup": ({"option", "optgroup"}, {"select"}),
    **dict.fromkeys(_CELLS, (_CELLS | {"caption", "colgroup"}, {"tr", "table"})),
    "tr": (_ROWS | _CELLS | {"caption", "colgroup"}, {"table"}),
    **dict.fromkeys(_PARTS, (_PARTS | _ROWS | _CELLS | {"caption", "colgroup"}, {"table"})),
}


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.children = tag, attrs, []


def _attributes(source: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(source):
        found.setdefault(m[1].lower(), unescape(m[2] or m[3] or m[4] or ""))
    return found


#: Elements whose content an end tag of another kind does not reach out of, and those that may end across them.
SCOPES = {"td", "th", "caption", "table"}
TABLE_PARTS = SCOPES | {"tr", "tbody", "thead", "tfoot"}


def build(html: str) -> Node:
    """The tree of a page."""
    root = Node("", {})
    stack, opened = [root], Counter()
    foreign = [""]  # for each open element: "svg" or "math" where its content belongs to one

    inside = [Counter()]  # open elements by tag, since the nearest cell, caption or table

    def pop() -> None:
        tag = stack.pop().tag
        opened[tag] -= 1
        if tag in SCOPES:
            inside.pop()
        inside[-1][tag] -= 1
        foreign.pop()

    def close(tags: set, stops: set) -> None:
        """Close the outermost open element of ``tags`` above the nearest of ``stops``."""
        if not any(opened[t] for t in tags):
            return
        at = None
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag in stops:
                break
            if stack[k].tag in tags:
                at = k
        while at is not None and len(stack) > at:
            pop()

    at = 0
    for m in iter(lambda: _TOKEN.search(html, at), None):
        if m.start() > at:
            stack[-1].children.append(unescape(html[at : m.start()]))
        at = m.end()
        if m[2] is None:
            if foreign[-1] and html.startswith("<![CDATA[", m.start()):
                end = html.find("]]>", m.start())
                stack[-1].children.append(html[m.start() + 9 : end if end >= 0 else len(html)])
                at = end + 3 if end >= 0 else len(html)
            if at >= len(html):
                break
            continue
        tag = m[2].lower()
        if m[1]:
            if tag == "br":
                stack[-1].children.append(Node("br", {}))
            elif opened[tag] if tag in TABLE_PARTS else inside[-1][tag]:
                while stack[-1].tag != tag:
                    pop()
                pop()
            elif tag == "p":
                stack[-1].children.append(Node("p", {}))
            continue
        if tag in ENDS_FOREIGN:
            while foreign[-1]:
                pop()
        own = tag if tag in ("svg", "math") else foreign[-1]
        if not own and tag in ENDS_P:
            close({"p"}, {"button", "td", "th", "table", "caption"})
        if not own and tag in CLOSES:
            close(*CLOSES[tag])
        if tag == "body":
            close({"head"}, set())
        node = Node(tag, _attributes(m[3]) if m[3] else {})
        stack[-1].children.append(node)
        if own and tag in UNSEEN_FOREIGN[own]:
            node.attrs["hidden"] = ""
        if m[3].endswith("/") if own else tag in VOID:
            continue
        if tag in RAW and not own:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?|\Z", re.I).search(html, at)
            text = html[at : end.start()]
            node.children.append(unescape(text) if tag in ("textarea", "title") else text)
            at = end.end()
            continue
        stack.append(node)
        opened[tag] += 1
        inside[-1][tag] += 1
        if tag in SCOPES:
            inside.append(Counter())
        foreign.append("" if tag in HTML_INSIDE else own)
    if at < len(html):
        stack[-1].children.append(unescape(html[at:]))
    return root


def visible(node: Node) -> bool:
    a = node.attrs
    return not (
        node.tag in UNSEEN or "hidden" in a or (node.tag == "input" and a.get("type", "").lower() == "hidden")
        or _HIDDEN_STYLE.search(a.get("style", ""))
    )


class Lines:
    """Lines under way, with pending margins and list prefixes."""

    def __init__(self):
        self.lines: list[str] = []
        self.now: list[str] = []
        self.space, self.gap = False, 0
        self.prefixes: list[list[str]] = []

    def text(self, text: str, pre: bool) -> None:
        if pre:
            for k, line in enumerate(text.replace("\r\n", "\n").split("\n")):
                if k:
                    self.end(True)
                if line:
                    self.now.append(line)
            return
        words = _SPACES.sub(" ", text)
        if not words:
            return
        if words[0] == " ":
            self.space, words = True, words[1:]
        if words:
            if self.space and self.now and not self.now[-1].endswith(" "):
                self.now.append(" ")
            self.space = words[-1] == " "
            self.now.append(words[:-1] if self.space else words)

    def end(self, keep: bool = False) -> None:
        """End the line; an empty one is only kept on demand."""
        line = "".join(self.now)
        self.now, self.space = [], False
        if line or keep:
            if line:
                if self.gap and self.lines and self.lines[-1]:
                    self.lines.append("")
                self.gap = 0
                prefix = "".join(p[0] for p in self.prefixes)
                for p in self.prefixes:
                    p[0] = p[1]
                line = prefix + line
            if line or self.lines:
                self.lines.append(line.rstrip())

    def block(self, margin: int) -> None:
        self.end()
        self.gap = max(self.gap, margin)

    def done(self) -> list[str]:
        self.end()
        while self.lines and not self.lines[-1]:
            self.lines.pop()
        return self.lines


def aligned(rows: list[list[list[str]]], widest: int = PAD_WIDTH) -> list[str]:
    """Rows of cells of lines, as lines with columns padded to one width."""
    widths: list[int] = []
    for row in rows:
        for k, cell in enumerate(row):
            size = max((len(x) for x in cell if len(x) <= widest), default=0)
            widths[k:] = [max(widths[k], size), *widths[k + 1 :]] if k < len(widths) else [size]
    out = []
    for row in rows:
        for k in range(max(map(len, row), default=0)):
            parts = [cell[k] if k < len(cell) else "" for cell in row]
            if k or not any(parts):  # further lines end with their last text, not with separators
                parts = parts[: max((n + 1 for n, x in enumerate(parts) if x), default=0)]
            out.append(" | ".join(x.ljust(w) for x, w in zip(parts, widths)).rstrip())
    return [x for x in out if x]


def render(root: Node) -> str:
    """The visible text of a tree."""
    out = Lines()
    buffers: list[Lines] = []
    tables: list[list[list[list[str]]]] = []
    counts: list[int | None] = []
    pre = 0
    walk: list[tuple] = [(root, False)]
    while walk:
        node, leave = walk.pop()
        if isinstance(node, str):
            out.text(node, pre > 0)
            continue
        tag = node.tag
        if leave:
            if tag in ("td", "th") and tables:
                cell = out.done()
                out = buffers.pop()
                if not tables[-1]:
                    tables[-1].append([])
                span = node.attrs.get("colspan", "1")
                tables[-1][-1] += [cell, *([[]] * (min(int(span), 100) - 1 if span.isdigit() and int(span) else 0))]
            elif tag == "table":
                rows = aligned(tables.pop())
                out.block(1)
                for line in rows:
                    out.now.append(line)
                    out.end()
                out.gap = 1
            elif tag in MARGIN:
                out.block(0 if tag in ("ul", "ol") and len(counts) > 1 else MARGIN[tag])
            if tag in ("ul", "ol", "menu"):
                counts.pop()
            elif tag in ("li", "dd", "blockquote"):
                out.prefixes.pop()
            elif tag in ("pre", "listing", "xmp"):
                pre -= 1
            continue
        if tag and not visible(node):
            continue
        if tag == "br":
            out.end(True)
            continue
        if tag == "hr":
            out.block(1)
            continue
        if tag == "img" and node.attrs.get("alt"):
            out.text(node.attrs["alt"], False)
            continue
        if tag == "input" and node.attrs.get("type", "").lower() in ("submit", "button", "reset"):
            out.text(f" {node.attrs.get('value', '')} ", False)
            continue
        if tag in ("td", "th") and tables:
            buffers.append(out)
            out = Lines()
        elif tag in ("td", "th", "mtd"):
            out.text(" ", False)
        elif tag == "tr" and tables:
            tables[-1].append([])
        elif tag == "table":
            out.block(1)
            tables.append([])
        elif tag in MARGIN:
            out.block(0 if tag in ("ul", "ol") and counts else MARGIN[tag])
        if tag in ("ul", "ol", "menu"):
            start = node.attrs.get("start", "1")
            counts.append((int(start) if re.fullmatch(r"-?[0-9]{1,9}", start) else 1) if tag == "ol" else None)
        elif tag == "li":
            if counts and counts[-1] is not None:
                value = node.attrs.get("value", "")
                number = int(value) if re.fullmatch(r"-?[0-9]{1,9}", value) else counts[-1]
                counts[-1] = number + 1
                mark = f"{number}. "
            else:
                mark = "- "
            out.prefixes.append([mark, " " * len(mark)])
        elif tag == "dd":
            out.prefixes.append(["    ", "    "])
        elif tag == "blockquote":
            out.prefixes.append(["> ", "> "])
        elif tag in ("pre", "listing", "xmp"):
            pre += 1
        walk.append((node, True))
        walk += [(c, False) for c in reversed(node.children)]
    return "\n".join(out.done())


def text_of(html: str | None) -> str | None:
    return None if html is None else render(build(html))


def extracted(pages: DataFrame, id_column: str = "page_id", html_column: str = "html") -> DataFrame:
    """Per page: page_id and text, the visible text.

    Null pages have null text, empty pages and pages without visible text have an empty
    one. Repeated rows and rows without id are pages of their own; an empty table gives no
    rows; other columns are ignored.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                b = whole.slice(at, 512)
                texts = [text_of(h.as_py()) for h in b.column(1)]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=["page_id", "text"])

    slim = pages.select(F.col(id_column).cast("long").alias("page_id"), F.col(html_column).alias("html"))
    return slim.mapInArrow(scan, "page_id long, text string")
