"""HTML extraction: a tree builder with implied tags, visibility rules and a block layout.

Per page: the standard library's tokenizer feeds a tree builder (void elements,
implied end tags of p, li, dt/dd, option, table parts; stray end tags are ignored),
hidden subtrees are left out, and the tree is laid out as text: blank lines around
paragraphs and headings, list markers with indents, table columns padded to one
width, ``pre`` as it stands, all other white space collapsed. All visible text comes
out, navigation and advertisements included: what to keep is another operator's work.

Visibility: head, script, style and the like; ``hidden``; inline ``display:none`` and
``visibility:hidden``; the same in the page's style sheets for single tag, class and
id selectors, outside at-rules other than ``@media`` all or screen; closed details and dialogs. Trees are walked without recursion, so
nesting depth is not limited, and each page is one row of a split: no shuffle.

Defined results: null and empty html give empty text and title null. Broken markup is
repaired, never refused. Repeated rows, null ids and other columns need no care.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweave.llm.common import map_arrow

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset("head script style template noscript iframe object audio video canvas datalist title colgroup".split())
#: Margins in line ends: 2 leave a blank line.
BLOCKS = dict.fromkeys("p h1 h2 h3 h4 h5 h6 blockquote pre table ul ol dl figure fieldset hr details form".split(), 2) | dict.fromkeys(
    "div section article aside header footer nav main address li dt dd tr caption figcaption legend summary body html thead tbody tfoot option dialog center menu".split(), 1
)
CLOSES_P = frozenset(BLOCKS) - frozenset("body html li dt dd tr caption legend summary thead tbody tfoot option".split())
#: An opening tag ends these open elements, up to the nearest element of the second set.
IMPLIED = {
    "li": ({"li", "p"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd", "p"}, {"dl"}), "dd": ({"dt", "dd", "p"}, {"dl"}),
    "td": ({"td", "th", "p"}, {"tr", "table"}), "th": ({"td", "th", "p"}, {"tr", "table"}), "tr": ({"tr", "td", "th", "p"}, {"table"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}), "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}), "option": ({"option"}, {"select", "optgroup"}), "body": ({"head", "title"}, {"html"}),
}
SCOPE = frozenset("table td th caption body html".split())  # an end tag of another element does not close these
PAD_WIDTH = 40  # table columns up to this width are padded; wider ones are not, so a page cannot grow
MAX_SPAN = 1000
BLANKS = re.compile(r"[ \t\n\r\f]+")
CSS_TOKEN = re.compile(r""""(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*'|[{};]|[^{};"']+|.""", re.S)
#: Inside svg and math, no browser shows the text of these.
UNSEEN_FOREIGN = frozenset("desc metadata defs symbol clippath mask pattern marker annotation annotation-xml".split())
CONCEALS = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse))\s*(?:!important\s*)?(?:;|$)", re.I)


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict):
        self.tag, self.attrs, self.children = tag, attrs, []


class TreeBuilder(HTMLParser):
    """Builds ``root``; ``styles`` and ``title`` are the texts of these elements."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("html", {})
        self.open = [self.root]
        self.styles: list[str] = []
        self.title: str | None = None

    def _close_to(self, i: int) -> None:
        del self.open[max(i, 1) :]

    def handle_starttag(self, tag, attrs):
        if tag == "html":
            self.root.attrs |= dict(attrs)
            return
        if tag in IMPLIED:
            ends, within = IMPLIED[tag]
            self._imply(ends, within)
        elif tag in CLOSES_P:
            self._imply({"p"}, SCOPE | {"ul", "ol", "dl", "li", "dd"})
        node = Node(tag, dict(attrs))
        if (tag in UNSEEN_FOREIGN or tag == "text") and any(x.tag in ("svg", "math") for x in self.open):
            if tag == "text":  # placed apart from other text
                self.open[-1].children.append(" ")
            else:
                node.attrs["hidden"] = ""
        self.open[-1].children.append(node)
        if tag not in VOID:
            self.open.append(node)

    def _imply(self, ends, within) -> None:
        cut = len(self.open)
        for i in range(len(self.open) - 1, 0, -1):
            tag = self.open[i].tag
            if tag in within:
                break
            if tag in ends:
                cut = i
        self._close_to(cut)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)  # "/>" ends nothing in HTML

    def handle_endtag(self, tag):
        if tag in VOID:
            if tag == "br":
                self.handle_starttag(tag, [])
            return
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                return self._close_to(i)
            if self.open[i].tag in SCOPE and tag not in ("table", "tr", "thead", "tbody", "tfoot", "body", "html"):
                return None
        return None

    def handle_data(self, data):
        tag = self.open[-1].tag
        if tag == "style":
            self.styles.append(data)
        elif tag == "title" and self.title is None:
            self.title = BLANKS.sub(" ", data).strip()
        self.open[-1].children.append(data)


def plain_rules(sheet: str) -> list[tuple[str, str]]:
    """Selectors and declarations of the rules that hold on every screen: none inside other at-rules or rules."""
    out, text = [], ""
    blocks: list[list] = []  # open blocks: selectors ("" for @media all or screen, None if it may not hold), declarations
    for token in CSS_TOKEN.findall(re.sub(r"/\*.*?\*/", "", sheet, flags=re.S)):
        if token == "{":
            head = text.strip()
            if head.startswith("@"):
                media = [" ".join(x.lower().split()) for x in head[6:].split(",")] if head[:6].lower() == "@media" else []
                head = "" if {"", "all", "screen", "only all", "only screen"} & set(media) else None
            blocks.append([head if all(x == "" for x, _ in blocks) else None, ""])
            text = ""
        elif token == "}":
            if blocks:
                selectors, rule = blocks.pop()
                if selectors:
                    out.append((selectors, rule + text))
            text = ""
        elif token == ";":
            if blocks:
                blocks[-1][1] += text + ";"
            text = ""
        else:
            text += token
    return out


def concealed_selectors(styles: list[str]) -> frozenset[str]:
    """Single tag, class and id selectors whose rule conceals on every screen."""
    out = set()
    for sheet in styles:
        for selectors, rule in plain_rules(sheet):
            if CONCEALS.search(rule):
                out |= {s.strip() for s in selectors.split(",") if re.fullmatch(r"[.#]?[\w-]+", s.strip())}
    return frozenset(out)


def visible(node: Node, concealed: frozenset[str]) -> bool:
    a = node.attrs
    if node.tag in UNSEEN or "hidden" in a or (node.tag == "dialog" and "open" not in a) or CONCEALS.search(a.get("style") or ""):
        return False
    if not concealed:
        return True
    names = {node.tag, "#" + (a.get("id") or "")} | {"." + c for c in (a.get("class") or "").split()}
    return not names & concealed


class Marker:
    """A list item's indent: its marker before the first line, then as many blanks."""

    def __init__(self, mark: str):
        self.mark = mark

    def __str__(self) -> str:
        self.mark, before = " " * len(self.mark), self.mark
        return before


class Layout:
    """Text lines with pending margins; ``indent`` stands before every new line."""

    def __init__(self):
        self.out: list[str] = []
        self.breaks = 0  # line ends that are due before the next text
        self.space = False
        self.indent: list = []

    def margin(self, n: int) -> None:
        self.breaks = max(self.breaks, n)
        self.space = False

    def _begin(self) -> None:
        fresh = not self.out
        if self.breaks and not fresh:
            self.out.append("\n" * self.breaks)
        if self.breaks or fresh:
            self.out += map(str, self.indent)
        self.breaks = 0

    def text(self, data: str) -> None:
        words = BLANKS.sub(" ", data)
        if words in ("", " "):
            self.space = self.space or bool(words)
            return
        space = (self.space or words[0] == " ") and not self.breaks and bool(self.out)
        self._begin()
        self.out.append((" " if space else "") + words.strip(" "))
        self.space = words[-1] == " "

    def line_break(self) -> None:
        if self.out and not self.breaks:
            self.breaks = 1
        elif self.out:
            self.breaks = min(self.breaks + 1, 2)
        self.space = False

    def raw(self, block: str) -> None:
        """Lines as they stand."""
        lines = block.split("\n")
        self._begin()
        self.out.append(("\n" + "".join(map(str, self.indent))).join(lines))
        self.space = False

    def result(self) -> str:
        return "".join(self.out).strip("\n")


def _pre_text(node: Node, concealed: frozenset[str]) -> str:
    out, todo = [], [node]
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            out.append(x)
        elif x.tag == "br":
            out.append("\n")
        elif x is node or visible(x, concealed):
            todo += reversed(x.children)
    return "".join(out).strip("\n").replace("\r", "")


def _span(value: str | None) -> int:
    return min(int(value), MAX_SPAN) if value and value.isascii() and value.isdigit() and int(value) else 1


def _table_rows(table: Node, concealed: frozenset[str]) -> tuple[list[Node], list[list[Node]]]:
    """Captions and other loose content, and the visible cells of each row."""
    loose, rows, todo = [], [], list(reversed(table.children))
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            if x.strip():
                loose.append(x)
        elif not visible(x, concealed):
            continue
        elif x.tag in ("thead", "tbody", "tfoot"):
            todo += reversed(x.children)
        elif x.tag == "tr":
            rows.append([c for c in x.children if isinstance(c, str) and c.strip() or isinstance(c, Node) and visible(c, concealed)])
        elif x.tag in ("td", "th"):
            rows.append([x])
        else:
            loose.append(x)
    return loose, rows


def table_lines(rows: list[list[tuple[str, int, int]]]) -> str:
    """Cells (text, columns, rows) as lines with columns of one width."""
    grid: list[list[str]] = []
    held: dict[int, int] = {}  # column -> rows that a cell from above still covers
    for row in rows:
        line: list[str] = []

        def skip() -> None:
            while held.get(len(line), 0):
                held[len(line)] -= 1
                line.append("")

        for text, columns, down in row:
            skip()
            for i in range(columns):
                if down > 1:
                    held[len(line)] = down - 1
                line.append("" if i else text)
        skip()
        grid.append(line)
    widths: dict[int, int] = {}
    for line in grid:
        for c, text in enumerate(line):
            if len(text) <= PAD_WIDTH:
                widths[c] = max(widths.get(c, 0), len(text))
    return "\n".join("  ".join(t.ljust(widths.get(c, 0)) for c, t in enumerate(line)).rstrip() for line in grid)


def render(root: Node, concealed: frozenset[str]) -> str:
    """The visible text of a tree. ``todo`` holds nodes to enter and steps to take when one ends."""
    top = Layout()
    todo: list = [(root, top)]
    while todo:
        x, page = todo.pop()
        if callable(x):
            x()
            continue
        if isinstance(x, str):
            page.text(x)
            continue
        tag = x.tag
        if tag == "br":
            page.line_break()
            continue
        if not visible(x, concealed):
            continue
        margin = BLOCKS.get(tag, 0)
        if margin:
            page.margin(1 if page.indent and tag in ("ul", "ol", "menu", "p") else margin)
        if tag == "hr":
            page.raw("----")
        elif tag == "img":
            if x.attrs.get("alt"):
                page.text(x.attrs["alt"])
        elif tag == "pre":
            block = _pre_text(x, concealed)
            if block:
                page.raw(block)
        elif tag == "table":
            _enter_table(x, page, todo, concealed, margin)
            continue
        else:
            _enter(x, page, todo, margin)
            continue
        if margin:
            page.margin(margin)
    return top.result()


def _enter(x: Node, page: Layout, todo: list, margin: int) -> None:
    children = x.children
    if x.tag == "details" and "open" not in x.attrs:
        children = [c for c in children if isinstance(c, Node) and c.tag == "summary"][:1]
    steps: list = []
    if x.tag in ("ul", "ol", "menu"):
        number = int(x.attrs["start"]) if (x.attrs.get("start") or "").isdecimal() and x.attrs["start"].isascii() else 1
        for c in children:
            if isinstance(c, Node) and c.tag == "li":
                if x.tag == "ol" and (c.attrs.get("value") or "").isdecimal() and c.attrs["value"].isascii():
                    number = int(c.attrs["value"])
                mark = f"{number}. " if x.tag == "ol" else "- "
                number += 1

                def begin(mark=mark):
                    page.margin(1)
                    page.indent.append(Marker(mark))

                steps += [(begin, page), (c, page), (page.indent.pop, page)]
            else:
                steps.append((c, page))
    elif x.tag == "blockquote" or x.tag == "dd":
        steps = [(lambda: page.indent.append("  "), page), *((c, page) for c in children), (page.indent.pop, page)]
    else:
        steps = [(c, page) for c in children]
    if margin:
        after = 1 if page.indent and x.tag in ("ul", "ol", "menu", "p") else margin
        steps.append((lambda: page.margin(after), page))
    todo += reversed(steps)


def _enter_table(x: Node, page: Layout, todo: list, concealed: frozenset[str], margin: int) -> None:
    loose, rows = _table_rows(x, concealed)
    cells: list[list[tuple[Layout, int, int]]] = []
    steps: list = [(c, page) for c in loose]
    for row in rows:
        line = []
        for c in row:
            inner = Layout()
            if isinstance(c, str):
                line.append((inner, 1, 1))
                steps.append((c, inner))
            else:
                line.append((inner, _span(c.attrs.get("colspan")), _span(c.attrs.get("rowspan"))))
                steps += [(k, inner) for k in c.children]
        cells.append(line)

    def finish():
        lines = table_lines([[(BLANKS.sub(" ", inner.result()).strip(), columns, down) for inner, columns, down in row] for row in cells])
        if lines.strip():
            page.margin(1)
            page.raw(lines)
        page.margin(margin)

    steps.append((finish, page))
    todo += reversed(steps)


def page_text(html: str | None) -> tuple[str | None, str]:
    """Title and visible text of a page."""
    if not html:
        return None, ""
    builder = TreeBuilder()
    builder.feed(html)
    builder.close()
    return builder.title, render(builder.root, concealed_selectors(builder.styles))


def _extract(batches):
    for batch in batches:
        for lo in range(0, batch.num_rows, 500):
            pages = [page_text(h.as_py()) for h in batch.column(1).slice(lo, 500)]
            yield pa.record_batch([batch.column(0).slice(lo, 500), pa.array([t for t, _ in pages], pa.string()), pa.array([t for _, t in pages], pa.string())], names=["page_id", "title", "text"])


def visible_text(pages: DataFrame) -> DataFrame:
    """Per row of ``pages`` (page_id, html): page_id, title, text."""
    return map_arrow(pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("html").cast("string").alias("html")), _extract, "page_id long, title string, text string")
