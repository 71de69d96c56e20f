"""Layout-aware rendering of HTML: all visible text, laid out as text.

A small tree builder reads tags and text, supplies the tags that HTML lets
authors leave out (paragraphs, list items, table rows and cells, head) and
drops what never shows (scripts, styles, head, comments, ``hidden``,
``display:none``, ``visibility:hidden``, closed details, fallback content).
The renderer walks the tree with a stack of its own, so depth is no limit:
white space collapses except in ``pre``, blocks start on their own line,
paragraphs and headings are set off by an empty line, list items carry a mark
or a number and their depth, and the cells of a table are set in columns
(colspan and rowspan included; columns wider than ``WIDEST`` aren't padded).
A table whose grid has more than ``GRID`` places to a line of text in its
cells, and ``GRID_FREE`` besides, or more than ``MOST_SPANS`` spans above a
row, isn't set in columns: its cells follow each other (those of a row with
a cell of several lines each on lines of their own).  So the output grows
with the text whatever the spans say, and no text is left out.

Style sheets are not applied, only style attributes.  Defined results: null
and empty pages render to an empty text; unclosed tags, quotes and comments
end with the page, as in browsers; rows are rendered one by one; an empty
table gives an empty result.
"""

from __future__ import annotations

import html
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from propval.llm import textbytes as tb

WIDEST = 60              # characters to which cells are padded
DEEPEST = 32             # lists whose depth shows
GRID, GRID_FREE = 16, 200    # places of a table's grid to a line of text in its cells, and places besides
MOST_SPANS = 1000        # cells that reach into one row from above
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp".split())
HIDDEN = frozenset("head script style title noscript template iframe noembed noframes datalist audio video canvas object".split())
IN_HEAD = frozenset("base basefont bgsound link meta title style script noscript template noframes".split())
PARAGRAPHS = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre table ul ol dl figure hr".split())
BLOCKS = PARAGRAPHS | frozenset("address article aside body caption center dd details dialog dir div dt fieldset figcaption footer form header hgroup "
                                "html legend li main menu nav optgroup option search section select summary tbody td tfoot th thead tr textarea".split())
CLOSES_P = BLOCKS - frozenset("body html li dd dt caption legend optgroup option select tbody td tfoot th thead tr textarea".split()) | {"li", "dd", "dt"}
#: An open element that a start tag ends, and how far up it is looked for.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu", "dir", "td", "th", "table"}), "dt": ({"dt", "dd"}, {"dl", "td", "th", "table"}),
        "dd": ({"dt", "dd"}, {"dl", "td", "th", "table"}), "option": ({"option"}, {"select", "datalist"}),
        "optgroup": ({"option", "optgroup"}, {"select", "datalist"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
        "tr": ({"td", "th", "tr", "caption"}, {"table", "thead", "tbody", "tfoot"}),
        "tbody": ({"td", "th", "tr", "thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"})}
ENDS["thead"] = ENDS["tfoot"] = ENDS["tbody"]
SCOPE = frozenset("table td th caption button html template".split())

_TAG = re.compile(r"<!--|<(?=[!?])|</([a-zA-Z][^\s/>]*)|<([a-zA-Z][^\s/>]*)")
_ATTRS = re.compile(r"""(?:[^>"']+|"[^"]*"|'[^']*')*+""")
_ATTR = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_SPACE = re.compile(r"[ \t\n\r\f]+")
_STYLE = re.compile(r"(display|visibility)\s*:\s*(\w+)", re.I)


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.children = tag, attrs, []


def _attributes(source: str) -> dict[str, str]:
    if not source.strip(" \n\t\r\f/"):
        return {}
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in reversed(list(_ATTR.finditer(source)))}


class _Builder:
    def __init__(self):
        self.root = Node("html", {})
        self.open = [self.root]
        self.count: Counter[str] = Counter()                  # of open elements

    def text(self, s: str) -> None:
        if s.strip():
            self.leave_head()
        self.open[-1].children.append(s)

    def close(self, tags, stop) -> None:
        """Ends the lowest open element of tags, looked for up to stop; what it holds ends with it."""
        if not any(self.count[t] for t in tags):
            return
        for i in range(len(self.open) - 1, 0, -1):
            tag = self.open[i].tag
            if tag in tags:
                self.count.subtract(x.tag for x in self.open[i:])
                del self.open[i:]
                return
            if tag in stop:
                return

    def start(self, tag: str, attrs: dict[str, str]) -> None:
        if tag == "html":
            return
        if tag not in IN_HEAD:
            self.leave_head()
        if tag in CLOSES_P:
            self.close({"p"}, SCOPE)
        if tag in ENDS:
            tags, stop = ENDS[tag]
            for _ in range(4):                                # a row ends its cell and the row before
                n = len(self.open)
                self.close(tags, stop)
                if len(self.open) == n:
                    break
        if tag in ("td", "th") and self.open[-1].tag in ("table", "thead", "tbody", "tfoot"):
            self.start("tr", {})
        node = Node(tag, attrs)
        self.open[-1].children.append(node)
        if tag not in VOID:
            self.open.append(node)
            self.count[tag] += 1

    def leave_head(self) -> None:
        if self.open[-1].tag == "head":
            self.count["head"] -= 1
            self.open.pop()

    def end(self, tag: str) -> None:
        if tag == "br":
            self.start("br", {})
        elif tag not in ("html", "body"):
            self.close({tag}, () if tag in ("table", "td", "th", "tr", "thead", "tbody", "tfoot", "caption") else SCOPE - {tag})


def parse(page: str) -> Node:
    """The tree of a page."""
    b, at, n = _Builder(), 0, len(page)
    while at < n:
        m = _TAG.search(page, at)
        if m is None:
            b.text(html.unescape(page[at:]))
            break
        if m.start() > at:
            s = page[at:m.start()]
            b.text(html.unescape(s) if "&" in s else s)
        if m[0] == "<!--":
            to = page.find("-->", m.end())
            at = n if to < 0 else to + 3
            continue
        if m[1] is None and m[2] is None:                     # doctype and the like
            to = page.find(">", m.end())
            at = n if to < 0 else to + 1
            continue
        a = _ATTRS.match(page, m.end())
        at = a.end()
        if at >= n or page[at] != ">":                        # the page ends inside the tag
            break
        at += 1
        if m[1] is not None:
            b.end(m[1].lower())
            continue
        tag = m[2].lower()
        b.start(tag, _attributes(a[0]))
        if tag in RAW:
            to = re.compile("</" + tag + r"(?=[\s/>])", re.I).search(page, at)
            s = page[at:to.start() if to else n]
            if tag in ("textarea", "title"):
                s = html.unescape(s)
            b.open[-1].children.append(s)
            at = to.start() if to else n
    return b.root


class _Page:
    """Lines that grow; a line is closed before a gap of 1 or 2 line ends."""

    def __init__(self):
        self.lines, self.line, self.gap, self.marks, self.tables, self.spaced = [], [], 0, [], [], False

    def text(self, s: str) -> None:
        s = _SPACE.sub(" ", s)
        if s[:1] == " " and (not self.line or self.line[-1][-1:] == " "):
            s = s[1:]
        if s:
            self.line.append(s)

    def pre(self, s: str) -> None:
        first, *rest = s.replace("\r\n", "\n").split("\n")
        if first:
            self.line.append(first)
        for x in rest:
            self.spaced = True
            self.end_line(empty=True)
            if x:
                self.line.append(x)
        self.spaced = bool(self.line)

    def end_line(self, empty: bool = False) -> None:
        s = "".join(self.line)
        s = s.rstrip(" ") if self.spaced else s.strip(" ")
        self.line, self.spaced = [], False
        if s or empty and self.lines:
            if self.lines and self.gap > 1:
                self.lines.append("")
            lead = "".join(m.pop("first", " " * m["width"]) for m in self.marks[-DEEPEST:])
            self.lines.append((lead + s).rstrip(" "))
            self.gap = 1

    def space(self, n: int) -> None:
        self.end_line()
        if self.lines:
            self.gap = max(self.gap, n)

    def block(self, lines: list[str]) -> None:
        for x in lines:
            self.line, self.spaced = [x], True
            self.end_line(empty=True)

    def done(self) -> list[str]:
        self.end_line()
        return self.lines


class _Table:
    """Cells by column.  Spans are intervals of columns, and a row's next free
    column only grows, so a cell costs no scan of its row."""

    def __init__(self):
        self.rows, self.reach, self.spans, self.fresh, self.loose, self.free, self.at = [], [], [], [], False, 0, 0

    def row(self) -> None:
        self.rows.append({})
        self.reach.append(0)
        left = [(a, b, n - 1) for a, b, n in self.spans + self.fresh if n > 1]
        self.spans, self.fresh, self.free, self.at = sorted(left) if self.fresh else left, [], 0, 0
        if len(self.spans) > MOST_SPANS:
            self.loose, self.spans = True, []

    def cell(self, lines: list[str], colspan: int, rowspan: int) -> None:
        if not self.rows:
            self.row()
        c = self.free
        while self.at < len(self.spans) and self.spans[self.at][0] <= c:
            c = max(c, self.spans[self.at][1])
            self.at += 1
        self.rows[-1][c] = lines
        self.free = self.reach[-1] = c + colspan
        if rowspan > 1 and not self.loose:
            self.fresh.append((c, c + colspan, rowspan))

    def lines(self) -> list[str]:
        heights = [max(1, *map(len, row.values())) if row else 0 for row in self.rows]
        held = sum(max(1, len(x)) for row in self.rows for x in row.values())
        if self.loose or sum(w * h for w, h in zip(self.reach, heights, strict=True)) > GRID * held + GRID_FREE:
            out = []
            for row, height in zip(self.rows, heights, strict=True):
                cells = row.values()
                out += [" | ".join(x[0] if x else "" for x in cells).rstrip(" ")] * (height > 0) if height < 2 else [s for x in cells for s in x]
            return out
        width: dict[int, int] = {}
        for row in self.rows:
            for c, lines in row.items():
                w = max(map(len, lines), default=0)
                width[c] = max(width.get(c, 0), min(w, WIDEST))
        out = []
        for row, reach, height in zip(self.rows, self.reach, heights, strict=True):
            for k in range(height):
                cells = [(row.get(c) or [])[k:k + 1] or [""] for c in range(reach)]
                out.append(" | ".join(x[0].ljust(width.get(c, 0)) for c, x in enumerate(cells)).rstrip(" "))
        return out


def _span(node: Node, name: str, most: int) -> int:
    s = node.attrs.get(name, "")
    return min(most, max(1, int(s))) if s.isdecimal() and len(s) < 6 else 1


def _shows(node: Node, parent_tag: str, parent_open: bool, visible: bool) -> tuple[bool, bool]:
    """Whether the element is laid out, and whether its own text is visible."""
    a = node.attrs
    if node.tag in HIDDEN or "hidden" in a or node.tag == "dialog" and "open" not in a or parent_tag == "details" and not parent_open and node.tag != "summary":
        return False, False
    style = {k.lower(): v.lower() for k, v in _STYLE.findall(a["style"])} if "style" in a else {}
    if style.get("display") == "none":
        return False, False
    if "visibility" in style:
        visible = style["visibility"] not in ("hidden", "collapse")
    return True, visible


def render(page: str | None) -> tuple[str, int, int]:
    """(text, list items, table cells) of a page."""
    pages, n_items, n_cells = [_Page()], 0, 0
    root = parse(page or "")
    stack = [(root, iter(root.children), True, 0)]            # element, children, visible, pre depth
    while stack:
        node, children, visible, pre = stack[-1]
        child, out = next(children, None), pages[-1]
        if child is None:
            stack.pop()
            tag = node.tag
            if tag in ("td", "th") and out.tables and out.tables[-1] == "cell":
                lines = pages.pop().done()
                table = pages[-1].tables[-1]
                table.cell(lines, _span(node, "colspan", 1000), _span(node, "rowspan", 65534))
                n_cells += 1
            elif tag == "table":
                table = out.tables.pop()
                out.end_line()
                out.block(table.lines())
            if tag == "li" and out.marks:
                out.end_line()
                out.marks.pop()
            if tag in BLOCKS and tag not in ("td", "th"):
                nested = tag in ("ul", "ol") and out.marks
                out.space(2 if tag in PARAGRAPHS and not nested else 1)
            continue
        if isinstance(child, str):
            closed = node.tag == "details" and "open" not in node.attrs
            if visible and not closed:
                if pre:
                    out.pre(child)
                elif not (node.tag in ("table", "tr", "tbody", "thead", "tfoot", "ul", "ol") and not child.strip()):
                    out.text(child)
            continue
        shown, sees = _shows(child, node.tag, "open" in node.attrs, visible)
        if not shown:
            continue
        tag = child.tag
        if tag == "br":
            out.end_line(empty=True)
            continue
        if tag == "wbr" or tag in VOID - {"hr"}:
            continue
        if tag in BLOCKS and tag not in ("td", "th"):
            nested = tag in ("ul", "ol") and out.marks
            out.space(2 if tag in PARAGRAPHS and not nested else 1)
        if tag == "hr":
            out.block(["---"])
            out.space(2)
            continue
        if tag == "li":
            n_items += 1
            mark = "- "
            if node.tag == "ol":
                start = node.attrs.get("start", "1")
                number = int(node.attrs.get("next item", start if start.isdecimal() and len(start) < 10 else 1))
                node.attrs["next item"] = number + 1
                mark = f"{number}. "
            out.marks.append({"width": len(mark), "first": mark})
        elif tag == "table":
            out.tables.append(_Table())
        elif tag == "tr" and out.tables and isinstance(out.tables[-1], _Table):
            out.tables[-1].row()
        elif tag in ("td", "th") and out.tables and isinstance(out.tables[-1], _Table):
            pages.append(_Page())
            pages[-1].tables.append("cell")
        stack.append((child, iter(child.children), sees, pre + (tag in ("pre", "textarea", "listing"))))
    return "\n".join(pages[0].done()), n_items, n_cells


FIELDS = [T.StructField("rendered", T.StringType())] + [T.StructField(n, T.LongType()) for n in ("n_chars", "n_lines", "n_items", "n_cells")]


def render_pages(df: DataFrame, column: str = "html") -> DataFrame:
    """df with rendered and counts (input columns of these names go)."""
    def of(pages):
        rows = [render(x) for x in pages.to_pylist()]
        text = [r[0] for r in rows]
        return [pa.array(text, pa.string()), pa.array([len(x) for x in text], pa.int64()), pa.array([x.count("\n") + 1 if x else 0 for x in text], pa.int64()),
                pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int64())]
    return tb.append_columns(df, column, FIELDS, of)
