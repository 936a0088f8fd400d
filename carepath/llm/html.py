"""Visible text of HTML pages with its layout: blocks, lists and aligned tables.

A tolerant tree builder reads tags, implies the ones that may be left out (an open ``p`` ends
before a block, ``li``, ``dt``/``dd``, ``option``, table parts end before their like, a cell
without a row gets one) and closes what is left open at the end, so truncated pages are read as
far as they go. Elements that a browser does not show are dropped with all they contain:
``head``, scripts, styles, templates, ``noscript``, ``hidden``, ``display:none``, inputs but for
the labels of buttons, what a closed ``details`` hides, annotations of ``math``, ``rp``. Text under
``visibility:hidden`` goes, but for children that are ``visible`` again; the last declaration of an
attribute counts, an important one before others. Of ``svg`` the ``text`` and ``foreignObject``
elements are text. The content of ``textarea`` is text as it stands. CDATA sections are text
everywhere. Style sheets are not applied: what only they hide is emitted.

The rest is laid out: white space collapses outside ``pre``; blocks begin on a new line,
paragraphs, headings, lists and tables after an empty one; list items get a dash or their number
and an indent per level; table cells, also spanning ones, stand under each other, columns padded
to at most PAD characters as far as LINE, two spaces apart beyond it. All text that is visible is emitted, navigation and footers too.

Cases: NULL stays NULL, an empty page gives an empty text. Stray ``<`` and end tags without a
start are text and nothing, respectively. Attribute values may be of any length. Elements deeper than DEPTH levels keep their text at
that level; tables deeper than TABLES levels are laid out as blocks. A cell spans SPANS columns at
most, as in the standard of HTML. Repeated pages get their row each; an empty table gives no rows, and
columns besides id and text are not read.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import query, table

PAD = 40
#: Cells are aligned as far as this; it bounds a line by its text.
LINE = 1_000
TABLES = 8
SPANS = 1_000
#: Elements that may be open at once; what opens deeper lies beside its parent.
DEPTH = 512

TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|$)|<[!?][^>]*(?:>|$)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)",
    re.S,
)
#: Name of an attribute, and whether a value follows.
NAME = re.compile(r"[\s/]*(=?[^\s/>=]*)\s*(?:(=)\s*)?")
VALUE = re.compile(r"[^\s>]*")
BLANK = re.compile(r"[ \t\n\r\f\v]+")
DECLARED = re.compile(r"(?:^|;)\s*(display|visibility)\s*:\s*([\w-]+)\s*(!\s*important)?", re.I)

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes".split())
#: Their content holds character references but no tags.
PLAIN = frozenset("textarea title".split())
UNSHOWN = frozenset(
    "head script style template noscript iframe noembed noframes object audio video canvas datalist "
    "title base link meta param source track area annotation annotation-xml rp".split()
)
#: Of svg: what is shown as text, and what is a definition.
DRAWN = frozenset("text foreignobject".split())
UNDRAWN = UNSHOWN | frozenset("desc metadata defs symbol clippath mask pattern marker".split())
LABELLED = frozenset("submit reset button".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl menu blockquote pre table figure hr fieldset".split())
BLOCKS = SPACED | frozenset(
    "html body address article aside center details dd dialog dir div dt figcaption footer form header hgroup li "
    "legend main nav optgroup option search section summary caption tbody thead tfoot tr td th xmp textarea select".split()
)
ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 "
    "h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul li dt dd".split()
)
#: A start tag ends these open elements, unless one of the second group stands between.
IMPLIED_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "table"}),
    "dt": ({"dt", "dd"}, {"dl", "table"}),
    "dd": ({"dt", "dd"}, {"dl", "table"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "tr": ({"tr", "td", "th", "caption"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "body": ({"head"}, set()),
}
IMPLIED_ENDS["thead"] = IMPLIED_ENDS["tfoot"] = IMPLIED_ENDS["tbody"]
#: An end tag does not reach beyond these, unless it is their own.
SCOPE = {"table", "td", "th", "caption", "html", "body"}
LISTS = {"ul", "ol", "menu", "dir"}


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs = tag, attrs
        self.children: list[Node | str] = []


def attributes(page: str, at: int, last: dict[str, int]) -> tuple[dict[str, str], int]:
    """Attributes of the tag whose name ends at at, and where the tag ends.

    A quote opens a value only after an equals sign; one that is never closed is passed over.
    last: the last place of each quote in the page, so that no search for it is in vain.
    """
    found: dict[str, str] = {}
    while at < len(page) and page[at] != ">":
        m = NAME.match(page, at)
        at, value = m.end(), ""
        if m[2]:
            quote = page[at : at + 1]
            if quote in ('"', "'") and at < last[quote]:
                stop = page.index(quote, at + 1)
                value, at = page[at + 1 : stop], stop + 1
            else:
                v = VALUE.match(page, at + (quote in ('"', "'")))
                value, at = v[0], v.end()
        name = m[1].strip("\"'").lower()
        if name:
            found.setdefault(name, entities.unescape(value))
    return found, at + 1


def parse(page: str) -> Node:
    root = Node("#root", {})
    stack = [root]
    at = 0
    last = {q: page.rfind(q) for q in ('"', "'")}

    def close(tags: set[str], barrier: set[str]) -> None:
        """End the outermost open element of tags above the innermost barrier."""
        found = None
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in tags:
                found = i
            elif stack[i].tag in barrier:
                break
        if found is not None:
            del stack[found:]

    def add(text: str) -> None:
        if text:
            stack[-1].children.append(entities.unescape(text))

    while True:
        m = TOKEN.search(page, at)
        if m is None:
            add(page[at:])
            return root
        add(page[at : m.start()])
        at = m.end()
        if m["cdata"]:
            stack[-1].children.append(m["cdata"])
        if not m["tag"]:
            continue
        tag = m["tag"].lower()
        attrs, at = attributes(page, at, last)
        if m["end"]:
            barrier = SCOPE - {tag} if tag not in ("html", "body", "table") else set()
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    if tag not in ("html", "body"):  # what follows them still belongs to the page
                        del stack[i:]
                    break
                if stack[i].tag in barrier:
                    break
            continue
        if tag in ENDS_P:
            close({"p"}, SCOPE | {"button", "object"})
        if tag in IMPLIED_ENDS:
            close(*IMPLIED_ENDS[tag])
        if tag in ("td", "th") and stack[-1].tag in ("table", "tbody", "thead", "tfoot"):
            row = Node("tr", {})
            stack[-1].children.append(row)
            stack.append(row)
        node = Node(tag, attrs)
        stack[-1].children.append(node)
        closed = page[at - 2 : at] == "/>" and any(n.tag in ("svg", "math") for n in stack)
        if closed or tag in VOID:
            continue
        if tag in RAW or tag in PLAIN:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I).search(page, at)
            text = page[at : end.start() if end else len(page)]
            node.children.append(text if tag in RAW else entities.unescape(text))
            at = end.end() if end else len(page)
        elif len(stack) <= DEPTH:
            stack.append(node)


def declared(style: str) -> dict[str, str]:
    """display and visibility of a style attribute."""
    out: dict[str, str] = {}
    firm = set()
    for name, value, important in DECLARED.findall(style):
        name = name.lower()
        if important or name not in firm:
            out[name] = value.lower()
        if important:
            firm.add(name)
    return out


def visible_in(node: Node, inherited: bool) -> bool:
    """Whether text directly in the node is visible, by its own word or that of its parents."""
    own = declared(node.attrs["style"]).get("visibility") if "style" in node.attrs else None
    return own == "visible" if own in ("visible", "hidden", "collapse") else inherited


def drawn(svg: Node) -> list[Node | str]:
    """The texts of a drawing, apart from each other."""
    out: list[Node | str] = [" "]
    todo = [svg]
    while todo:
        node = todo.pop()
        if node.tag in DRAWN:
            out += [node, " "]
        elif node.tag not in UNDRAWN and (node is svg or shown(node)):
            todo += [c for c in reversed(node.children) if isinstance(c, Node)]
    return out


def shown(node: Node) -> bool:
    a = node.attrs
    return not (
        node.tag in UNSHOWN
        or a
        and ("hidden" in a or "style" in a and declared(a["style"]).get("display") == "none")
        or node.tag == "input"
        and a.get("type", "").strip().lower() not in LABELLED
    )


class Page:
    """Lines under construction."""

    def __init__(self):
        self.lines: list[str] = []
        self.now: list[str] = []
        self.space = False
        self.gap = 0  # empty lines wanted before the next text
        self.indents: list[str] = []
        self.marker = ""

    def text(self, words: str) -> None:
        """Collapsed inline text."""
        parts = BLANK.split(words)
        if not self.now:
            self.space = False
        for k, word in enumerate(parts):
            if k:
                self.space = True
            if word:
                self.put((" " if self.space and self.now else "") + word)
                self.space = False

    def put(self, words: str) -> None:
        if not self.now:
            if self.lines:
                self.lines += [""] * self.gap
            self.gap = 0
            indent = "".join(self.indents)
            if self.marker:
                indent = indent[: len(indent) - len(self.marker)] + self.marker
                self.marker = ""
            self.now.append(indent)
        self.now.append(words)

    def line(self, gap: int = 0) -> None:
        """End the line; at least gap empty lines follow before more text."""
        if self.now:
            self.lines.append("".join(self.now).rstrip(" "))
            self.now, self.gap = [], 0
        self.space = False
        self.gap = max(self.gap, gap)

    def raw_line(self, words: str) -> None:
        if words.strip():
            self.put(words)
        self.line()


def number(text: str | None, default: int, most: int) -> int:
    return min(max(int(text), 0), most) if text and text.strip().isdigit() and len(text) < 10 else default


def render(root: Node, level: int = 0, visible: bool = True) -> list[str]:
    page = Page()
    # (node, first child to do, kept state); an explicit stack, as pages nest as they please.
    todo: list[tuple] = [("open", root)]
    lists: list[int | None] = []
    pre = 0
    seen = [visible]  # visibility, which children inherit until they say otherwise
    while todo:
        what, item = todo.pop()
        if what == "seen":
            seen.pop()
            continue
        if what == "close":
            tag = item.tag
            if tag in LISTS:
                lists.pop()
            if tag in ("li", "dd", "blockquote") and page.indents:
                page.line()
                page.marker = ""
                page.indents.pop()
            if tag in ("pre", "textarea"):
                pre -= 1
            if tag in BLOCKS:
                page.line(1 if gap_of(tag, lists) else 0)
            continue
        if isinstance(item, str):
            if not seen[-1]:
                continue
            if pre:
                first, *more = item.expandtabs(8).replace("\r\n", "\n").split("\n")
                if first:
                    page.put(first)
                for x in more:
                    if not page.now:
                        page.gap += bool(page.lines)
                    page.line()
                    if x:
                        page.put(x)
            else:
                page.text(item)
            continue
        if not shown(item):
            continue
        tag = item.tag
        if tag == "br":
            if page.now:
                page.line()
            else:
                page.gap += 1
            continue
        if tag == "wbr" or tag == "img":
            continue
        if tag == "input":
            if seen[-1]:
                page.text(f" {item.attrs.get('value', '')} ")
            continue
        if tag in BLOCKS:
            page.line(1 if gap_of(tag, lists) else 0)
        if tag == "hr":
            continue
        if "style" in item.attrs:
            seen.append(visible_in(item, seen[-1]))
            todo.append(("seen", item))
        if tag == "table" and level < TABLES:
            for x in table_lines(item, level, seen[-1]):
                page.raw_line(x)
            page.line(1)
            continue
        if tag in LISTS:
            lists.append(number(item.attrs.get("start"), 1, 10**9) if tag == "ol" else None)
        if tag == "li":
            marker = "- "
            if lists and lists[-1] is not None:
                n = number(item.attrs.get("value"), lists[-1], 10**9)
                marker, lists[-1] = f"{n}. ", n + 1
            page.indents.append(" " * len(marker))
            page.marker = marker
        if tag in ("dd", "blockquote"):
            page.indents.append("  ")
        if tag in ("pre", "textarea"):
            pre += 1
        todo.append(("close", item))
        children = drawn(item) if tag == "svg" else item.children
        if tag == "details" and "open" not in item.attrs:
            children = [c for c in children if isinstance(c, Node) and c.tag == "summary"][:1]
        todo += [("open", c) for c in reversed(children)]
    page.line()
    return page.lines


def gap_of(tag: str, lists: list) -> bool:
    """Whether an empty line stands around the block; lists inside lists have none."""
    return tag in SPACED and not (lists and tag in LISTS | {"p", "dl"})


class Columns:
    """Which columns of a table are taken by cells of rows above."""

    def __init__(self):
        self.until: dict[int, int] = {}  # column to the row at which it is free again
        self.skip: dict[int, tuple[int, int]] = {}  # column to a later one, and the row up to which all between are taken

    def free(self, column: int, row: int) -> int:
        """The first free column from column on."""
        path = []
        while True:
            to, until = self.skip.get(column, (column, 0))
            if until <= row:
                to, until = column + 1, self.until.get(column, 0)
                if until <= row:
                    break
            path.append((column, until))
            column = to
        least = None
        for k, until in reversed(path):
            least = until if least is None else min(least, until)
            self.skip[k] = column, least
        return column

    def take(self, first: int, across: int, until: int) -> None:
        for k in range(first, first + across):
            self.until[k] = until
            self.skip.pop(k, None)


def table_lines(node: Node, level: int, visible: bool = True) -> Iterator[str]:
    """Rows of a table, cells under each other; a cell of several lines makes several lines.

    A column is as wide as its widest cell that spans no other; columns in which no cell begins
    have no width.
    """
    captions: list[Node] = []
    rows: list[tuple[bool, list[Node]]] = []
    loose: list[Node | str] = []

    def gather(parent: Node, seen: bool) -> None:
        for c in parent.children:
            if isinstance(c, str):
                if not BLANK.fullmatch(c):
                    loose.append(c)
            elif not shown(c):
                continue
            elif c.tag == "caption":
                captions.append(c)
            elif c.tag in ("tbody", "thead", "tfoot"):
                if parent is node:
                    gather(c, visible_in(c, seen))
                else:
                    loose.append(c)
            elif c.tag == "tr":
                cells = [x for x in c.children if isinstance(x, Node) and x.tag in ("td", "th") and shown(x)]
                rows.append((visible_in(c, seen), cells))
                loose.extend(x for x in c.children if not (isinstance(x, Node) and x.tag in ("td", "th")) and (isinstance(x, Node) or not BLANK.fullmatch(x)))
            elif c.tag not in ("col", "colgroup"):
                loose.append(c)

    gather(node, visible)
    for part in [*captions, *([_group(loose)] if loose else [])]:  # misplaced text stands before a table
        yield from render(_group(part.children), level + 1, visible)
    taken = Columns()
    grid = []
    for at, (seen, row) in enumerate(rows):
        placed, column = {}, 0
        for cell in row:
            column = taken.free(column, at)
            across = max(1, number(cell.attrs.get("colspan"), 1, SPANS))
            down = max(1, number(cell.attrs.get("rowspan"), 1, 65_534))
            placed[column] = (render(_group([cell]), level + 1, seen), across)
            if down > 1:
                taken.take(column, across, at + down)
            column += across
        grid.append(placed)
    widths: dict[int, int] = {}
    for placed in grid:
        for column, (lines, across) in placed.items():
            width = min(PAD, max(map(len, lines), default=0)) if across == 1 else 0
            widths[column] = max(widths.get(column, 0), width)
    offsets, to = {}, 0
    for column in sorted(widths):
        offsets[column] = to
        to += 2 + widths[column]
    for placed in grid:
        filled = [(offsets[column], lines) for column, (lines, _) in placed.items() if lines]
        for k in range(max((len(lines) for _, lines in filled), default=0)):
            filled = [(to, lines) for to, lines in filled if len(lines) > k]
            parts, length = [], 0
            for to, lines in filled:
                if not lines[k]:
                    continue
                gap = to - length if to <= LINE else 0
                if length and gap < 2:
                    gap = 2
                parts += [" " * gap, lines[k]]
                length += gap + len(lines[k])
            yield "".join(parts)


def _group(children: list[Node | str]) -> Node:
    group = Node("#group", {})
    group.children = children
    return group


def visible_text(page: str | None) -> str | None:
    return None if page is None else "\n".join(render(parse(page)))


def extract(pages: DataFrame, id_col: str = "page_id", html: str = "html") -> DataFrame:
    """(page_id, text)."""
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(html).alias("html"))
    kind = rows.schema["page_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([visible_text(h.as_py()) for h in batch.column(1)], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), texts], ["page_id", "text"])

    return rows.mapInArrow(run, f"page_id {kind}, text string")


@query("op4_html_text")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return extract(table(spark, folder, "pages", "page_id", "html"))
