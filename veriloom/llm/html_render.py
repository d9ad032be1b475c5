"""Visible text of HTML pages, laid out: blocks, lists and tables as a browser would space them.

A tree builder makes elements from the markup, with the end tags that HTML implies (a block ends a
paragraph, an item ends the item before it, a cell its neighbour, and so on).  Visibility rules then
drop what a browser does not show: the head, scripts, styles, templates, fallback content, elements
with ``hidden`` or ``display:none``, what ``visibility:hidden`` hides (unless an inner element shows
itself again), hidden inputs, and the inside of closed details and dialogs.  Everything else is
emitted: white space collapses within blocks, paragraphs are set apart by an empty line, list items
have markers and hang, table columns are padded to one width, and preformatted text stays as it is.

Defined results: null gives null; an empty page, or one that shows nothing, gives the empty text;
unclosed and stray tags, comments and unbalanced quotes never fail; nesting deeper than DEEPEST
becomes siblings, so no text is lost; rows that repeat repeat their results; other columns are
ignored.
"""

from __future__ import annotations

import html
import re
import textwrap
from collections import Counter
from collections.abc import Generator, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import map_arrow, only, slices

#: Characters of a table cell's line, if a column follows; levels of indentation; tables in tables.
WIDE = 80
INDENTS = 30
TABLES = 4

# Element names by their role in HTML (fixed values of the standard).
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = frozenset("head script style template noscript iframe noembed noframes object canvas audio video datalist map title desc defs metadata annotation annotation-xml".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table caption thead tbody tfoot tr td th ul".split())
SPACED = frozenset("blockquote dl figure h1 h2 h3 h4 h5 h6 hr menu ol p pre table ul fieldset".split())
ENDS_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul li dd dt".split())
#: start tag: (elements it ends, elements that shield them)
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "optgroup", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "body": ({"head"}, set()),
}
HEAD_ONLY = frozenset("base link meta title style script noscript template".split())
#: An end tag does not reach past these.
WALLS = {"td": {"table"}, "th": {"table"}, "tr": {"table"}, "li": {"ul", "ol", "menu", "dir"}}

TAG = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*+>?|<(?P<end>/?)(?P<name>[a-zA-Z][^\t\n\f\r />]*+)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|[^>]*+(?:>|\Z))|</[^>]*+>?",
    re.S,
)
ATTR = re.compile(r"([^\s=>\"'/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
SPACE = re.compile(r"[ \t\n\f\r]+")
BREAK = "\x01"


class Node:
    __slots__ = ("tag", "attrs", "kids")

    def __init__(self, tag: str, attrs: dict[str, str]) -> None:
        self.tag, self.attrs, self.kids = tag, attrs, []


def attributes(s: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in ATTR.finditer(s)} if "=" in s or s.strip(" /\n\t>") else {}


class _Open:
    """The open elements, innermost last, and how many there are of each name."""

    def __init__(self, root: Node) -> None:
        self.stack, self.names = [root], Counter([root.tag])

    def push(self, node: Node) -> None:
        self.stack.append(node)
        self.names[node.tag] += 1

    def cut(self, k: int) -> None:
        """Close all from the k-th on."""
        for x in self.stack[k:]:
            self.names[x.tag] -= 1
        del self.stack[k:]

    def innermost(self, names: set[str] | frozenset[str] | tuple, walls: set[str] | frozenset[str] | tuple) -> int:
        """The place of the innermost element of these names within the walls, 0 if there is none."""
        if any(self.names[x] for x in names):
            for k in range(len(self.stack) - 1, 0, -1):
                if self.stack[k].tag in names:
                    return k
                if self.stack[k].tag in walls:
                    break
        return 0


P_WALLS = frozenset("td th button object li table".split())


def build(page: str) -> Node:
    """The element tree of a page."""
    root = Node("html", {})
    open_ = _Open(root)
    stack = open_.stack
    at, n = 0, len(page)

    def text(s: str) -> None:
        if s:
            if stack[-1].tag == "head" and s.strip():
                open_.cut(len(stack) - 1)
            stack[-1].kids.append(html.unescape(s) if "&" in s else s)

    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            text(page[at:])
            break
        m = TAG.match(page, lt)
        if not m:
            text(page[at : lt + 1])
            at = lt + 1
            continue
        text(page[at:lt])
        at = m.end()
        name = m["name"]
        if not name:
            continue
        tag = name.lower()
        if m["end"]:
            if tag in ("br", "p") and not open_.names[tag]:
                stack[-1].kids.append(Node(tag, {}))
            elif k := open_.innermost((tag,), WALLS.get(tag, ())):
                open_.cut(k)
            continue
        attrs = attributes(m["rest"][:-1] if m["rest"].endswith(">") else m["rest"])
        if tag in ("html", "body") and open_.names[tag]:
            continue
        if stack[-1].tag == "head" and tag not in HEAD_ONLY:
            open_.cut(len(stack) - 1)
        if tag in ENDS_P and (k := open_.innermost(("p",), P_WALLS)):
            open_.cut(k)
        if tag in IMPLIED:
            ends, shields = IMPLIED[tag]
            while k := open_.innermost(ends, shields):
                open_.cut(k)
        node = Node(tag, attrs)
        stack[-1].kids.append(node)
        if tag in RAW:
            stop = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)", re.I).search(page, at)
            inner = page[at : stop.start()] if stop else page[at:]
            if tag not in UNSEEN and inner:
                node.kids.append(html.unescape(inner) if tag == "textarea" else inner)
            gt = page.find(">", stop.start()) if stop else -1
            at = gt + 1 if gt >= 0 else n
        elif tag not in VOID and not (m["rest"].endswith("/>") and (open_.names["svg"] or open_.names["math"])):
            open_.push(node)
    return root


NUMBER = re.compile(r"[ \t\n\f\r]*([+-]?[0-9]{1,9})")


def number(attrs: dict[str, str], name: str, default: int) -> int:
    """The whole number that an attribute begins with."""
    m = NUMBER.match(attrs.get(name, ""))
    return int(m[1]) if m else default


def _shown(node: Node, seen: bool) -> tuple[bool, bool]:
    """Whether the element is laid out at all, and whether its own text is visible."""
    a = node.attrs
    if node.tag in UNSEEN or "hidden" in a and a["hidden"].lower() != "until-found":
        return False, False
    if node.tag == "dialog" and "open" not in a:
        return False, False
    if node.tag == "input" and a.get("type", "").lower() == "hidden":
        return False, False
    style = a.get("style", "").lower().replace(" ", "")
    if style:
        if "display:none" in style:
            return False, False
        if "visibility:hidden" in style or "visibility:collapse" in style:
            seen = False
        elif "visibility:visible" in style:
            seen = True
    return True, seen


Box = tuple[int, list[str]]  # empty lines asked for around it, and its lines


def _stacked(boxes: list[Box]) -> list[str]:
    out: list[str] = []
    below = 0
    for margin, lines in boxes:
        if not lines:
            below = max(below, margin)
            continue
        if out:
            out += [""] * max(margin, below)
        out += lines
        below = margin
    return out


class Look(NamedTuple):
    """What holds where an element is laid out."""

    seen: bool = True
    pre: bool = False
    indents: int = 0
    tables: int = 0
    in_list: bool = False


Step = Generator  # yields the steps that it needs done, and gets what they return


def done(step: Step):
    """Run a step and all that it needs, on a stack of its own."""
    stack, value = [step], None
    while stack:
        try:
            stack.append(stack[-1].send(value))
            value = None
        except StopIteration as e:
            stack.pop()
            value = e.value
    return value


LISTS = ("ul", "ol", "menu", "dir")
INPUTS = ("submit", "button", "reset", "text", "search", "email")


def _lines(node: Node, look: Look) -> Step:
    out: list[Box] = []
    yield _boxes(node, look._replace(in_list=node.tag in LISTS), out)
    return _stacked(out)


def _boxes(node: Node, look: Look, out: list[Box], lead: str = "") -> Step:
    """Append the boxes of what an element holds; ``lead`` stands before its first line."""
    line: list[str] = []

    def flush() -> None:
        nonlocal lead
        if line:
            s = "".join(line)
            line.clear()
            if look.pre:
                rows = s.replace(BREAK, "\n").replace("\r\n", "\n").split("\n")
                while rows and not rows[-1].strip():
                    rows.pop()
                while rows and not rows[0].strip():
                    rows.pop(0)
                rows = [r.rstrip() for r in rows]
            else:
                rows = [r.strip(" ") for r in SPACE.sub(" ", s).split(BREAK)]
                while rows and not rows[-1]:
                    rows.pop()
            if any(rows):
                out.append((0, [lead + rows[0].replace("\xa0", " "), *(r.replace("\xa0", " ") for r in rows[1:])]))
                lead = ""

    inside = [(iter(node.kids), look.seen)]
    while inside:
        kids, seen = inside[-1]
        kid = next(kids, None)
        if kid is None:
            inside.pop()
            continue
        if isinstance(kid, str):
            if seen:
                line.append(kid.replace(BREAK, ""))
            continue
        laid, vis = _shown(kid, seen)
        if not laid:
            continue
        if kid.tag == "br":
            line.append(BREAK)
        elif kid.tag == "input":
            if vis and kid.attrs.get("type", "text").lower() in INPUTS:
                line.append(f" {kid.attrs.get('value', '')} ")
        elif kid.tag in BLOCK:
            flush()
            yield _block(kid, look._replace(seen=vis), out)
        else:
            inside.append((iter(kid.kids), vis))
    flush()


def _block(node: Node, look: Look, out: list[Box]) -> Step:
    tag = node.tag
    margin = 1 if tag in SPACED else 0
    if tag in LISTS and look.in_list:
        margin = 0
    inner = look._replace(in_list=False)
    if tag == "table" and look.tables < TABLES:
        out.append((margin, (yield _table(node, inner._replace(tables=look.tables + 1)))))
    elif tag in LISTS:
        yield _list(node, inner, out, margin)
    elif tag == "li":
        yield _item(node, "- ", inner, out)
    elif tag == "hr":
        out.append((1, []))
    elif tag in ("blockquote", "dd") and look.indents < INDENTS:
        rows = yield _lines(node, inner._replace(indents=look.indents + 1))
        out.append((margin, [f"  {r}" if r else r for r in rows]))
    elif tag == "details" and "open" not in node.attrs:
        for kid in node.kids:
            if isinstance(kid, Node) and kid.tag == "summary":
                out.append((0, (yield _lines(kid, inner))))
                break
    else:
        # The element's boxes stand among its neighbours', its margins as boxes without lines.
        out.append((margin, []))
        yield _boxes(node, inner._replace(pre=look.pre or tag == "pre"), out)
        out.append((margin, []))


def _item(node: Node, marker: str, look: Look, out: list[Box]) -> Step:
    if look.indents >= INDENTS:
        yield _boxes(node, look._replace(in_list=True), out, marker)
        return
    own: list[Box] = []
    yield _boxes(node, look._replace(in_list=True, indents=look.indents + 1), own)
    pad = " " * len(marker)
    out.append((0, [(marker if not k else pad if r else "") + r for k, r in enumerate(_stacked(own))]))


def _list(node: Node, look: Look, out: list[Box], margin: int) -> Step:
    n = number(node.attrs, "start", 1)
    loose = Node("div", {})
    out.append((margin, []))
    for kid in [*node.kids, None]:
        if kid is not None and (isinstance(kid, str) or kid.tag != "li"):
            loose.kids.append(kid)
            continue
        if loose.kids:
            yield _boxes(loose, look, out)
            loose = Node("div", {})
        if kid is None:
            break
        laid, vis = _shown(kid, look.seen)
        if laid:
            n = number(kid.attrs, "value", n)
            yield _item(kid, f"{n}. " if node.tag == "ol" else "- ", look._replace(seen=vis), out)
            n += 1
    out.append((margin, []))


Cell = tuple[int, int, list[str]]  # columns, rows and lines


def _rows(node: Node, look: Look, head: list[Box], rows: list[list[Cell]]) -> Step:
    """Append the rows of a table or of a group of its rows; what is no row goes to ``head``."""
    loose = Node("div", {})
    span = lambda cell, name: min(max(1, number(cell.attrs, name, 1)), 1000)
    for kid in node.kids:
        if isinstance(kid, str):
            if kid.strip():
                loose.kids.append(kid)
            continue
        laid, vis = _shown(kid, look.seen)
        if not laid or kid.tag in ("colgroup", "col"):
            continue
        here = look._replace(seen=vis)
        if kid.tag in ("thead", "tbody", "tfoot"):
            yield _rows(kid, here, head, rows)
        elif kid.tag == "tr":
            row: list[Cell] = []
            for cell in kid.kids:
                if isinstance(cell, str):
                    if cell.strip():
                        row.append((1, 1, (yield _lines(_wrap(cell), here))))
                    continue
                ok, cell_seen = _shown(cell, vis)
                if ok:
                    own = cell if cell.tag in ("td", "th") else _wrap(cell)
                    row.append((span(cell, "colspan"), span(cell, "rowspan"), (yield _lines(own, here._replace(seen=cell_seen)))))
            rows.append(row)
        elif kid.tag == "caption":
            head.append((0, (yield _lines(kid, here))))
        elif kid.tag in ("td", "th"):
            rows.append([(span(kid, "colspan"), 1, (yield _lines(kid, here)))])
        else:
            loose.kids.append(kid)
    if loose.kids:
        head.append((0, (yield _lines(loose, look))))


def _table(node: Node, look: Look) -> Step:
    head: list[Box] = []
    rows: list[list[Cell]] = []
    yield _rows(node, look._replace(pre=False), head, rows)
    # Columns of each cell, with those that row spans above still cover left empty.
    placed: list[list[Cell]] = []
    covered: dict[int, int] = {}
    for row in rows:
        col, cells, later = 0, [], {}
        for cols, down, text in row:
            while covered.get(col, 0):
                col += 1
            cells.append((col, cols, text))
            if down > 1:
                later |= {c: down - 1 for c in range(col, col + cols)}
            col += cols
        covered = {c: k - 1 for c, k in covered.items() if k > 1} | later
        placed.append(cells)
    used = sorted({c for cells in placed for c, _, _ in cells})
    last = used[-1] if used else 0
    placed = [[(col, cols, text if col == last else _narrow(text)) for col, cols, text in cells] for cells in placed]
    width: dict[int, int] = {}
    for cells in placed:
        for col, cols, text in cells:
            if cols == 1 and col != last:
                width[col] = min(WIDE, max(width.get(col, 0), max(map(len, text), default=0)))
    begin, x = {}, 0
    for c in used:
        begin[c] = x
        x += width.get(c, 0) + 2
    out: list[str] = []
    for cells in placed:
        for k in range(max((len(t) for _, _, t in cells), default=0)):
            line = ""
            for col, _, text in cells:
                if k < len(text) and text[k]:
                    line = line.ljust(begin[col]) if len(line) <= begin[col] or not line else line + "  "
                    line += text[k]
            out.append(line.rstrip())
    return _stacked([*head, (0, out)])


def _narrow(text: list[str]) -> list[str]:
    """Lines of WIDE characters at most, broken at blanks; a longer word stays whole and sticks out."""
    if max(map(len, text), default=0) <= WIDE:
        return text
    return [part for t in text for part in (textwrap.wrap(t, WIDE, break_on_hyphens=False, break_long_words=False) if len(t) > WIDE else [t])]


def _wrap(kid: Node | str) -> Node:
    node = Node("div", {})
    node.kids.append(kid)
    return node


def render(page: str) -> str:
    """The visible text of a page."""
    root = build(page)
    return "\n".join(done(_lines(root, Look()))) if _shown(root, True)[0] else ""


def extract(pages: DataFrame, page_id: str = "page_id", markup: str = "html") -> DataFrame:
    """page_id, text and n_chars of every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, markup):
            text = [None if h is None else render(h) for h in b.column(markup).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(page_id), pa.array(text, pa.string()), pa.array([None if t is None else len(t) for t in text], pa.int64())], names=["page_id", "text", "n_chars"])

    return map_arrow(only(pages, page_id, markup), run, "page_id long, text string, n_chars long")
