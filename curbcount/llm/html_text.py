"""Visible text of HTML pages, laid out: a tree with implied tags, visibility rules, and a renderer."""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left
from collections.abc import Iterator
from html.parser import HTMLParser
from itertools import accumulate
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

from curbcount.llm.common import columns, slices

# Element groups of the HTML standard: fixed values.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("area base datalist head link meta noembed noframes noscript param rp script style template title audio canvas iframe object video".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li listing main menu nav ol p plaintext pre search section summary table ul xmp caption".split()
)
#: Elements of SVG and MathML that show nothing, those of SVG that hold text, and tags that end both.
NOT_DRAWN = frozenset("title desc defs metadata symbol clippath mask script style annotation annotation-xml mphantom".split())
DRAWN_TEXT = frozenset("text tspan textpath".split())
FOREIGN = frozenset(("svg", "math"))
HTML_INSIDE = frozenset("foreignobject desc title mi mo mn ms mtext annotation-xml".split())
BREAKOUT = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre "
    "ruby s small span strong strike sub sup table tt u ul var".split()
)
HEAD_CONTENT = frozenset("base link meta title noscript noframes style script template".split())
SPACED = frozenset("blockquote dl figure h1 h2 h3 h4 h5 h6 listing menu ol p plaintext pre table ul xmp hr".split())
CLOSES_P = BLOCK - {"body", "html", "caption", "li", "dd", "dt", "legend", "summary"} | {"li", "dd", "dt", "summary"}
#: A start tag closes these open elements, looked for up to one of the limits.
IMPLIED_END = {
    "li": ({"li"}, {"ol", "ul", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}), "optgroup": ({"option", "optgroup"}, {"select"}),
    "td": ({"td", "th"}, {"table"}), "th": ({"td", "th"}, {"table"}), "tr": ({"td", "th", "tr", "caption", "colgroup"}, {"table"}),
    "tbody": ({"td", "th", "tr", "tbody", "thead", "tfoot", "caption", "colgroup"}, {"table"}),
    "thead": ({"td", "th", "tr", "tbody", "thead", "tfoot", "caption", "colgroup"}, {"table"}),
    "tfoot": ({"td", "th", "tr", "tbody", "thead", "tfoot", "caption", "colgroup"}, {"table"}),
    "caption": ({"caption"}, {"table"}), "rt": ({"rt", "rp"}, {"ruby"}), "rp": ({"rt", "rp"}, {"ruby"}),
}
#: End tags do not reach across these.
SCOPE = frozenset("table td th caption button object template".split())
ROW_GROUPS = ("thead", "tbody", "tfoot")
#: What may stand directly in these is known; anything else moves in front of the table.
TABLE_PARTS = frozenset(("table", "tr", *ROW_GROUPS))
IN_TABLE = frozenset("caption colgroup col tr td th script style template".split()) | set(ROW_GROUPS)
LISTS = frozenset("ul ol menu dir dl".split())
#: Types of controls with a caption, and of those that show no text.
BUTTONS = frozenset("submit button reset".split())
NO_TEXT = frozenset("hidden password checkbox radio file color range".split())
CELL_GAP = 2
MAX_DEPTH = 400
_NO_DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.I)
_VISIBILITY = re.compile(r"(?:^|;)\s*visibility\s*:\s*(visible|initial|hidden|collapse)\b", re.I)
_DISPLAY = re.compile(r"(?:^|;)\s*display\s*:", re.I)
_COMMENT = re.compile(r"/\*.*?(?:\*/|$)", re.S)
#: Blocks of @media and the like with what is in them, and other @ lines.
_AT_BLOCK = re.compile(r"@[^{};]*(?:;|\{(?:[^{}]|\{[^{}]*\})*\}?)")
_RULE = re.compile(r"([^{}]+)\{([^{}]*)\}")
_EFFECT = re.compile(r"(?:^|;)\s*(display|visibility)\s*:\s*([a-z-]+)", re.I)
_SIMPLE = re.compile(r"(?:[a-zA-Z][a-zA-Z0-9]*)?(?:[.#][a-zA-Z_-][\w-]*)*")
_PART = re.compile(r"[.#]?[\w-]+")
_PRE = re.compile(r"white-space\s*:\s*(?:pre|break-spaces)", re.I)
_BLANK = re.compile(r"[ \t\n\r\f]+")


class Style(NamedTuple):
    """What children inherit: white space is kept, text is shown, a list is about it."""

    pre: bool = False
    shown: bool = True
    listed: bool = False


class Element:
    __slots__ = ("tag", "attrs", "children", "home")

    def __init__(self, tag: str, attrs: dict[str, str | None]):
        self.tag, self.attrs, self.children = tag, attrs, []
        self.home: list | None = None  # of a table: the children it is one of


class TreeBuilder(HTMLParser):
    """Elements with the tags put in that pages leave out; what is never closed ends with its parent."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Element("html", {})
        self.open = [self.root]

    def _close_to(self, index: int) -> None:
        del self.open[index:]

    def _find(self, tags, limits) -> int:
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag in tags:
                return i
            if self.open[i].tag in limits:
                return -1
        return -1

    def _push(self, tag: str, attrs: dict) -> None:
        element = Element(tag, attrs)
        home = self._place(element, tag in IN_TABLE)
        if tag == "table":
            element.home = home
        self.open.append(element)

    def _place(self, node: Element | str, fits: bool) -> list:
        """Puts the node into the innermost open element, or in front of the table in whose parts it has no place."""
        home = self.open[-1].children
        if not fits and self.open[-1].tag in TABLE_PARTS and (at := self._find({"table"}, ())) > 0:
            table = self.open[at]
            home = table.home
            k = next(k for k in range(len(home) - 1, -1, -1) if home[k] is table)
            home.insert(k, node)
        else:
            home.append(node)
        return home

    def handle_starttag(self, tag: str, attrs: list) -> None:
        given = dict(reversed(attrs))
        if tag in ("html", "body"):
            if tag == "body":
                at = self._find({"head"}, ())
                self._close_to(at if at > 0 else len(self.open))
            self.root.attrs = {**given, **self.root.attrs}
            return
        if tag in BREAKOUT and (at := self._find(FOREIGN, HTML_INSIDE)) > 0:
            self._close_to(at)
        if tag in ("select", "input", "textarea") and (at := self._find({"select"}, SCOPE)) > 0:
            self._close_to(at)
            if tag == "select":  # a second start tag is an end tag
                return
        if self.open[-1].tag == "head" and tag not in HEAD_CONTENT:
            self.open.pop()
        if tag in CLOSES_P and (at := self._find({"p"}, SCOPE)) > 0:
            self._close_to(at)
        if re.fullmatch(r"h[1-6]", tag) and re.fullmatch(r"h[1-6]", self.open[-1].tag):
            self.open.pop()
        if tag in IMPLIED_END:
            ends, limits = IMPLIED_END[tag]
            while (at := self._find(ends, limits)) > 0:
                self._close_to(at)
        if tag == "a" and (at := self._find({"a"}, SCOPE)) > 0:
            self._close_to(at)
        if self.open[-1].tag == "colgroup" and tag not in ("col", "template"):
            self.open.pop()
        if tag in IN_TABLE - HIDDEN and (at := self._find(TABLE_PARTS, {"td", "th", "caption", "colgroup", "template"})) > 0:
            self._close_to(at + 1)  # what moved in front of the table ends here
        if tag == "form" and self.open[-1].tag in TABLE_PARTS:
            return  # its rows and cells belong to the table
        if tag in ("td", "th") and self.open[-1].tag in ("table", *ROW_GROUPS):
            self._push("tr", {})
        if len(self.open) > MAX_DEPTH:
            self.open.pop()
        self._push(tag, given)
        if tag in VOID:
            self.open.pop()
        elif tag == "plaintext":  # the rest of the page is text
            self.set_cdata_mode(tag)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        # a slash closes nothing in HTML, only foreign elements
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self._find({"svg", "math"}, ()) > 0:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in ("html", "body"):
            return
        if tag == "br":
            self.handle_starttag("br", [])
            return
        inner = ("tr", "td", "th", "caption", *ROW_GROUPS)
        limits = set() if tag == "table" else {"table"} if tag in inner else SCOPE - {tag}
        if (at := self._find({tag}, limits)) > 0:
            self._close_to(at)
        elif tag == "p":
            self._push("p", {})
            self.open.pop()

    def handle_data(self, data: str) -> None:
        if self.open[-1].tag == "head" and data.strip():
            self.open.pop()
        if self.open[-1].tag == "colgroup" and data.strip():
            self.open.pop()
        self._place(data, not data.strip())


def tree(html: str) -> Element:
    builder = TreeBuilder()
    builder.feed(html)
    if builder.cdata_elem == "plaintext":
        builder.handle_data(builder.rawdata)
        builder.rawdata = ""
    if re.match(r"<[a-zA-Z/!?]", builder.rawdata):  # a tag that the page's end cuts off is no text
        builder.rawdata = ""
    builder.close()
    _apply(_sheet(builder.root), builder.root)
    return builder.root


def _below(root: Element, but: frozenset[str] = frozenset()) -> Iterator[Element]:
    """All elements in order, without the inside of some."""
    waiting = [root]
    while waiting:
        element = waiting.pop()
        yield element
        if element.tag not in but:
            waiting += [c for c in reversed(element.children) if not isinstance(c, str)]


def _sheet(root: Element) -> dict[str, list[tuple[tuple[int, int], frozenset[str], str, str]]]:
    """Rules of the page's style sheets that show or hide, by the rarest part of their selector.

    Selectors of one element (type, classes, id) count; those of relations, states or media do not. A rule:
    its weight and place, all parts of its selector, the property and its value.
    """
    rules: dict[str, list] = {}
    place = 0
    for element in _below(root, frozenset(("noscript", "template"))):
        if element.tag != "style" or (element.attrs.get("media") or "all").strip().lower() not in ("all", "screen"):
            continue
        text = _COMMENT.sub(" ", "".join(c for c in element.children if isinstance(c, str)))
        for selectors, body in _RULE.findall(_AT_BLOCK.sub(" ", text)):
            effects = [(n.lower(), v.lower()) for n, v in _EFFECT.findall(body)]
            for selector in selectors.split(",") if effects else ():
                if not _SIMPLE.fullmatch(selector.strip()):
                    continue
                parts = _PART.findall(selector)
                parts = frozenset(x if x[0] in ".#" else x.lower() for x in parts)
                weight = sum(100 if x[0] == "#" else 10 if x[0] == "." else 1 for x in parts)
                place += 1
                rarest = max(parts, key=lambda x: (x[0] == "#", x[0] == ".", x))
                rules.setdefault(rarest, []).extend(((weight, place), parts, n, v) for n, v in effects)
    return rules


def _apply(rules: dict, root: Element) -> None:
    """Writes what the style sheets say into the elements' own style, before what stands there."""
    for element in _below(root) if rules else ():
        classes = [f".{c}" for c in (element.attrs.get("class") or "").split()]
        own = frozenset([element.tag, *classes, *([f"#{element.attrs['id']}"] if element.attrs.get("id") else [])])
        fits = sorted((rule for part in own for rule in rules.get(part, ()) if rule[1] <= own), key=lambda rule: rule[0])
        said = {name: value for _, _, name, value in fits}
        inline = element.attrs.get("style") or ""
        if "display" in said and _DISPLAY.search(inline):
            del said["display"]
        if said:
            element.attrs = element.attrs | {"style": "".join(f"{n}:{v};" for n, v in said.items()) + inline}


def hidden(element: Element) -> bool:
    attrs = element.attrs
    return (
        element.tag in HIDDEN or "hidden" in attrs or element.tag == "dialog" and "open" not in attrs
        or bool(_NO_DISPLAY.search(attrs.get("style") or ""))
    )


def _inherit(element: Element, style: Style) -> Style:
    own = element.attrs.get("style") or ""
    pre = style.pre or element.tag in ("pre", "textarea", "listing", "plaintext", "xmp") or bool(_PRE.search(own))
    found = _VISIBILITY.findall(own)
    return Style(pre, found[-1].lower() in ("visible", "initial") if found else style.shown, style.listed)


def _collapsed(element: Element) -> bool:
    """Rows that collapse go as a whole."""
    found = _VISIBILITY.findall(element.attrs.get("style") or "")
    return hidden(element) or bool(found) and found[-1].lower() == "collapse"


def width(text: str) -> int:
    """Columns a text takes: wide East Asian characters take two, combining marks none."""
    if text.isascii():
        return len(text)
    return sum(0 if unicodedata.combining(c) else 2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in text)


class Layout:
    """Lines of a box. Inline text gathers in the last line; blocks break it, some leave a blank line."""

    def __init__(self):
        self.lines: list[str] = []
        self.line: list[str] = []
        self.space = False
        self.gap = False
        self.marker = ""

    def text(self, data: str, pre: bool) -> None:
        if pre:
            first, *others = data.replace("\r\n", "\n").split("\n")
            self._add(first)
            for part in others:
                self.newline()
                self._add(part)
            return
        for i, part in enumerate(_BLANK.split(data)):
            if i:
                self.space = True
            self._add(part, True)

    def _add(self, part: str, collapse: bool = False) -> None:
        if not part:
            return
        if not self.line:
            if self.gap and self.lines:
                self.lines.append("")
            self.gap = False
            if self.marker:
                self.line.append(self.marker)
                self.marker = ""
        elif self.space and collapse:
            self.line.append(" ")
        self.space = False
        self.line.append(part)

    def newline(self) -> None:
        """A forced break: an empty line stays one."""
        if self.line or self.lines:
            self.lines.append("".join(self.line).rstrip())
        self.line, self.space = [], False

    def edge(self, blank: bool) -> None:
        """The edge of a block: no break at the start of a line, one blank line between spaced blocks."""
        if self.line:
            self.lines.append("".join(self.line).rstrip())
        self.line, self.space = [], False
        self.gap = self.gap or blank

    def add_lines(self, lines: list[str], lead: str = "", follow: str = "") -> None:
        for line in lines:
            if self.gap and self.lines:
                self.lines.append("")
            self.gap = False
            self.lines.append((lead + line).rstrip())
            lead = follow

    def finish(self) -> list[str]:
        self.edge(False)
        out = [line for k, line in enumerate(self.lines) if line or k and self.lines[k - 1]]
        while out and not out[-1]:
            out.pop()
        return out


def _marker(element: Element, place: int) -> tuple[str, str]:
    """The list marker and the indent of further lines."""
    mark = "- " if element.tag != "ol" else f"{place}. "
    return mark, " " * len(mark)


def _number(text: str | None, default: int) -> int:
    return int(text) if text and re.fullmatch(r"\s*-?\d{1,9}\s*", text) else default


def _list(element: Element, out: Layout, style: Style) -> None:
    place = _number(element.attrs.get("start"), 1)
    for child in element.children:
        if isinstance(child, str) or child.tag != "li":
            _render(child, out, style)
            continue
        if hidden(child):
            continue
        own = _inherit(child, style)
        place = _number(child.attrs.get("value"), place)
        mark, indent = _marker(element, place)
        place += 1
        out.edge(False)
        out.add_lines(render(child.children, own), mark if own.shown else indent, indent)
        out.edge(False)


def _rows(element: Element, style: Style) -> Iterator[tuple[Element, Style]]:
    for child in element.children:
        if isinstance(child, str) or child.tag not in ("tr", *ROW_GROUPS) or _collapsed(child):
            continue
        if child.tag == "tr":
            yield child, _inherit(child, style)
        else:
            yield from _rows(child, _inherit(child, style))


def _loose(element: Element, style: Style) -> Iterator[tuple[Element | str, Style]]:
    """The caption, and what stands in a table or its row groups without being a row."""
    for child in element.children:
        if isinstance(child, str):
            if child.strip():
                yield child, style
        elif child.tag in ROW_GROUPS:
            if not _collapsed(child):
                yield from _loose(child, _inherit(child, style))
        elif child.tag not in ("tr", "colgroup", "col"):
            yield child, style


def _table(element: Element, out: Layout, style: Style) -> None:
    """Cells one under the other: every column is as wide as its widest cell that spans no other."""
    for child, own in _loose(element, style):  # these come first
        _render(child, out, own)
    out.edge(False)
    grid: list[list[tuple[int, int, list[str]]]] = []
    # columns that cells of earlier rows reach down into: (first, end, row where that ends), by first
    busy: list[tuple[int, int, int]] = []
    for r, (row, own) in enumerate(_rows(element, style)):
        busy = [b for b in busy if b[2] > r]
        cells, c, k, more = [], 0, 0, []
        for cell in row.children:
            if isinstance(cell, str) and not cell.strip() or not isinstance(cell, str) and hidden(cell):
                continue
            while k < len(busy) and busy[k][0] <= c:
                c = max(c, busy[k][1])
                k += 1
            attrs = {} if isinstance(cell, str) else cell.attrs
            across, down = (min(max(1, _number(attrs.get(a), 1)), 1000) for a in ("colspan", "rowspan"))
            if down > 1:
                more.append((c, c + across, r + down))
            cells.append((c, across, render([cell], own) if isinstance(cell, str) or cell.tag not in ("td", "th") else render(cell.children, _inherit(cell, own))))
            c += across
        busy = sorted(busy + more)
        grid.append(cells)
    wide: dict[int, int] = {}
    for cells in grid:
        for c, across, lines in cells:
            if across == 1:
                wide[c] = max(wide.get(c, 0), *map(width, lines), 0)
    # only columns that hold something have a width, however many a cell spans
    filled = sorted(c for c, n in wide.items() if n)
    begins = [0, *accumulate(wide[c] + CELL_GAP for c in filled)]
    for cells in grid:
        for k in range(max((len(lines) for _, _, lines in cells), default=0)):
            line = ""
            for c, _, lines in cells:
                if k < len(lines) and lines[k]:
                    line += " " * max(begins[bisect_left(filled, c)] - width(line), CELL_GAP if line else 0) + lines[k]
            out.add_lines([line])
    out.edge(False)


def _field(attrs: dict[str, str | None]) -> str:
    """What a control shows: its caption, the text in it, or else the text that asks for one."""
    kind = (attrs.get("type") or "text").strip().lower()
    if kind == "image":
        return attrs.get("alt") or ""
    if kind in BUTTONS:
        return attrs.get("value") or ""
    return "" if kind in NO_TEXT else attrs.get("value") or attrs.get("placeholder") or ""


def _options(element: Element) -> Iterator[Element]:
    for child in element.children:
        if not isinstance(child, str) and not hidden(child):
            if child.tag == "option":
                yield child
            else:
                yield from _options(child)


def _select(element: Element, out: Layout, style: Style) -> None:
    """The option a closed list shows: the last one selected, else the first that can be; an open list shows all."""
    options = list(_options(element))
    if "multiple" not in element.attrs and _number(element.attrs.get("size"), 1) <= 1:
        options = [o for o in options if "selected" in o.attrs][-1:] or [o for o in options if "disabled" not in o.attrs][:1] or options[:1]
    for k, option in enumerate(options):
        if k:
            out.edge(False)
        for child in [option.attrs["label"]] if option.attrs.get("label") else option.children:
            _render(child, out, _inherit(option, style))


def _drawing(element: Element, out: Layout, style: Style, drawn: bool) -> None:
    """Text labels of a drawing, each on a line of its own; HTML inside is laid out as ever."""
    for child in element.children:
        if isinstance(child, str):
            if drawn:
                _render(child, out, style)
            continue
        if child.tag in NOT_DRAWN or hidden(child) or child.attrs.get("display") == "none":
            continue
        own = _inherit(child, style)
        if child.attrs.get("visibility") and not _VISIBILITY.search(child.attrs.get("style") or ""):
            own = own._replace(shown=child.attrs["visibility"] == "visible")
        apart = child.tag == "text" or child.tag == "foreignobject" or child.tag == "tspan" and any(a in child.attrs for a in ("x", "y", "dy"))
        if apart:
            out.edge(False)
        if child.tag == "foreignobject":
            for node in child.children:
                _render(node, out, own)
        else:
            _drawing(child, out, own, drawn or child.tag in DRAWN_TEXT)
        if child.tag in ("text", "foreignobject"):
            out.edge(False)


def _formula(element: Element, out: Layout, style: Style) -> None:
    """A formula in reading order, without annotations: fractions with a slash, rows of a matrix on lines."""
    parts = [c for c in element.children if isinstance(c, str) or c.tag not in NOT_DRAWN and not hidden(c)]
    above = 0
    for child in parts:
        if isinstance(child, str):
            if child.strip():
                _render(child, out, style)
            continue
        if element.tag == "mfrac" and above and style.shown:
            out.text("/", False)
        above += 1
        if child.tag in ("mtr", "mlabeledtr"):
            out.edge(False)
        if child.tag == "mtd" or child.tag == "mtext":
            out.text(" ", False)
        if child.tag in BREAKOUT | FOREIGN:
            _render(child, out, style)
        else:
            _formula(child, out, _inherit(child, style))
        if child.tag == "mtext":
            out.text(" ", False)


def _render(node: Element | str, out: Layout, style: Style) -> None:
    if isinstance(node, str):
        if style.shown:
            out.text(node, style.pre)
        return
    if hidden(node):
        return
    tag, style = node.tag, _inherit(node, style)
    if tag == "br":
        out.newline()
    elif tag == "img":
        if style.shown:
            out.text(node.attrs.get("alt") or "", False)
    elif tag == "input":
        if style.shown:
            out.text(_field(node.attrs), False)
    elif tag == "wbr":
        return
    elif tag == "select":
        _select(node, out, style)
    elif tag == "svg":
        _drawing(node, out, style, False)
    elif tag == "math":
        _formula(node, out, style)
    else:
        block = tag in BLOCK
        spaced = tag in SPACED and not (style.listed and tag in LISTS)
        if tag in LISTS:
            style = style._replace(listed=True)
        if block:
            out.edge(spaced)
        if tag in ("ul", "ol", "menu", "dir"):
            _list(node, out, style)
        elif tag == "table":
            _table(node, out, style)
        elif tag in ("blockquote", "dd"):
            out.add_lines(render(node.children, style), "    ", "    ")
        else:
            children = node.children
            if tag == "pre" and children and isinstance(children[0], str):
                children = [children[0].removeprefix("\n"), *children[1:]]
            if tag == "details" and "open" not in node.attrs:
                children = [c for c in children if not isinstance(c, str) and c.tag == "summary"][:1]
            for child in children:
                _render(child, out, style)
        if block:
            out.edge(spaced)


def render(nodes: list[Element | str], style: Style = Style()) -> list[str]:
    out = Layout()
    for node in nodes:
        _render(node, out, style)
    return out.finish()


def visible_text(html: str | None) -> str:
    """The page as a reader sees it; empty for null and for pages without visible text."""
    return "\n".join(render(tree(html).children)) if html else ""


def extract_text(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """One row per row: id, text, n_chars, n_lines. All visible text, in reading order.

    Paragraphs, headings, lists and tables are set apart by a blank line; list items get markers and an
    indent; table cells stand in columns; preformatted text keeps its white space. Formulas and labels of
    drawings are text, a closed list shows its chosen option. controls show their caption or value. Scripts, styles, head, embedded media and
    elements hidden by attribute, inline style or a simple rule of the page's style sheets are left out. Null and empty pages give empty text;
    rows with equal or null ids stay apart; other columns are not read. Tags nested deeper than
    ``MAX_DEPTH`` become siblings.
    """
    narrow = columns(pages, row_id=id_col, html=html_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "html"):
            found = [visible_text(h) for h in part["html"].to_pylist()]
            sizes = pa.array([len(t) for t in found], pa.int64()), pa.array([t.count("\n") + 1 if t else 0 for t in found], pa.int64())
            yield pa.record_batch([part["row_id"], pa.array(found, pa.string()), *sizes], ["row_id", "text", "n_chars", "n_lines"])

    kind = narrow.schema["row_id"].dataType.simpleString()
    return narrow.mapInArrow(run, f"row_id {kind}, text string, n_chars bigint, n_lines bigint").withColumnRenamed("row_id", id_col)
