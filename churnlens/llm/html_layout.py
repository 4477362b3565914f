"""HTML to text by layout: all visible text, with its block structure.

A tree builder applies implied tags (a paragraph ends where a block begins, a
list item where the next one begins, rows and cells likewise; unclosed tags
end with their parent). Rendering skips what a browser does not show and
writes blocks on lines of their own, blank lines between paragraphs, markers
and indents for lists, preformatted text as it is, and tables with each column
padded to its widest cell.
Formulas and the texts of drawings are inline text; inside what visibility
hides, elements that set it to visible show again. Of a closed ``details`` only
the summary shows; of form fields, what they hold, but never a password.

What a page looks like is taken from its markup and ``style`` attributes
alone: style sheets and scripts are not run, ``display`` only hides, and no
text of the browser's own (the label of an unlabelled button) is added.
Elements nested deeper than DEPTH become siblings, as in browsers; their text
is kept. At most one blank line separates blocks; a caption stands right
above its rows. Rows are in the order shown: the first ``thead`` on top, the
first ``tfoot`` at the bottom.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.llm.common import bound_batches

# Fixed values of the HTML standard: void elements, block elements, elements
# never shown, and which open elements a start tag ends.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
PARAGRAPHS = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre listing xmp plaintext table dl figure".split())
BLOCKS = PARAGRAPHS | frozenset(
    "address article aside body caption center dd details dialog dir div dt fieldset figcaption footer form header "
    "hgroup hr html legend li main menu nav ol optgroup option search section summary ul tr tbody thead tfoot".split()
)
HIDDEN = frozenset(
    "title script style template noscript noframes iframe object audio video canvas datalist "
    "area base link meta param source track col colgroup".split()
)
#: Parts of svg and math that are not shown where they stand.
UNDRAWN = frozenset(
    "defs symbol clippath mask pattern marker filter lineargradient radialgradient desc metadata "
    "annotation annotation-xml".split()
)
#: Elements of svg and math that hold HTML, and HTML tags that end any other part of svg and math.
HTML_INSIDE = frozenset("foreignobject desc title mi mo mn ms mtext annotation-xml".split())
BREAKOUT = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr "
    "ol p pre ruby s small span strong strike sub sup table tt u ul var".split()
)
#: Parts of formulas and drawings that stand apart from the text around them.
APART = frozenset("svg text foreignobject mfrac mtable mtr mlabeledtr mtd".split())
ENDS_P = (BLOCKS - frozenset("body html caption dd dt legend li optgroup option summary tr tbody thead tfoot".split()))
CELLS = frozenset(("td", "th"))
SECTIONS = frozenset(("tbody", "thead", "tfoot"))
PARTS = SECTIONS | {"table", "tr"}
#: Elements whose markup stays within them, whatever table it names.
CLOSED = frozenset("template title noscript noframes iframe".split())
#: End tags that reach out of cells and tables.
THROUGH = PARTS | CLOSED
SIBLINGS = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",), "optgroup": ("option", "optgroup"),
    "td": ("td", "th"), "th": ("td", "th"), "tr": ("td", "th", "tr", "caption"),
    **{s: ("td", "th", "tr", "caption", "tbody", "thead", "tfoot") for s in SECTIONS},
}
#: Elements an implied end never reaches through.
SCOPES = frozenset(("table", "html", "ul", "ol", "menu", "dir", "dl", "select", "caption", "button"))
#: Elements whose white space is kept, and those whose content is text, whatever it looks like.
PREFORMATTED = frozenset("pre listing xmp plaintext textarea".split())
RAW = ("script", "style", "xmp")
#: Elements nested deeper become siblings, as browsers limit depth too.
DEPTH = 200
#: Tags whose ends are optional or implied and that need no element: all that
#: may stand in a head is hidden by itself, anything else is in the body.
FRAME = frozenset(("html", "head", "body"))

SPACE = re.compile(r"[ \t\n\r\f]+")
#: Fixed values of the CSS standard: what ``display`` and ``white-space`` can be.
DISPLAYS = frozenset(
    "none block inline inline-block flex inline-flex grid inline-grid table inline-table table-row table-cell "
    "table-row-group table-header-group table-footer-group table-column table-column-group table-caption list-item "
    "flow-root contents run-in ruby initial inherit unset revert revert-layer".split()
)
WHITE_SPACES = frozenset(
    "normal nowrap pre pre-wrap pre-line break-spaces initial inherit unset revert revert-layer".split()
)
DECLARATION = re.compile(r"(?:^|;)\s*([a-z-]+)\s*:\s*([a-z -]+?)\s*(!\s*important\s*)?(?=;|$)", re.I)
#: How white space shows: collapsed, with its line breaks, or as it is.
COLLAPSED, LINES, KEPT = "", "lines", "kept"
KEEPS = {"pre": KEPT, "pre-wrap": KEPT, "break-spaces": KEPT, "pre-line": LINES, "normal": COLLAPSED, "nowrap": COLLAPSED}
#: Stands for a space that is shown as it is (a code point that no text may hold).
SOLID = "\ufdd0"
#: Fields whose value shows; a type that is none of the known ones counts as text.
VALUELESS = frozenset("password checkbox radio range color file image hidden".split())
VISIBILITY = re.compile(
    r"(?:^|;)\s*visibility\s*:\s*(visible|hidden|collapse|initial|inherit|unset|revert)\s*(!\s*important\s*)?(?=;|$)", re.I
)


class Element:
    __slots__ = ("attrs", "children", "foreign", "tag")

    def __init__(self, tag: str, attrs: dict[str, str | None], foreign: str | None = None):
        #: "svg", "text" (of an svg) or "math" for the parts of drawings and formulas
        self.tag, self.attrs, self.foreign = tag, attrs, foreign
        self.children: list[Element | str] = []

    def visible(self) -> bool:
        """Whether the element is there at all; ``seen`` says whether its own text shows."""
        if self.tag in HIDDEN or "hidden" in self.attrs:
            return False
        if self.foreign and (self.tag in UNDRAWN or (self.attrs.get("display") or "").strip().lower() == "none"):
            return False
        if (self.tag == "tr" or self.tag in SECTIONS) and self._visibility() == "collapse":
            return False
        if self.tag == "input" and (self.attrs.get("type") or "").lower() == "hidden":
            return False
        if self.tag == "dialog" and "open" not in self.attrs:
            return False
        return self.declared("display", DISPLAYS) != "none"

    def declared(self, name: str, valid: frozenset[str]) -> str:
        """The value that the ``style`` attribute gives a property: the last valid one, important ones first."""
        style = self.attrs.get("style")
        if not style or name not in style.lower():
            return ""
        found = [(v.lower(), i) for n, v, i in DECLARATION.findall(style) if n.lower() == name]
        found = [(v, i) for v, i in found if v.split()[0] in valid]
        return (next((v for v, i in reversed(found) if i), None) or found[-1][0]) if found else ""

    def keeps(self, around: str) -> str:
        """How white space inside the element shows; inherited from ``around``."""
        if self.tag in PREFORMATTED:
            around = KEPT
        return KEEPS.get(self.declared("white-space", WHITE_SPACES), around)

    def _visibility(self) -> str:
        """The value that is set on this element: the last valid one, important ones first."""
        found = VISIBILITY.findall(self.attrs.get("style") or "")
        if found:
            return (next((v for v, important in reversed(found) if important), None) or found[-1][0]).lower()
        return (self.attrs.get("visibility") or "").strip().lower() if self.foreign else ""

    def seen(self, around: bool) -> bool:
        """Whether the element's own text shows; visibility is inherited from ``around``."""
        if self.foreign and self.tag == "mphantom":
            return False
        if "style" not in self.attrs and not self.foreign:
            return around
        value = self._visibility()
        return value in ("visible", "initial") or (around and value not in ("hidden", "collapse"))


class TreeBuilder(HTMLParser):
    CDATA_CONTENT_ELEMENTS = RAW

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Element("html", {})
        self.open = [self.root]

    def _end(self, tags: tuple[str, ...], scopes: frozenset[str]) -> None:
        """Close the open elements from the outermost of ``tags`` that no scope hides."""
        at = None
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag in tags:
                at = i
            elif self.open[i].tag in scopes or self.open[i].foreign:
                break
        if at:
            del self.open[at:]

    def _back(self, tags: frozenset[str]) -> None:
        """Close what is open inside the innermost of ``tags``, as a table part's start does."""
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag in tags:
                del self.open[i + 1 :]
            elif self.open[i].tag not in CLOSED and self.open[i].tag not in CELLS and not self.open[i].foreign:
                continue
            return

    def _foreign(self, tag: str) -> str | None:
        """The kind that an element started here has if it is part of a drawing or formula."""
        top = self.open[-1]
        if not top.foreign or (top.tag in HTML_INSIDE and tag not in ("mglyph", "malignmark")):
            return tag if tag in ("svg", "math") else None
        if tag == "svg" or (top.foreign != "math" and tag not in ("text", "foreignobject")):
            return "svg" if tag == "svg" else top.foreign
        return "math" if top.foreign == "math" else "text"

    def handle_starttag(self, tag, attrs):
        if tag in BREAKOUT or (tag == "font" and not {"color", "face", "size"}.isdisjoint(dict(attrs))):
            while self.open[-1].foreign and self.open[-1].tag not in HTML_INSIDE:
                self.open.pop()
        if tag in FRAME:
            return
        if self.open[-1].tag == "colgroup" and tag not in ("col", "template"):
            self.open.pop()
        if foreign := self._foreign(tag):
            self._push(Element(tag, dict(attrs), foreign))
            return
        if tag == "form" and self.open[-1].tag in PARTS:
            return  # a form cannot hold rows or cells, and shows nothing itself
        if tag in ENDS_P:
            self._end(("p",), SCOPES | CELLS | {"li"})
        if tag in SIBLINGS:
            self._end(SIBLINGS[tag], SCOPES if tag not in CELLS and tag != "tr" and tag not in SECTIONS else frozenset(("table",)))
        if tag in CELLS:
            self._back(PARTS)
            if self.open[-1].tag in ("table", *SECTIONS):
                self._push(Element("tr", {}))
        elif tag == "tr" or tag in SECTIONS:
            self._back(PARTS if tag == "tr" else frozenset(("table",)))
        child = Element(tag, dict(attrs))
        if tag == "plaintext":
            self.set_cdata_mode("plaintext-that-never-ends")
        if tag in VOID:
            self.open[-1].children.append(child)
        else:
            self._push(child)

    def _push(self, child: Element) -> None:
        if len(self.open) >= DEPTH:
            self.open.pop()
        self.open[-1].children.append(child)
        self.open.append(child)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if self.open[-1].foreign and self.open[-1].tag == tag:
            self.open.pop()

    def handle_endtag(self, tag):
        if tag in FRAME:
            return
        if tag == "br":
            self.open[-1].children.append(Element("br", {}))
            return
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                del self.open[i:]
                return
            if (self.open[i].tag in CELLS or self.open[i].tag == "table") and tag not in THROUGH:
                return
            if self.open[i].foreign and self.open[i].tag == "foreignobject" and (tag in BLOCKS or tag in PARAGRAPHS):
                return

    def close(self):
        if self.rawdata.startswith("<!--"):  # a comment that never ends hides the rest
            self.rawdata = ""
        super().close()
        if self.rawdata and self.open[-1].tag in PREFORMATTED:  # text that its end tag never ends
            self.open[-1].children.append(self.rawdata)
            self.rawdata = ""

    def handle_data(self, data):
        if self.open[-1].tag == "colgroup" and data.strip():
            self.open.pop()
        if self.open[-1].foreign != "svg":  # a drawing shows the strings of its texts only
            self.open[-1].children.append(data)

    def unknown_decl(self, data):
        if data.startswith("CDATA[") and self.open[-1].foreign:
            self.handle_data(data[6:])


def parse(html: str) -> Element:
    builder = TreeBuilder()
    builder.feed(html)
    builder.close()
    return builder.root


class Writer:
    """Lines of one flow: collapses white space, keeps at most one blank line."""

    def __init__(self):
        self.lines: list[str] = []
        self.inline: list[str] = []
        self.gap = False

    def text(self, data: str, keeps: str = COLLAPSED) -> None:
        if keeps == COLLAPSED:
            self.inline.append(SPACE.sub(" ", data))
            return
        for i, line in enumerate(data.replace("\r\n", "\n").split("\n")):
            if i:
                self.breaks()
            self.inline.append(line.replace(" ", SOLID) if keeps == KEPT else SPACE.sub(" ", line))

    def breaks(self) -> None:
        """A line break: ends the line, or leaves a blank one."""
        if "".join(self.inline).strip(" " + SOLID):
            self.flush()
        else:
            self.inline = []
            self.gap = bool(self.lines)

    def flush(self) -> None:
        line = re.sub(" +", " ", "".join(self.inline)).strip(" ").replace(SOLID, " ").rstrip(" ")
        self.inline = []
        if line:
            self.line(line)

    def line(self, line: str) -> None:
        if self.gap and self.lines:
            self.lines.append("")
        self.gap = False
        self.lines.append(line)

    def paragraph(self) -> None:
        self.flush()
        self.gap = True

    def nest(self, lines: list[str], first: str, rest: str) -> None:
        for i, line in enumerate(lines):
            self.line(((first if i == 0 else rest) + line).rstrip() if line else "")


def _chosen(node: Element) -> list[Element | str]:
    """The children that can show: the first that fits of svg's switch and of math's maction,
    the summary of closed details."""
    if node.tag == "details" and not node.foreign and "open" not in node.attrs:
        return [c for c in node.children if isinstance(c, Element) and c.tag == "summary"][:1]
    if not node.foreign or node.tag not in ("switch", "maction"):
        return node.children
    parts = [c for c in node.children if isinstance(c, Element)]
    if node.tag == "switch":
        needs = ("", "http://www.w3.org/1999/xhtml", "http://www.w3.org/1998/math/mathml")
        fit = [
            c
            for c in parts
            if "systemlanguage" not in c.attrs and (c.attrs.get("requiredextensions") or "").strip().lower() in needs
        ]
        parts = fit or parts
    return list(parts[:1])


def _integer(text: str | None) -> int | None:
    """The number that an attribute begins with, if any."""
    found = re.match(r"[ \t\n\f\r]*([+-]?[0-9]{1,9})", text or "")
    return int(found[1]) if found else None


def _numbering(node: Element) -> tuple[int, int]:
    """The number of a list's first item, and the step to the next."""
    backwards = node.tag == "ol" and "reversed" in node.attrs
    first = _integer(node.attrs.get("start")) if node.tag == "ol" else None
    if first is None:
        items = [c for c in node.children if isinstance(c, Element) and c.tag == "li" and c.visible()]
        first = len(items) if backwards else 1
    return first, -1 if backwards else 1


def _field(child: Element) -> str:
    """What an image or a field shows."""
    kind = (child.attrs.get("type") or "").strip().lower()
    if child.tag == "img" or kind == "image":
        return child.attrs.get("alt") or ""
    return "" if kind in VALUELESS else child.attrs.get("value") or ""


def render(node: Element, out: Writer, listed: int = 0, seen: bool = True, keeps: str = COLLAPSED) -> None:
    """Write the children of ``node``; ``listed`` is the depth of lists around it, ``seen``
    whether its own text shows, and ``keeps`` how its white space does."""
    number, step = _numbering(node) if node.tag == "ol" else (1, 1)
    for child in _chosen(node):
        if isinstance(child, str):
            if seen:
                out.text(child, keeps)
            continue
        if not child.visible():
            continue
        tag, shows, kept = child.tag, child.seen(seen), child.keeps(keeps)
        if child.foreign:
            block = tag == "math" and (child.attrs.get("display") or "").lower() == "block"
            apart = tag in APART or node.tag == "mfrac" or (tag == "tspan" and not {"x", "y"}.isdisjoint(child.attrs))
            out.flush() if block else out.text(" " if apart else "")
            render(child, out, listed, shows, kept)
            out.flush() if block else out.text(" " if apart else "")
            continue
        if tag == "br":
            out.breaks()
            continue
        if tag in ("img", "input"):
            shown = _field(child)
            out.text(f" {shown} " if shown and shows else "")
            continue
        if tag in PREFORMATTED and kept == KEPT:
            out.paragraph()
            whole = "".join(strings(child, shows)).replace(SOLID, " ")
            for line in whole.strip("\n").split("\n") if whole.strip() else ():
                out.line(line.rstrip())
            out.paragraph()
        elif tag == "table":
            out.paragraph()
            for line in table(child, listed, shows, kept):
                out.line(line)
            out.paragraph()
        elif tag == "li":
            out.flush()
            inner = Writer()
            render(child, inner, listed, shows, kept)
            inner.flush()
            own = _integer(child.attrs.get("value")) if node.tag == "ol" else None
            number = number if own is None else own
            mark = f"{number}. " if node.tag == "ol" else "- "
            mark = mark if shows else " " * len(mark)
            number += step
            if inner.lines:
                out.nest(inner.lines, mark, " " * len(mark))
        elif tag in ("ul", "ol", "menu", "dir"):
            out.flush() if listed else out.paragraph()
            render(child, out, listed + 1, shows, kept)
            out.flush() if listed else out.paragraph()
        elif tag in ("blockquote", "dd"):
            out.paragraph() if tag == "blockquote" else out.flush()
            inner = Writer()
            render(child, inner, listed, shows, kept)
            inner.flush()
            out.nest(inner.lines, "  ", "  ")
            if tag == "blockquote":
                out.paragraph()
        elif tag in PARAGRAPHS or tag == "hr":
            out.paragraph()
            render(child, out, listed, shows, kept)
            out.paragraph()
        elif tag in BLOCKS:
            out.flush()
            render(child, out, listed, shows, kept)
            out.flush()
        elif tag in CELLS:
            out.text(" ")
            render(child, out, listed, shows, kept)
            out.text(" ")
        else:
            render(child, out, listed, shows, kept)


def strings(node: Element, seen: bool = True) -> Iterator[str]:
    for child in _chosen(node):
        if isinstance(child, str):
            if seen:
                yield child
        elif child.tag == "br":
            yield "\n"
        elif child.visible():
            yield from strings(child, child.seen(seen))


def _shown_order(node: Element) -> list[Element]:
    """A table's parts as they are shown: the first thead on top, the first tfoot at the bottom."""
    parts = [c for c in node.children if isinstance(c, Element) and c.visible()]
    head = next((c for c in parts if c.tag == "thead"), None)
    foot = next((c for c in parts if c.tag == "tfoot"), None)
    middle = [c for c in parts if c is not head and c is not foot]
    return [c for c in (head, *middle, foot) if c is not None]


def _rows(node: Element, seen: bool) -> Iterator[tuple[Element, bool]]:
    for child in _shown_order(node) if node.tag == "table" else node.children:
        if isinstance(child, Element) and child.visible():
            if child.tag == "tr":
                yield child, child.seen(seen)
            elif child.tag in SECTIONS:
                yield from _rows(child, child.seen(seen))


def _strays(node: Element, seen: bool) -> Iterator[tuple[Element | str, bool]]:
    """What of a table and its sections is neither a row nor a section, and whether its text shows."""
    for child in node.children:
        if isinstance(child, str):
            yield child, seen
        elif child.tag in SECTIONS:
            if child.visible():
                yield from _strays(child, child.seen(seen))
        elif child.tag != "tr":
            yield child, seen


def _span(cell: Element, name: str) -> int:
    value = cell.attrs.get(name) or ""
    return min(max(int(value), 1), 1000) if value.isascii() and value.isdecimal() and len(value) < 6 else 1


def table(node: Element, listed: int, seen: bool = True, keeps: str = COLLAPSED) -> list[str]:
    """Rows with columns padded to their widest cell; text outside cells comes first."""
    stray = Writer()
    for child, shows in _strays(node, seen):
        if isinstance(child, str):
            stray.text(child if shows else "")
        elif child.visible():
            holder = Element("div", {})
            holder.children = [child]
            render(holder, stray, listed, shows, keeps)
            stray.flush()
    stray.flush()
    grid: list[dict[int, tuple[list[str], int]]] = []
    busy: dict[int, int] = {}  # column -> rows it is still taken by a cell above
    for row, shows in _rows(node, seen):
        cells: dict[int, tuple[list[str], int]] = {}
        column, taken = 0, {c for c, n in busy.items() if n > 0}
        busy = {c: n - 1 for c, n in busy.items() if n > 1}
        for cell in row.children:
            if isinstance(cell, str) and not cell.strip():
                continue
            if isinstance(cell, Element) and not cell.visible():
                continue
            while column in taken:
                column += 1
            holder, inner = Element("td", {}), Writer()
            is_cell = isinstance(cell, Element) and cell.tag in CELLS
            holder.children = cell.children if is_cell else [cell]
            shown, kept = (cell.seen(shows), cell.keeps(row.keeps(keeps))) if is_cell else (shows, row.keeps(keeps))
            render(holder, inner, listed, shown, kept)
            inner.flush()
            if not is_cell and not inner.lines:
                continue
            wide = _span(cell, "colspan") if is_cell else 1
            cells[column] = (inner.lines or [""], wide)
            if is_cell and (deep := _span(cell, "rowspan")) > 1:
                busy |= dict.fromkeys(range(column, column + wide), deep - 1)
            column += wide
        grid.append(cells)
    n = max((c + w for cells in grid for c, (_, w) in cells.items()), default=0)
    width = [0] * n
    for cells in grid:
        for c, (lines, wide) in cells.items():
            if wide == 1:
                width[c] = max(width[c], *map(len, lines))
    out = stray.lines
    for cells in grid:
        for k in range(max((len(lines) for lines, _ in cells.values()), default=0)):
            line, c = "", 0
            while c < n:
                lines, wide = cells.get(c, ([], 1))
                room = sum(width[c : c + wide]) + 2 * (wide - 1)
                line += (lines[k] if k < len(lines) else "").ljust(room) + "  "
                c += wide
            if line.strip():
                out.append(line.rstrip())
    return out


def visible_text(html: str) -> str:
    out = Writer()
    render(parse(html), out)
    out.flush()
    return "\n".join(out.lines)


def extract_text(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """(id, text) of every page, whole pages whatever their length.

    Null or empty html gives empty text; repeated rows and ids repeat; an
    empty table gives an empty result; further columns are ignored. What is
    rendered and what is not is said at the top of this module.
    """
    bound_batches(pages.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch["text"] = [visible_text(h or "") for h in batch["__html"]]
            yield batch[[id_col, "text"]]

    kind = pages.schema[id_col].dataType.simpleString()
    return pages.select(id_col, F.col(html_col).alias("__html")).mapInPandas(run, f"`{id_col}` {kind}, text string")
