"""HTML extraction by layout: a tree with implied tags, then all visible text as it would be laid out.

Tags become a tree. Elements whose end tag may be left out (list items, cells, rows, paragraphs,
options, terms) are closed by what follows them, and a cell outside a row opens one. What is not shown
(head, scripts, styles, templates, ``hidden``, ``display:none``, closed ``details``) is left out.
Blocks start on lines of their own; paragraphs, headings, lists, tables and quotes keep a blank line
around them. List items have their marks or numbers and are indented by depth; table cells are aligned
in columns. ``pre`` keeps its spaces and line breaks.

Null, empty and markup-only pages give an empty text. Broken markup never fails: an unfinished tag is
text, an unfinished comment or script hides the rest. Elements nested deeper than ``DEPTH`` become
children of the element at that depth. Columns are at most ``WIDE`` wide: longer lines are broken between
words, except in a table's last column, and a longer word has the rest of its line to itself. A line has
at most ``WIDE`` blanks for each column before its text. Repeated rows are each rendered.
"""

from __future__ import annotations

import html
import re
import textwrap

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygrove.llm.text import bounded_batches

DEPTH = 200
WIDE = 60
SPANS = 100
TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|[^<]++|<""",
    re.S,
)
ATTRIBUTE = re.compile(r"""([^\s=/"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
CONCEALED = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
BLANK = re.compile(r"[ \t\n\r\f]+")


def _set(names: str) -> frozenset[str]:
    return frozenset(names.split())


# Element names of the HTML standard by their part in parsing and layout.
VOID = _set("area base br col embed hr img input link meta param source track wbr")
RAW = _set("script style textarea title")
UNSEEN = _set("head script style template noscript title datalist audio video canvas iframe object svg")
SPACED = _set("p h1 h2 h3 h4 h5 h6 ul ol dl table blockquote pre figure fieldset")
BLOCK = SPACED | _set(
    "html body div section article aside header footer main nav address form li dt dd hr details summary "
    "figcaption caption legend center dialog option optgroup menu tr td th thead tbody tfoot"
)
ENDS_PARAGRAPH = BLOCK - _set("tr td th thead tbody tfoot caption option optgroup html body")
CLOSED_BY = {
    "li": _set("li"),
    "dt": _set("dt dd"),
    "dd": _set("dt dd"),
    "tr": _set("tr td th"),
    "td": _set("td th"),
    "th": _set("td th"),
    "thead": _set("thead tbody tfoot tr td th caption"),
    "tbody": _set("thead tbody tfoot tr td th caption"),
    "tfoot": _set("thead tbody tfoot tr td th caption"),
    "option": _set("option"),
    "optgroup": _set("option optgroup"),
    "body": _set("head"),
}
# An implied end tag does not reach beyond these.
LIMITS = {
    "li": _set("ul ol menu table td th"),
    "dt": _set("dl table td th"),
    "dd": _set("dl table td th"),
    "option": _set("select datalist"),
    "optgroup": _set("select"),
}
TABLE_PART = _set("tr td th thead tbody tfoot")
IN_HEAD = _set("head title meta link script style base template noscript")


class Element:
    __slots__ = ("name", "attributes", "children")

    def __init__(self, name: str, attributes: dict[str, str]):
        self.name, self.attributes = name, attributes
        self.children: list[Element | str] = []

    def number(self, name: str, otherwise: int) -> int:
        found = self.attributes.get(name, "").strip()
        return int(found) if found.isascii() and found.isdigit() and len(found) < 9 else otherwise

    @property
    def shown(self) -> bool:
        a = self.attributes
        if self.name in UNSEEN or "hidden" in a or (self.name == "dialog" and "open" not in a):
            return False
        return not ("style" in a and CONCEALED.search(a["style"]))


def attributes(source: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, value in ATTRIBUTE.findall(source):
        if value[:1] in "\"'" and value:
            value = value[1:-1]
        found.setdefault(name.lower(), html.unescape(value))
    return found


def _close(open_: list[Element], names: frozenset[str], limits: frozenset[str]) -> None:
    """End the innermost element of ``names`` and what it holds, unless a limit lies between."""
    for i in range(len(open_) - 1, 0, -1):
        if open_[i].name in names:
            del open_[i:]
            return
        if open_[i].name in limits:
            return


def _end_limits(name: str) -> frozenset[str]:
    """What an end tag does not reach beyond."""
    if name in ("table", "body"):
        return frozenset()
    return _TABLE if name in TABLE_PART or name == "caption" else _OUTER


def tree(source: str) -> Element:
    root = Element("html", {})
    open_ = [root]
    at, size, last = 0, len(source), source.rfind(">")
    while at < size:
        if at > last:  # no tag ends here any more, so none is looked for
            token = source[at:].split("<!--", 1)[0]
            if open_[-1].name == "head" and token and not token.isspace():
                open_.pop()
            open_[-1].children.append(html.unescape(token))
            break
        m = TOKEN.match(source, at)
        at = m.end()
        slash, name, rest = m.groups()
        if name is None:
            token = m.group()
            if token[0] != "<" or token == "<":
                if open_[-1].name == "head" and not token.isspace():
                    open_.pop()
                open_[-1].children.append(html.unescape(token) if "&" in token else token)
            continue
        name = name.lower()
        if slash:
            _close(open_, frozenset((name,)), _end_limits(name))
            continue
        if name == "html" or (name == "body" and any(e.name == "body" for e in open_)):
            continue
        if name not in IN_HEAD:
            _close(open_, _HEAD, frozenset())
        if name in ENDS_PARAGRAPH:
            _close(open_, _P, _P_LIMITS)
        closes = CLOSED_BY.get(name)
        if closes:
            limits = LIMITS.get(name, _TABLE)
            for _ in range(3):  # cell, row, group
                _close(open_, closes, limits)
        if name in ("td", "th") and open_[-1].name in ("table", "thead", "tbody", "tfoot"):
            row = Element("tr", {})
            open_[-1].children.append(row)
            open_.append(row)
        element = Element(name, attributes(rest) if rest else {})
        open_[-1].children.append(element)
        if name in RAW:
            end = _ENDS[name].search(source, at)
            if name == "textarea":
                element.children.append(html.unescape(source[at : end.start() if end else size]))
            at = end.end() if end else size
        elif name not in VOID and len(open_) < DEPTH:
            open_.append(element)
    return root


_HEAD = _set("head")
_P, _P_LIMITS = _set("p"), _set("table td th caption button object")
_TABLE = _set("table")
_OUTER = _set("table td th")
_ENDS = {name: re.compile(rf"</{name}\b[^>]*+>", re.I) for name in RAW}


class Flow:
    """Lines under construction; blanks collapse, blocks stand apart."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.line = ""
        self.blank = False  # a collapsed blank that is due before the next word
        self.gap = False  # a blank line that is due before the next line

    def text(self, words: str) -> None:
        flat = BLANK.sub(" ", words)
        if not flat:
            return
        if flat == " ":
            self.blank = self.blank or bool(self.line)
            return
        if (self.blank or flat[0] == " ") and self.line:
            self.line += " "
        self.line += flat.strip(" ")
        self.blank = flat[-1] == " "

    def keep(self, words: str) -> None:
        """Text with its blanks and line breaks."""
        first, *others = words.split("\n")
        self.line += first
        for other in others:
            self.end(True)
            self.line = other
        self.blank = False

    def end(self, always: bool = False) -> None:
        if self.line or always:
            self._put(self.line)
        self.line, self.blank = "", False

    def _put(self, line: str) -> None:
        if self.gap and self.lines:
            self.lines.append("")
        self.gap = False
        self.lines.append(line.rstrip())

    def block(self, lines: list[str], spaced: bool) -> None:
        self.end()
        if not lines:
            return
        self.gap = self.gap or spaced
        for line in lines:
            self._put(line)
        self.gap = spaced


def _fill(flow: Flow, element: Element, pre: bool, depth: int) -> None:
    number = element.number("start", 1)
    closed = element.name == "details" and "open" not in element.attributes
    for child in element.children:
        if isinstance(child, str):
            if not closed:
                (flow.keep if pre else flow.text)(child)
            continue
        name = child.name
        if not child.shown or (closed and name != "summary"):
            continue
        if name == "br":
            flow.end(True)
        elif name == "table":
            flow.block(_table(child, depth), True)
        elif name == "li":
            mark = "- "
            if element.name == "ol":
                number = child.number("value", number)
                mark, number = f"{number}. ", number + 1
            lines = render(child, pre, depth + 1)
            indent = " " * len(mark)
            marked = [mark + lines[0], *(indent + x if x else "" for x in lines[1:])] if lines else []
            flow.block(marked, False)
        elif name in ("dd", "blockquote"):
            lines = render(child, pre, depth + 1)
            flow.block(["  " + x if x else "" for x in lines], name in SPACED)
        elif name in BLOCK:
            inner = name in ("ul", "ol") and element.name == "li"
            flow.block(render(child, pre or name == "pre", depth + 1), name in SPACED and not inner)
        else:
            _fill(flow, child, pre, depth)


def render(element: Element, pre: bool = False, depth: int = 0) -> list[str]:
    flow = Flow()
    _fill(flow, element, pre, depth)
    flow.end()
    lines = flow.lines
    while lines and not lines[-1]:
        lines.pop()
    while lines and not lines[0]:
        lines.pop(0)
    return lines


def _parts(element: Element, rows: list[list[Element]], row: list[Element] | None = None) -> list[Element | str]:
    """Cells into ``rows``, through whatever wraps them; what is in no cell comes back, as it is laid
    out before the table. A cell outside a row opens one."""
    stray: list[Element | str] = []
    for child in element.children:
        if isinstance(child, str):
            stray.append(child)
            continue
        if not child.shown:
            continue
        if child.name in ("td", "th"):
            if row is None:
                row = []
                rows.append(row)
            row.append(child)
            stray.append(" ")
            continue
        if child.name in VOID or child.name in ("table", "details"):
            stray.append(child)
            continue
        own = row
        if child.name == "tr":
            own = []
            rows.append(own)
        rest = Element("div" if child.name in TABLE_PART else child.name, child.attributes)
        rest.children = _parts(child, rows, own)
        stray.append(rest)
        if child.name in TABLE_PART:
            row = None
    return stray


def _table(element: Element, depth: int) -> list[str]:
    """Captions and stray content, then the rows with their cells in columns."""
    rows: list[list[Element]] = []
    stray = Element("div", {})
    stray.children = _parts(element, rows)
    above = render(stray, False, depth + 1)
    grid: list[list[tuple[int, int, list[str]]]] = []
    held: dict[int, int] = {}  # column to the number of rows it is still taken
    widths: dict[int, int] = {}
    for row in rows:
        cells, column, taken = [], 0, {c: n - 1 for c, n in held.items() if n > 1}
        for cell in row:
            while column in held:
                column += 1
            lines = render(cell, False, depth + 1)
            span = min(max(cell.number("colspan", 1), 1), SPANS)
            cells.append((column, span, lines))
            if span == 1:
                widths[column] = max(widths.get(column, 0), min(max(map(len, lines), default=0), WIDE))
            down = min(max(cell.number("rowspan", 1), 1), SPANS)
            if down > 1:
                taken.update((c, down - 1) for c in range(column, column + span))
            column += span
        held = taken
        grid.append(cells)
    end = max((at + span for cells in grid for at, span, _ in cells), default=0)

    def width(at: int, span: int) -> int:
        return sum(widths.get(c, 0) for c in range(at, at + span)) + 2 * (span - 1)

    for cells in grid:
        for at, span, lines in cells:
            if span > 1 and at + span < end:
                more = min(max(map(len, lines), default=0), WIDE) - width(at, span)
                if more > 0:
                    widths[at + span - 1] = widths.get(at + span - 1, 0) + more
    out = list(above)
    for cells in grid:
        full: set[int] = set()  # lines that a word wider than its column fills to the end
        fitted = []
        for at, span, lines in cells:
            own = width(at, span)
            # Nothing is aligned after the last column.
            fitted.append((at, span, own, _fit(lines, own if at + span < end else None, full)))
        height = max((len(lines) for *_, lines in fitted), default=0)
        for i in range(height):
            parts, column = [], 0
            for at, span, own, lines in fitted:
                parts += [" " * widths.get(c, 0) for c in range(column, at)]
                parts.append((lines[i] if i < len(lines) else "").ljust(own))
                column = at + span
            out.append("  ".join(parts).rstrip())
    return out if any(out) else []


def _fit(lines: list[str], width: int | None, full: set[int]) -> list[str]:
    """The lines broken between words at ``width``, on lines that are not ``full``.

    A word that is wider stays whole and fills its line, so what comes after it goes to later ones.
    """
    out: list[str] = []
    before = set(full)
    for line in lines:
        for part in [line] if width is None or len(line) <= width else _broken(line, width):
            while len(out) in before:
                out.append("")
            if width is not None and len(part) > width:
                full.add(len(out))
            out.append(part)
    return out


def _broken(line: str, width: int) -> list[str]:
    return textwrap.wrap(
        line, max(width, 1), expand_tabs=False, replace_whitespace=False, break_long_words=False, break_on_hyphens=False
    )


def visible_text(source: str | None) -> str:
    if not source:
        return ""
    lines = render(tree(source.replace("\r\n", "\n").replace("\x00", "")))
    return "\n".join(lines).replace("\xa0", " ")


def rendered(pages: DataFrame, html_column: str = "html", into: str = "text") -> DataFrame:
    """All columns and the visible text; a column of that name is replaced."""
    bounded_batches(pages)

    def every(sources: pd.Series) -> pd.Series:
        return pd.Series([visible_text(s) for s in sources], dtype=object)

    return pages.withColumn(into, F.pandas_udf(every, "STRING").asNondeterministic()(html_column))
