"""Visible text of HTML pages, laid out as a browser would.

A tree builder reads tags and text in one pass and adds what authors leave out: an open
paragraph ends where a block begins, list items, table rows and cells end where the next
begins, rows get their table body. Elements that no browser shows (scripts, styles,
templates, ``hidden``, ``display:none``, the inside of closed ``details``) are dropped.
The renderer then walks the tree without recursion: blocks start lines, paragraphs and
headings stand apart by a blank line, list items carry bullets or numbers (``start``,
``value`` and ``reversed`` count) and indents, preformatted text keeps its spaces. Rules of
``<style>`` elements with a tag, class or id alone decide on ``display:none`` and
``visibility`` like inline styles; what is visible inside an invisible parent is shown.

Cells of a table stand on a grid: spans over columns and rows keep their places, a column is
as wide as its widest cell (characters that take two columns count twice), a row as high as
its tallest. A table around other tables is taken for page layout, and its cells stand one
below the other.

Nulls: a null page gives a null text; an empty one an empty text; very long ones are parsed
whole. Text without tags is text. Broken markup never fails: unknown end tags are ignored,
open elements end with the page. Repeated rows get equal texts, and an empty table gives no
rows. Columns other than id and page are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape
from unicodedata import combining, east_asian_width

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirframe.llm.batches import slices

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/<>]*+)((?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+)>", re.DOTALL
)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
SPACES = re.compile(r"[ \t\n\r\f]+")
STYLE = re.compile(r"(display|visibility)\s*:\s*([a-z-]+)", re.IGNORECASE)
RULE = re.compile(r"@[^{};]*(?:;|\{(?:[^{}]*\{[^{}]*\})*[^{}]*\})|([^{}@]+)\{([^{}]*)\}")
COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)", re.DOTALL)
SELECTOR = re.compile(r"([a-zA-Z][a-zA-Z0-9]*)?((?:[.#][\w-]+)*)\Z")
# Element names by role, as the HTML standard has them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
UNSEEN = frozenset(
    "head title meta link script style template noscript iframe object audio video canvas math datalist noembed"
    " noframes area base param source track defs desc symbol clippath mask pattern metadata".split()
)
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer"
    " form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre search section summary"
    " table tbody td tfoot th thead tr ul caption".split()
)
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl menu dir table blockquote pre figure hr".split())
LISTS = frozenset("ul ol menu dir".split())
ENDS_PARAGRAPH = BLOCKS - frozenset("body html td th tr tbody thead tfoot caption option legend summary".split())
#: What a start tag ends, if it is open, and what bounds the search for it.
ENDS = {
    "li": ({"li"}, LISTS),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "td": ({"td", "th"}, {"table"}),
    "th": ({"td", "th"}, {"table"}),
    "tr": ({"tr"}, {"table"}),
    "tbody": ({"tbody", "thead", "tfoot", "caption"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot", "caption"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "caption"}, {"table"}),
}
CELL_GAP = "  "


class Node:
    __slots__ = ("attributes", "children", "style", "tag")

    def __init__(self, tag: str, attributes: dict[str, str]) -> None:
        self.tag = tag
        self.attributes = attributes
        self.children: list[Node | str] = []
        #: Of the root: the page's style sheets.
        self.style = ""


class Sheet:
    """Rules of one tag, classes and ids, under the rarest of their names."""

    def __init__(self, source: str) -> None:
        self.rules: dict[str, list[tuple]] = {}
        for order, (selectors, body) in enumerate(RULE.findall(COMMENT.sub("", source))):
            found = {name.lower(): value.lower() for name, value in STYLE.findall(body)}
            if not found:
                continue
            for selector in selectors.split(","):
                match = SELECTOR.match(selector.strip())
                if match is None or not match.group():
                    continue
                tag, names = (match.group(1) or "").lower(), re.findall(r"[.#][\w-]+", match.group(2))
                weight = (sum(name[0] == "#" for name in names), len(names), bool(tag), order)
                self.rules.setdefault(names[0] if names else tag, []).append((weight, tag, frozenset(names), found))

    def of(self, node: Node) -> dict[str, str]:
        """Display and visibility that the rules and the inline style give a node."""
        found: dict[str, str] = {}
        if self.rules:
            names = {f".{name}" for name in node.attributes.get("class", "").split()}
            if "id" in node.attributes:
                names.add(f"#{node.attributes['id']}")
            fitting = [rule for key in (node.tag, *names) for rule in self.rules.get(key, ()) if rule[1] in ("", node.tag) and rule[2] <= names]
            for rule in sorted(fitting, key=lambda rule: rule[0]):
                found |= rule[3]
        if "style" in node.attributes:
            found |= {name.lower(): value.lower() for name, value in STYLE.findall(node.attributes["style"])}
        return found


def _attributes(source: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, double, single, bare in ATTRIBUTE.findall(source):
        found.setdefault(name.lower(), unescape(double or single or bare))
    return found


def build(page: str) -> Node:
    """Tree of a page, with implied ends and table parts."""
    root = Node("html", {})
    open_nodes = [root]
    open_tags = Counter(["html"])

    def close(names: set[str] | frozenset[str], bounds: set[str] | frozenset[str]) -> None:
        if not any(open_tags[name] for name in names):
            return
        for at in range(len(open_nodes) - 1, 0, -1):
            tag = open_nodes[at].tag
            if tag in names:
                open_tags.subtract(node.tag for node in open_nodes[at:])
                del open_nodes[at:]
                return
            if tag in bounds:
                return

    def start(tag: str, attributes: dict[str, str]) -> None:
        if tag in ENDS_PARAGRAPH:
            close({"p"}, {"td", "th", "table", "button"})
        if tag in ENDS:
            close(*ENDS[tag])
        if tag == "tr" and open_nodes[-1].tag == "table":
            start("tbody", {})
        if tag in ("td", "th") and open_nodes[-1].tag in ("table", "tbody", "thead", "tfoot"):
            start("tr", {})
        node = Node(tag, attributes)
        open_nodes[-1].children.append(node)
        if tag not in VOID:
            open_nodes.append(node)
            open_tags[tag] += 1

    at, size, lowered = 0, len(page), None
    while at < size:
        match = TAG.search(page, at)
        if match is None:
            open_nodes[-1].children.append(unescape(page[at:]))
            break
        if match.start() > at:
            open_nodes[-1].children.append(unescape(page[at : match.start()]))
        at = match.end()
        slash, name, source = match.group(1), match.group(2), match.group(3)
        if name is None:
            continue
        tag = name.lower()
        if slash:
            if tag == "br":
                start("br", {})
            elif tag == "table":
                close({tag}, set())
            elif tag not in VOID:
                close({tag}, {"table"} if tag in BLOCKS else {"td", "th", "table"})
            continue
        if tag in ("html", "body"):
            if tag == "body":
                close({"head"}, set())
            root.attributes.update(_attributes(source))
            continue
        start(tag, _attributes(source) if source and not source.isspace() else {})
        if tag in RAW:
            lowered = page.lower() if lowered is None else lowered
            end = lowered.find(f"</{tag}", at)
            if len(lowered) != size:
                found = re.compile(f"</{tag}", re.IGNORECASE).search(page, at)
                end = found.start() if found else -1
            end = size if end < 0 else end
            raw = page[at:end]
            open_nodes[-1].children.append(unescape(raw) if tag in ("textarea", "title") else raw)
            if tag == "style":
                root.style += f"{raw}\n"
            at = end
    return root


def rendered(node: Node, style: dict[str, str]) -> bool:
    if node.tag in UNSEEN or "hidden" in node.attributes:
        return False
    if node.tag == "input":
        return node.attributes.get("type", "").lower() in ("submit", "button", "reset")
    return style.get("display") != "none"


class Flow:
    """Lines of one block container."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.line: list[str] = []
        self.space = False
        self.blank = False
        self.indents: list[str] = []
        self.marker: str | None = None

    def text(self, value: str) -> None:
        words = SPACES.split(value)
        if words[0] == "" and self.line:
            self.space = True
        words = [word for word in words if word]
        if not words:
            return
        self._begin()
        self.line.append((" " if self.space else "") + " ".join(words))
        self.space = value[-1] in " \t\n\r\f"

    def _begin(self) -> None:
        if self.line:
            return
        if self.blank and self.lines and self.lines[-1]:
            self.lines.append("")
        self.blank = self.space = False
        if self.marker is not None:
            self.line.append("".join(self.indents[:-1]) + self.marker)
            self.marker = None
        else:
            self.line.append("".join(self.indents))

    def exact(self, value: str) -> None:
        """Preformatted text: its spaces and lines stay."""
        first, *others = value.split("\n")
        for k, part in enumerate([first, *others]):
            if k:
                self.end_line(keep_empty=True)
            if part:
                self._begin()
                self.line.append(part)

    def end_line(self, keep_empty: bool = False) -> None:
        if self.line:
            self.lines.append("".join(self.line).rstrip())
            self.line = []
        elif keep_empty and self.lines:
            self.lines.append("")
        self.space = False

    def apart(self, spaced: bool) -> None:
        self.end_line()
        self.blank = self.blank or spaced

    def block(self, lines: list[str]) -> None:
        for line in lines:
            self.end_line()
            self._begin()
            self.line.append(line)
        self.end_line()

    def result(self) -> list[str]:
        self.end_line()
        while self.lines and not self.lines[-1]:
            self.lines.pop()
        return self.lines


def width_of(text: str) -> int:
    """Columns that a text takes: two for wide characters, none for combining ones."""
    if text.isascii():
        return len(text)
    return sum(0 if combining(char) else 2 if east_asian_width(char) in "WF" else 1 for char in text)


class Table:
    def __init__(self) -> None:
        self.rows: list[list[tuple[list[str], int, int]]] = []
        self.is_layout = False

    def _placed(self) -> list[tuple[int, int, int, int, list[str]]]:
        """Row, column, spans and lines of every cell; places taken from above are passed over whole."""
        placed = []
        # For each column, the first row that no cell from above reaches.
        free: dict[int, int] = {}
        for row, cells in enumerate(self.rows):
            column = 0
            for lines, across, down in cells:
                while taken := [c for c in range(column, column + across) if free.get(c, 0) > row]:
                    column = taken[-1] + 1
                down = min(down or len(self.rows), len(self.rows) - row)
                for c in range(column, column + across):
                    free[c] = row + down
                placed.append((row, column, down, across, lines))
                column += across
        return placed

    def lines(self) -> list[str]:
        """Aligned rows; or, of a layout table, the cells' lines one below the other."""
        if self.is_layout:
            return [line for row in self.rows for cell, _, _ in row for line in cell]
        placed = [cell for cell in self._placed() if cell[4]]
        widths: dict[int, int] = {}
        heights = [0] * len(self.rows)
        gap = len(CELL_GAP)
        sizes = [max(map(width_of, lines)) for *_, lines in placed]
        for (row, column, down, across, lines), size in zip(placed, sizes, strict=True):
            if across == 1:
                widths[column] = max(widths.get(column, 0), size)
            if down == 1:
                heights[row] = max(heights[row], len(lines))
        # What does not fit into its spans makes their last column wider, their last row higher.
        for (row, column, down, across, lines), size in zip(placed, sizes, strict=True):
            if across > 1:
                room = sum(widths.get(c, 0) for c in range(column, column + across)) + gap * (across - 1)
                widths[column + across - 1] = widths.get(column + across - 1, 0) + max(0, size - room)
            if down > 1:
                heights[row + down - 1] += max(0, len(lines) - sum(heights[row : row + down]))
        starts, at = {}, 0
        for column in range(max((column for _, column, _, _, _ in placed), default=-1) + 1):
            starts[column] = at
            at += widths.get(column, 0) + gap
        tops, top = [], 0
        for height in heights:
            tops.append(top)
            top += height
        out: list[list[tuple[int, str]]] = [[] for _ in range(top)]
        for row, column, _, _, lines in placed:
            for k, line in enumerate(lines):
                out[tops[row] + k].append((starts[column], line))
        made = []
        for parts in out:
            line, filled = [], 0
            for start, text in sorted(parts, key=lambda part: part[0]):
                line.append(" " * (start - filled) + text)
                filled = start + width_of(text)
            made.append("".join(line).rstrip())
        return made


def _number(node: Node, name: str, default: int, most: int) -> int:
    value = node.attributes.get(name, "").strip()
    return min(int(value), most) if value.isascii() and value.isdigit() and len(value) < 10 else default


def _whole(value: str) -> int | None:
    digits = value.strip().removeprefix("-")
    return int(value) if digits.isascii() and digits.isdigit() and len(digits) < 10 else None


def render(root: Node) -> str:
    flows: list[Flow] = [Flow()]
    tables: list[Table] = []
    #: The next number of each open list and its step; none of a list without numbers.
    numbers: list[list[int] | None] = []
    sheet = Sheet(root.style)
    #: Whether the text of each open element shows, by its visibility.
    shown = [True]
    exact = drawings = 0
    todo: list[tuple[str, Node | str]] = [("open", root)]
    while todo:
        step, node = todo.pop()
        flow = flows[-1]
        if isinstance(node, str):
            if not shown[-1]:
                continue
            if exact:
                flow.exact(node)
            elif node:
                flow.text(node)
            continue
        tag = node.tag
        if step == "open":
            style = sheet.of(node)
            if not rendered(node, style):
                continue
            if tag == "br":
                flow.end_line(keep_empty=True)
                continue
            if tag == "input":
                if shown[-1]:
                    flow.text(node.attributes.get("value", ""))
                continue
            seen = style.get("visibility")
            shown.append(shown[-1] if seen is None or seen == "inherit" else seen not in ("hidden", "collapse"))
            drawings += tag == "svg"
            if tag in ("td", "th") and tables:
                flows.append(Flow())
            elif tag == "tr" and tables:
                tables[-1].rows.append([])
            elif tag == "table":
                flow.apart(True)
                tables.append(Table())
            elif tag == "caption" and tables:
                flow.apart(False)
            elif tag in BLOCKS or (drawings and tag == "text"):
                flow.apart(tag in SPACED and not (tag in LISTS and numbers))
            if tag == "ol":
                falling = "reversed" in node.attributes
                items = sum(isinstance(child, Node) and child.tag == "li" for child in node.children)
                start = _whole(node.attributes.get("start", ""))
                numbers.append([start if start is not None else items if falling else 1, -1 if falling else 1])
            elif tag in LISTS:
                numbers.append(None)
            elif tag == "li":
                number = numbers[-1] if numbers else None
                if number is not None:
                    own = _whole(node.attributes.get("value", ""))
                    number[0] = number[0] if own is None else own
                flow.marker = "- " if number is None else f"{number[0]}. "
                if number is not None:
                    number[0] += number[1]
                flow.indents.append(" " * len(flow.marker))
            elif tag in ("blockquote", "dd"):
                flow.indents.append("  ")
            elif tag in ("pre", "textarea"):
                exact += 1
            todo.append(("close", node))
            children = node.children
            if tag == "details" and "open" not in node.attributes:
                children = [c for c in children if isinstance(c, Node) and c.tag == "summary"][:1]
            todo.extend(("open", child) for child in reversed(children))
            continue
        shown.pop()
        drawings -= tag == "svg"
        if tag in ("td", "th") and tables:
            cell = flows.pop().result()
            if not tables[-1].rows:
                tables[-1].rows.append([])
            tables[-1].rows[-1].append((cell, max(1, _number(node, "colspan", 1, 1000)), _number(node, "rowspan", 1, 65534)))
        elif tag == "table":
            flow.block(tables.pop().lines())
            flow.apart(True)
            if tables:
                tables[-1].is_layout = True
        elif tag == "li":
            flow.end_line()
            flow.indents.pop()
            flow.marker = None
        elif tag in ("blockquote", "dd"):
            flow.end_line()
            flow.indents.pop()
            flow.apart(tag in SPACED)
        elif (tag in BLOCKS and tag != "tr") or (drawings and tag == "text"):
            flow.apart(tag in SPACED and not (tag in LISTS and len(numbers) > 1))
        if tag in LISTS:
            numbers.pop()
        elif tag in ("pre", "textarea"):
            exact -= 1
    return "\n".join(flows[0].result())


def text_of(page: str) -> str:
    return render(build(page))


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """``page_id`` and the visible ``text`` of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "html"):
                found = [None if page is None else text_of(page) for page in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), pa.array(found, pa.string())], ["page_id", "text"]
                )

    source = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(html_col).cast("string").alias("html"))
    return source.mapInArrow(run, "page_id long, text string")
