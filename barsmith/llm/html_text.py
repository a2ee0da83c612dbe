"""Layout-aware rendering of HTML to text.

A tokenizer feeds a tree builder that supplies the tags authors leave out (a paragraph ends before a block, a list item
before the next, a cell before the next cell or row), closes what an end tag crosses, and ignores end tags of nothing. Elements that
a browser does not show - head, script, style, template and the like, a closed dialog, an attribute `hidden` or display:none in a
`style` attribute - give no text, nor do the parts of drawings and formulas that are not drawn (titles, definitions, annotations).
visibility:hidden is inherited, and an element within may be visible again. All other text is emitted, that of closed `details` too, and
so is what form controls show: the chosen option of a `select` (all options of a list box), values of buttons and text fields. Within svg and math a tag may close itself, and an HTML block ends the drawing. Rendering keeps the layout: blocks on lines of their own, paragraphs, headings, lists and
tables with a blank line around them, list items with markers (`start`, `value` and `reversed` count) and indents, preformatted text as
it is, and the cells of a table padded to columns, spans over columns and rows included.

Defined cases: null and empty pages give the empty string; a page that ends within a tag or comment ends there; any nesting depth
is taken, as nothing recurses; repeated rows are pages of their own; an empty table gives an empty result; extra columns are
ignored.
"""

import re
from heapq import heappop, heappush
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RENDERED = "page_id long, text string, n_lines long, n_tables long"

# Fixed values of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes textarea title".split())
UNSEEN = frozenset("head title script style template noscript iframe object video audio canvas datalist "
                   "noembed noframes area base link meta param source track".split())
UNDRAWN = frozenset("title desc metadata defs symbol clippath mask pattern marker filter lineargradient radialgradient style "
                    "script annotation annotation-xml mphantom".split())  # in svg and math
APART_IN_MATH = frozenset("mfrac mtr mtable".split())
HTML_WITHIN = frozenset("foreignobject desc title mi mo mn ms mtext annotation-xml".split())  # of svg and math
BREAKS_OUT = frozenset("b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu "
                       "meta nobr ol p pre ruby s small span strong strike sub sup table tt u ul var".split())
APART = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl table pre blockquote figure hr".split())  # a blank line around
BLOCK = APART | frozenset("address article aside body center dd details dialog dir div dt fieldset figcaption footer form "
                          "header hgroup html legend li main menu nav search section summary caption option".split())
ENDS_PARAGRAPH = BLOCK - frozenset("html body caption option legend".split())
#: Opening the key ends an open element of the first set, unless one of the second lies above it.
IMPLIED = {
    "li": (("li",), ("ul", "ol", "menu", "dir", "table")), "dt": (("dt", "dd"), ("dl", "table")), "dd": (("dt", "dd"), ("dl", "table")),
    "td": (("td", "th"), ("table",)), "th": (("td", "th"), ("table",)), "tr": (("tr",), ("table",)),
    "thead": (("thead", "tbody", "tfoot", "caption"), ("table",)), "tbody": (("thead", "tbody", "tfoot", "caption"), ("table",)),
    "tfoot": (("thead", "tbody", "tfoot", "caption"), ("table",)), "option": (("option",), ("select", "datalist")), "body": (("head",), ()),
}
SCOPE = frozenset("table td th caption template foreignobject".split())

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)|"
                   r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(\"[^\"]*+\"|'[^']*+'|[^\s>]*+))?")
CSS = re.compile(r"/\*.*?(?:\*/|\Z)|\"(?:[^\"\\]|\\.)*+(?:\"|\Z)|'(?:[^'\\]|\\.)*+(?:'|\Z)|\([^)]*+(?:\)|\Z)", re.S)
SPAN = re.compile(r"\s*(\d{1,9})")
MOST_COLUMNS, MOST_ROWS = 1000, 65534  # that one cell spans, in browsers
VALUE_SHOWN = frozenset("submit button reset text search email url tel number date time month week datetime-local".split())  # types of input
START = re.compile(r"\s*(-?\d{1,9})")
BLANKS = re.compile(r"[ \t\n\r\f]+")


def attributes_of(raw: str) -> dict[str, str]:
    """Values by lower-case name; of a repeated name the first counts, as in browsers."""
    found: dict[str, str] = {}
    for name, value in ATTRIBUTE.findall(raw):
        if value[:1] in ("'", '"') and value[-1] == value[0] and len(value) > 1:
            value = value[1:-1]
        found.setdefault(name.lower(), unescape(value) if "&" in value else value)
    return found


def styled(attributes: dict[str, str]) -> tuple[bool, bool | None]:
    """Whether an attribute `hidden` or the style's last word on display hides; what its last word on visibility says, if any."""
    said: dict[str, tuple[bool, str]] = {}
    for declaration in CSS.sub(" ", attributes.get("style", "")).split(";"):
        name, _, value = declaration.lower().partition(":")
        value, _, flag = value.partition("!")
        important, name = flag.strip() == "important", name.strip()
        if value.strip() and (important or not said.get(name, (False,))[0]):
            said[name] = important, value.strip()
    seen = {"visible": True, "hidden": False, "collapse": False}.get(said.get("visibility", (0, ""))[1])
    return "hidden" in attributes or said.get("display", (0, ""))[1] == "none", seen


class Flow:
    """Lines of a column of text."""

    def __init__(self):
        self.lines: list[str] = []
        self.now: list[str] = []
        self.indent: list[str] = []
        self.marker = ""
        self.gap = False

    def text(self, words: str) -> None:
        """Collapse blanks; none at the start of a line or twice in a row."""
        words = BLANKS.sub(" ", words)
        if not self.now or self.now[-1].endswith((" ", "\n")):
            words = words.removeprefix(" ")
        if words:
            self.now.append(words)

    def exact(self, text: str) -> None:
        first, *rest = text.replace("\r\n", "\n").split("\n")
        self.now.append(first)
        for line in rest:
            self.end_line(keep=True)
            self.now.append(line)

    def end_line(self, keep: bool = False) -> None:
        line = "".join(self.now)
        line = line.rstrip() if not keep else line
        if line or keep or self.marker:
            if self.gap and self.lines:
                self.lines.append("")
            self.gap = False
            head = "".join(self.indent)
            if self.marker:
                head = head[:-len(self.marker)] + self.marker
            self.lines.append((head + line).rstrip())
            self.marker = ""
        self.now = []

    def block(self, apart: bool) -> None:
        if self.now:
            self.end_line()
        self.gap = self.gap or apart


class Table:
    """Rows of (cell lines, columns and rows it spans; 0 rows: to the end of its group), and where groups of rows begin."""

    def __init__(self):
        self.rows: list[list[tuple[list[str], int, int]]] = []
        self.groups: list[int] = []

    def placed(self) -> list[list[tuple[int, int, int, list[str]]]]:
        """Per row, by column: (first column, columns, rows, lines) of its cells; columns that a cell above still covers are taken."""
        taken: dict[int, int] = {}  # column: the row that is free again
        ends = [g for g in sorted({*self.groups, len(self.rows)}) if g]
        out, group = [], 0
        for r, row in enumerate(self.rows):
            while ends[group] <= r:
                group += 1
            at, cells = 0, []
            for lines, columns, rows in row:
                while taken.get(at, 0) > r:
                    at += 1
                rows = min(rows or MOST_ROWS, ends[group] - r)
                if rows > 1:
                    taken.update(dict.fromkeys(range(at, at + columns), r + rows))
                cells.append((at, columns, rows, lines))
                at += columns
            out.append(cells)
        return out

    def lines(self) -> list[str]:
        rows = self.placed()
        left = self.edges([cell for row in rows for cell in row])
        out, below = [], []  # below: cells with lines left over for the next rows
        for row in rows:
            cells = sorted([*below, *([at, n, lines] for at, _, n, lines in row if lines)], key=lambda c: c[0])
            height = max((len(lines) for _, n, lines in cells if n == 1), default=0)
            for i in range(height):
                line = ""
                for at, _, lines in cells:
                    if i < len(lines):
                        line = line.ljust(left[at]) + lines[i]
                out.append(line.rstrip())
            below = [[at, n - 1, lines[height:]] for at, n, lines in cells if len(lines) > height]
        return out

    @staticmethod
    def edges(cells: list[tuple[int, int, int, list[str]]]) -> dict[int, int]:
        """Where each column that holds a cell's left edge begins: two places beyond the text of all cells that end before it."""
        starts, ended, edge, left = {}, [], 0, {}
        for at, columns, _, lines in cells:
            starts.setdefault(at, []).append((columns, max(map(len, lines), default=0)))
        for at in sorted(starts):
            while ended and ended[0][0] <= at:
                edge = max(edge, heappop(ended)[1])
            left[at] = edge
            for columns, width in starts[at]:
                heappush(ended, (at + columns, edge + width + 2))
        return left


class Select:
    """What a drop-down list shows: the last option marked `selected`, else the first that is not disabled."""

    def __init__(self, listbox: bool):
        self.listbox, self.off, self.shown, self.rank = listbox, False, "", 0

    def offer(self, text: str, given: dict[str, str]) -> None:
        rank = 2 if "selected" in given else 0 if self.off or "disabled" in given else 1
        if rank == 2 or rank > self.rank:
            self.shown, self.rank = text, rank


class Renderer:
    """Builds the open elements of a page and renders as they open and close."""

    def __init__(self, items: list[int] | None = None):
        self.open: list[tuple[str, bool, bool]] = []  # name, whether it hides, whether text around it is visible
        self.visible = True
        self.items, self.counted, self.numbered = items, [], []  # of each numbered list: items known before, found now; those open
        self.backwards = False
        self.selects: list[Select] = []
        self.options: list[dict[str, str]] = []
        self.names: dict[str, int] = {}  # of open elements
        self.worlds: list[tuple[int, bool]] = []  # depth of svg, math and HTML within them, whether it draws
        self.hidden = self.pre = self.tables = 0
        self.flows, self.grids = [Flow()], []
        self.counters: list[list[int] | None] = []  # next number and step of open lists

    def drawing(self) -> bool:
        """Whether the innermost element belongs to svg or math."""
        return bool(self.worlds) and self.worlds[-1][1]

    def draw(self, name: str, raw: str) -> None:
        """Open an element of svg or math; one that closes itself holds nothing."""
        if raw.endswith("/") and not any(value.endswith("/") for _, value in ATTRIBUTE.findall(raw)[-1:]):
            return
        given = attributes_of(raw) if raw else {}
        hides, seen = styled(given)
        hides = hides or name in UNDRAWN or given.get("display", "").strip().lower() == "none"
        if seen is None:
            seen = {"visible": True, "hidden": False, "collapse": False}.get(given.get("visibility", "").strip().lower())
        self.part()
        if name in ("svg", "math") or name in HTML_WITHIN:
            self.worlds.append((len(self.open), name not in HTML_WITHIN))
        self.push(name, hides, seen)
        if name == "text" and not self.hidden:
            self.flows[-1].block(False)

    def push(self, name: str, hides: bool, seen: bool | None) -> None:
        self.open.append((name, hides, self.visible))
        self.names[name] = self.names.get(name, 0) + 1
        self.hidden += hides
        self.visible = self.visible if seen is None else seen

    def part(self) -> None:
        """Parts of fractions and rows of matrices stand apart."""
        if self.drawing() and self.open[-1][0] in APART_IN_MATH and not self.hidden:
            self.flows[-1].text(" ")

    def start(self, name: str, attributes: str) -> bool:
        """Open an element; whether text up to its end tag is raw."""
        if self.drawing():
            if name not in BREAKS_OUT:
                self.draw(name, attributes)
                return False
            while self.drawing():
                self.close_last()
        if name in ("svg", "math"):
            self.draw(name, attributes)
            return False
        self.open_html(name, attributes)
        return name in RAW

    def open_html(self, name: str, attributes: str) -> None:
        if name in ENDS_PARAGRAPH and self.names.get("p"):
            self.close_implied(("p",), SCOPE)
        if name in IMPLIED and any(self.names.get(x) for x in IMPLIED[name][0]):
            self.close_implied(*IMPLIED[name])
        if name in ("td", "th") and self.names.get("table") and not self.names.get("tr"):
            self.start("tr", "")
        flow = self.flows[-1]
        if name in VOID:
            if not self.hidden:
                if name == "br":
                    flow.end_line(keep=bool(not flow.now and flow.lines and self.pre))
                elif name == "hr":
                    flow.block(True)
                elif name == "input":
                    self.show_value(attributes_of(attributes))
            return
        given = attributes_of(attributes) if attributes else {}
        hides, seen = styled(given)
        self.push(name, hides or name in UNSEEN or (name == "dialog" and "open" not in given), seen)
        if self.hidden:
            return
        if name == "select":
            size = SPAN.match(given.get("size", ""))
            self.selects.append(Select("multiple" in given or bool(size and int(size[1]) > 1)))
        elif name == "optgroup" and self.selects:
            self.selects[-1].off = "disabled" in given
            if self.selects[-1].listbox and given.get("label"):
                flow.block(False)
                self.write(given["label"])
                flow.block(False)
        elif name == "option" and self.selects and not self.selects[-1].listbox:
            self.flows.append(Flow())
            self.options.append(given)
            return
        if name in BLOCK:
            flow.block(name in APART and not (name in ("ul", "ol") and self.names.get("li")))
        if name == "pre":
            self.pre += 1
        elif name in ("ul", "ol", "menu"):
            self.counters.append(self.numbers(given) if name == "ol" else None)
        elif name == "li":
            count = self.counters[-1] if self.counters else None
            marker = "- "
            if count is not None:
                own = START.match(given.get("value", ""))
                marker = f"{int(own[1]) if own else count[0]}. "
                count[0] = (int(own[1]) if own else count[0]) + count[1]
                self.counted[self.numbered[-1]] += 1
            flow.marker = marker if self.visible else ""
            flow.indent.append(" " * len(marker))
        elif name == "dd" or name == "blockquote":
            flow.indent.append("  ")
        elif name == "table":
            self.grids.append(Table())
            self.tables += self.visible
        elif name in ("thead", "tbody", "tfoot") and self.grids:
            self.grids[-1].groups.append(len(self.grids[-1].rows))
        elif name == "tr" and self.grids:
            self.grids[-1].rows.append([])
        elif name in ("td", "th") and self.grids:
            columns, rows = SPAN.match(given.get("colspan", "")), SPAN.match(given.get("rowspan", ""))
            if not self.grids[-1].rows:
                self.grids[-1].rows.append([])
            self.grids[-1].rows[-1].append(([], min(max(int(columns[1]), 1), MOST_COLUMNS) if columns else 1,
                                            min(int(rows[1]), MOST_ROWS) if rows else 1))
            self.flows.append(Flow())

    def numbers(self, given: dict[str, str]) -> list[int]:
        """First number and step of a list; a reversed one begins at the number of its items, known from a rendering before."""
        self.numbered.append(len(self.counted))
        self.counted.append(0)
        begin, back = START.match(given.get("start", "")), "reversed" in given
        self.backwards = self.backwards or (back and not begin)
        first = int(begin[1]) if begin else self.items[self.numbered[-1]] if back and self.items else 1
        return [first, -1 if back else 1]

    def show_value(self, given: dict[str, str]) -> None:
        """A button's label, or what stands in a text field."""
        hides, seen = styled(given)
        if not hides and (self.visible if seen is None else seen) and given.get("type", "text").strip().lower() in VALUE_SHOWN:
            self.flows[-1].text(given.get("value", ""))

    def write(self, text: str) -> None:
        if self.visible:
            self.flows[-1].text(text)

    def end(self, name: str) -> None:
        if name == "br":
            self.start("br", "")
            return None
        if not self.names.get(name):
            if name == "p":
                self.start("p", "")
                self.close_last()
            return None
        stop = ("table",) if name in ("td", "th", "tr", "tbody", "thead", "tfoot", "caption") else () if name in SCOPE else SCOPE
        return self.close_implied((name,), stop)

    def close_implied(self, names, stop) -> None:
        """Close up to the innermost element of `names`, if none of `stop` lies above it."""
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] in names:
                while len(self.open) > i:
                    self.close_last()
                return
            if self.open[i][0] in stop:
                return

    def close_last(self) -> None:
        name, hides, around = self.open.pop()
        visible, self.visible = self.visible, around
        self.names[name] -= 1
        if self.worlds and self.worlds[-1][0] == len(self.open):
            self.worlds.pop()
        shown = not self.hidden
        self.hidden -= hides
        if not shown:
            return
        flow = self.flows[-1]
        if self.drawing():
            if name == "text":
                flow.block(False)
            elif name in APART_IN_MATH:
                flow.text(" ")
        elif name == "option" and self.options and not self.selects[-1].listbox:
            flow.block(False)
            self.flows.pop()
            given = self.options.pop()
            self.selects[-1].offer(given.get("label") or " ".join(x.strip() for x in flow.lines if x), given)
        elif name == "optgroup" and self.selects:
            self.selects[-1].off = False
        elif name == "select" and self.selects:
            chosen = self.selects.pop()
            if chosen.listbox:
                flow.block(False)
            elif visible:
                flow.text(chosen.shown)
        elif name in ("td", "th") and self.grids and len(self.flows) > 1:
            flow.block(False)
            self.flows.pop()
            self.grids[-1].rows[-1][-1][0].extend(flow.lines)
        elif name == "table" and self.grids:
            lines = self.grids.pop().lines()
            flow.block(True)
            for line in lines:
                flow.now.append(line)
                flow.end_line(keep=True)
            flow.gap = True
        elif name in BLOCK:
            if name == "li" and flow.marker:
                flow.end_line()
            flow.block(name in APART and not (name in ("ul", "ol") and self.names.get("li")))
            if name in ("li", "dd", "blockquote") and flow.indent:
                flow.indent.pop()
            elif name in ("ul", "ol", "menu") and self.counters:
                if self.counters.pop() is not None:
                    self.numbered.pop()
            elif name == "pre":
                self.pre -= 1

    def text(self, raw: str) -> None:
        if self.hidden or not self.visible or not raw:
            return
        if self.selects and not self.selects[-1].listbox and not self.options:
            return  # straight in a drop-down list
        text = unescape(raw) if "&" in raw else raw
        flow = self.flows[-1]
        if self.grids and len(self.flows) <= len(self.grids) and not self.names.get("caption"):
            if not text.strip(" \t\n\r\f"):
                return
            flow.text(text)  # text straight in a table stands before it
        elif self.pre:
            flow.exact(text)
        else:
            flow.text(text)

    def finish(self) -> str:
        while self.open:
            self.close_last()
        flow = self.flows[0]
        flow.block(False)
        return "\n".join(flow.lines).strip("\n")


def render(html: str | None) -> tuple[str, int]:
    """(text, number of tables shown). A page with a reversed list of no stated start is gone through twice, first to count items."""
    page = rendered(html, None)
    if page.backwards:
        page = rendered(html, page.counted)
    return page.finish(), page.tables


def rendered(html: str | None, items: list[int] | None) -> Renderer:
    page, at, n = Renderer(items), 0, len(html or "")
    while at < n:
        m = TOKEN.search(html, at)
        if not m:
            page.text(html[at:])
            break
        page.text(html[at:m.start()])
        at = m.end()
        name = m[2] or m[5]
        if not name:
            if m[0].startswith("<![CDATA["):
                page.text(m[0][9:].removesuffix("]]>"))
            continue
        name = name.lower()
        if m[1] or m[4]:
            page.end(name)
            continue
        if page.start(name, m[3] or m[6] or ""):
            close = re.compile(f"</{re.escape(name)}(?=[\\s/>]|\\Z)", re.I).search(html, at)
            stop = close.start() if close else n
            page.text(html[at:stop])
            at = stop
    return page


def extract(pages: DataFrame) -> DataFrame:
    """RENDERED: the visible text of every page."""
    def run(batches):
        for b in batches:
            done = [render(x.as_py()) for x in b.column(1)]
            yield pa.RecordBatch.from_arrays([
                b.column(0), pa.array([t for t, _ in done], pa.string()),
                pa.array([t.count("\n") + 1 if t else 0 for t, _ in done], pa.int64()), pa.array([k for _, k in done], pa.int64())],
                names=["page_id", "text", "n_lines", "n_tables"])
    return pages.select(F.col("page_id").cast("long"), F.col("html").cast("string")).mapInArrow(run, RENDERED)
