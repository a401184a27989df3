"""Layout-aware text of HTML pages.

A tokeniser and a tree builder with implied tags (unclosed p, li, td, option,
head, void elements, ...) turn a page into a tree; elements that are not
rendered (scripts, styles, head, hidden ones, closed dialogs, ...) are left
out, with all that is in them. The tree is then laid out as plain text:

* blocks start on a line of their own, paragraphs and headings with a blank line before and after;
* white space collapses as in inline layout, and is kept in pre and textarea;
* list items carry a bullet or their number and are indented by depth;
* tables are drawn with cells aligned in columns, spans included;
* a drop-down shows its selected or first option, a list box all of them;
* formulas are their characters, with a space between parts that stand above or
  beside each other; text labels of svg images are lines of their own.

Pages are independent: they are mapped in batches, without a shuffle.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Fixed values of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = frozenset(
    "head script style template noscript title meta link base iframe noembed noframes object audio video canvas datalist "
    "colgroup col area param source track".split()
)
#: Parts of svg and math that are not rendered where they stand.
FOREIGN = frozenset(["svg", "math"])
FOREIGN_UNSEEN = frozenset(
    "title desc metadata defs symbol clippath mask marker pattern filter lineargradient radialgradient script style "
    "annotation annotation-xml mphantom".split()
)
#: Parts of formulas that stand above, below or beside each other.
MATH_APART = frozenset("mfrac msup msub msubsup mroot munder mover munderover mmultiscripts mtr mlabeledtr".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 "
    "h6 header hgroup hr html legend li listing main menu nav ol optgroup option p plaintext pre search section summary table tbody td "
    "tfoot th thead tr ul xmp caption".split()
)
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 blockquote ul ol dl menu dir pre table figure hr listing xmp".split())
#: Start tags that end an open element: tag, what it ends, and where the search for it stops.
_LISTS, _TABLE = frozenset("ul ol menu dir".split()), frozenset(["table"])
IMPLIED = {
    "li": (frozenset(["li"]), _LISTS), "dt": (frozenset("dt dd".split()), frozenset(["dl"])), "dd": (frozenset("dt dd".split()), frozenset(["dl"])),
    "tr": (frozenset("tr td th caption colgroup".split()), _TABLE), "td": (frozenset("td th".split()), frozenset("table tr".split())),
    "th": (frozenset("td th".split()), frozenset("table tr".split())), "tbody": (frozenset("thead tbody tfoot tr td th caption colgroup".split()), _TABLE),
    "thead": (frozenset("tbody tfoot tr td th caption colgroup".split()), _TABLE), "tfoot": (frozenset("thead tbody tr td th caption colgroup".split()), _TABLE),
    "option": (frozenset(["option"]), frozenset("select datalist optgroup".split())), "optgroup": (frozenset("option optgroup".split()), frozenset(["select"])),
    "body": (frozenset(["head"]), frozenset(["html"])), "rp": (frozenset("rp rt".split()), frozenset(["ruby"])), "rt": (frozenset("rp rt".split()), frozenset(["ruby"])),
}
HEAD = frozenset("title meta link base style script noscript template".split())
CLOSES_P = BLOCK - frozenset("html body li td th tr tbody thead tfoot caption option optgroup legend".split())
SCOPE = frozenset("table td th caption button object template html".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>", re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_HIDDEN = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse))", re.I)
_SPACE = re.compile(r"[ \t\n\r\f]+")
GAP = "  "
#: Tables nested deeper than this are laid out as blocks.
DEEPEST = 40


class Node:
    __slots__ = ("tag", "attributes", "children")

    def __init__(self, tag: str, attributes: dict[str, str] | None = None, children: list | None = None):
        self.tag, self.attributes, self.children = tag, attributes or {}, [] if children is None else children


def parse(page: str) -> Node:
    """The tree of a page; text is str, elements are Node. Never fails: odd markup is text or is closed at the end."""
    root = Node("html")
    stack = [root]

    def close(to: int) -> None:
        del stack[to:]

    def add_text(text: str) -> None:
        if text:
            stack[-1].children.append(html.unescape(text) if "&" in text else text)

    at, end = 0, len(page)
    while at < end:
        m = _TOKEN.search(page, at)
        if m is None:
            add_text(page[at:])
            break
        if stack[-1].tag == "head" and page[at : m.start()].strip():
            close(len(stack) - 1)
        add_text(page[at : m.start()])
        at = m.end()
        if m[1]:
            add_text(m[1])
        if not m[3]:
            continue
        tag = m[3].lower()
        if m[2]:
            if tag == "br":
                stack[-1].children.append(Node("br"))
            elif tag == "p" and not any(n.tag == "p" for n in stack):
                stack[-1].children.append(Node("p"))
            elif tag not in ("html", "body"):
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag == tag:
                        close(i)
                        break
                    if stack[i].tag in ("td", "th", "table") and tag not in ("table", "tr", "tbody", "thead", "tfoot", "td", "th"):
                        break
            continue
        if tag == "html":
            continue
        attributes = {a[1].lower(): html.unescape(a[2] or a[3] or a[4] or "") for a in _ATTRIBUTE.finditer(m[4])} if m[4].strip() else {}
        if tag == "body" and any(n.tag == "body" for n in stack):
            continue
        if stack[-1].tag == "head" and tag not in HEAD:
            close(len(stack) - 1)
        if tag in CLOSES_P:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == "p":
                    close(i)
                    break
                if stack[i].tag in SCOPE:
                    break
        if tag in IMPLIED:
            ends, stops = IMPLIED[tag]
            low = None
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in stops:
                    break
                if stack[i].tag in ends:
                    low = i
            if low is not None:
                close(low)
        if tag in ("td", "th") and stack[-1].tag != "tr" and any(n.tag == "table" for n in stack):
            row = Node("tr")
            stack[-1].children.append(row)
            stack.append(row)
        node = Node(tag, attributes)
        stack[-1].children.append(node)
        if tag in VOID or m[4].endswith("/") and (tag in FOREIGN or any(n.tag in FOREIGN for n in stack)):
            continue
        if tag in RAW:
            stop = re.compile(rf"</{tag}[\s/>]", re.I).search(page, at)
            inside = page[at : stop.start() if stop else end]
            node.children.append(html.unescape(inside) if tag in ("textarea", "title") else inside)
            at = (page.find(">", stop.start()) + 1 or end) if stop else end
            continue
        stack.append(node)
    return root


def visible(node: Node) -> bool:
    a = node.attributes
    if node.tag in UNSEEN or "hidden" in a or node.tag == "dialog" and "open" not in a:
        return False
    if node.tag == "input" and (a.get("type") or "").lower() == "hidden":
        return False
    return not ("style" in a and _HIDDEN.search(a["style"]))


def _within(node: Node, wanted: frozenset, hidden=lambda n: not visible(n)):
    """The outermost elements of the wanted tags in a node, in their order."""
    work = list(reversed(node.children))
    while work:
        child = work.pop()
        if isinstance(child, str) or hidden(child):
            continue
        if child.tag in wanted:
            yield child
        else:
            work.extend(reversed(child.children))


def _labels(svg: Node) -> list[Node]:
    """The text of an image as blocks: only text and foreign objects are drawn, and not where they are only defined."""
    found = _within(svg, frozenset(["text", "foreignobject"]), lambda n: n.tag in FOREIGN_UNSEEN or not visible(n))
    return [Node("div", x.attributes, [c for c in x.children if isinstance(c, str) or c.tag not in FOREIGN_UNSEEN]) for x in found]


def _formula(node: Node) -> list:
    """The children of a formula without what is hidden; rows of a matrix are blocks."""
    root = Node("span")
    work = [(node, root)]
    while work:
        old, new = work.pop()
        for child in old.children:
            if isinstance(child, str):
                # White space between the elements of a formula is not drawn, but in its texts.
                if child.strip():
                    new.children.append(child)
                continue
            if child.tag in FOREIGN_UNSEEN or not visible(child):
                continue
            if old.tag in MATH_APART and new.children:
                new.children.append(" ")
            copy = Node("div" if child.tag in ("mtr", "mlabeledtr") else child.tag, child.attributes)
            new.children.append(copy)
            work.append((child, copy))
    return root.children


def _options(select: Node, depth: int) -> list:
    """What a select shows: the text of the selected or else first enabled option, or all options of a list box."""

    def shown(option: Node) -> str:
        return option.attributes.get("label") or _SPACE.sub(" ", render(Node("div", None, option.children), depth + 1)).strip()

    size = select.attributes.get("size", "")
    if "multiple" in select.attributes or size.isascii() and size.isdigit() and len(size) < 9 and int(size) > 1:
        rows: list = []
        for x in _within(select, frozenset(["option", "optgroup"])):
            if x.tag == "option":
                rows.append(shown(x))
            else:
                rows += [x.attributes.get("label", ""), *(shown(o) for o in _within(x, frozenset(["option"])))]
        return [Node("div", None, [row]) for row in rows if row]
    # A hidden or disabled option is not in the list, but it is shown where it is the selected one.
    flat: list[tuple[Node, bool]] = []
    for x in _within(select, frozenset(["option", "optgroup"]), lambda n: False):
        inner = [x] if x.tag == "option" else _within(x, frozenset(["option"]), lambda n: False)
        flat += [(o, "disabled" in x.attributes or "disabled" in o.attributes) for o in inner]
    chosen = [o for o, _ in flat if "selected" in o.attributes][-1:] or [o for o, off in flat if not off][:1]
    return [shown(o) for o in chosen]


class Page:
    """Lines of text under construction. ``gap``: a blank line is due before the next text."""

    def __init__(self):
        self.lines: list[str] = []
        self.line: list[str] = []
        self.gap = self.space = False
        self.indent = ""
        self.marker = ""

    def text(self, text: str, kept: bool) -> None:
        if kept:
            first, *others = text.split("\n")
            self.put(first)
            for other in others:
                self.end(True)
                self.put(other)
            return
        words = _SPACE.sub(" ", text)
        if words == " " or not words:
            self.space = self.space or bool(words and self.line)
            return
        if words[0] == " ":
            self.space = bool(self.line)
            words = words[1:]
        after = words[-1] == " "
        self.put(words[:-1] if after else words)
        self.space = after

    def put(self, text: str) -> None:
        if not text:
            return
        if self.space and self.line:
            self.line.append(" ")
        self.space = False
        self.line.append(text)

    def end(self, empty: bool = False) -> None:
        """End the line; an empty one only counts if it was asked for."""
        if self.line or empty or self.marker:
            if self.gap and self.lines and self.lines[-1]:
                self.lines.append("")
            self.gap = False
            start = self.indent
            if self.marker:
                start = self.indent[: len(self.indent) - len(self.marker)] + self.marker
                self.marker = ""
            self.lines.append((start + "".join(self.line)).rstrip() if self.line or start.strip() else "")
        self.line, self.space = [], False

    def block(self, spaced: bool) -> None:
        if self.line:
            self.end()
        self.gap = self.gap or spaced


def _grid(table: Node, depth: int) -> tuple[list[list[str]], list[str]]:
    """Rows of cell texts with spans filled by empty cells, and captions."""
    rows: list[list[tuple[list[str], int]]] = []
    captions: list[str] = []
    taken: dict[tuple[int, int], bool] = {}

    def walk(node: Node) -> None:
        for child in node.children:
            if isinstance(child, str) or not visible(child):
                if isinstance(child, str) and child.strip():
                    captions.append(_SPACE.sub(" ", child).strip())
                continue
            if child.tag == "tr":
                r, c = len(rows), 0
                rows.append([])
                for cell in child.children:
                    if isinstance(cell, str):
                        if cell.strip():
                            captions.append(_SPACE.sub(" ", cell).strip())
                        continue
                    if not visible(cell):
                        continue
                    while taken.get((r, c)):
                        rows[r].append("")
                        c += 1
                    wide, high = _span(cell, "colspan"), _span(cell, "rowspan")
                    rows[r].append(render(cell, depth + 1))
                    rows[r] += [""] * (wide - 1)
                    for i in range(1, high):
                        for j in range(wide):
                            taken[(r + i, c + j)] = True
                    c += wide
            elif child.tag in ("thead", "tbody", "tfoot"):
                walk(child)
            else:
                captions.append(render(Node("div", None, [child]) if child.tag in FOREIGN or child.tag == "select" else child, depth + 1))

    walk(table)
    return rows, [c for c in captions if c]


def _span(cell: Node, name: str) -> int:
    value = cell.attributes.get(name, "")
    return min(max(int(value), 1), 1000) if value.isascii() and value.isdigit() and len(value) < 6 else 1


def _draw(table: Node, page: Page, depth: int) -> None:
    rows, captions = _grid(table, depth)
    for caption in captions:
        for line in caption.split("\n"):
            page.put(line)
            page.end()
    cells = [[x.split("\n") if x else [] for x in row] for row in rows]
    columns = max((len(r) for r in cells), default=0)
    width = [max((len(line) for r in cells if len(r) > c for line in r[c]), default=0) for c in range(columns)]
    for row in cells:
        for i in range(max((len(x) for x in row), default=0)):
            line = GAP.join((row[c][i] if c < len(row) and i < len(row[c]) else "").ljust(width[c]) for c in range(columns) if width[c])
            page.put(line.rstrip())
            page.end()


def _lay(node: Node, page: Page, kept: bool, depth: int) -> None:
    """Lay out the children of a node, with an explicit stack so that deep pages are fine."""
    work: list = [("in", node, kept, 0)]
    while work:
        what, node, kept, extra = work.pop()
        if what == "out":
            page.block(node.tag in SPACED)
            if extra:
                if page.marker:
                    page.end()
                page.indent = page.indent[: len(page.indent) - extra]
            continue
        if what == "quote":
            page.put("”")
            continue
        if isinstance(node, str):
            page.text(node, kept)
            continue
        if what == "child":
            if not visible(node):
                continue
            tag = node.tag
            if tag == "br":
                page.end(True)
                continue
            if tag == "table" and depth < DEEPEST:
                page.block(True)
                _draw(node, page, depth)
                page.block(True)
                continue
            if tag == "hr":
                page.block(True)
                continue
            if tag == "img":
                page.text(node.attributes.get("alt", ""), False)
                continue
            if tag == "input":
                if (node.attributes.get("type") or "text").lower() in ("submit", "button", "reset", "text", "search", "email", "url", "tel", "number"):
                    page.text(node.attributes.get("value") or node.attributes.get("placeholder", ""), False)
                continue
            if tag == "svg":
                work.extend(("child", c, False, 0) for c in reversed(_labels(node)))
                continue
            if tag == "select":
                work.extend(("child", c, False, 0) for c in reversed(_options(node, depth)))
                continue
            if tag == "math":
                apart = node.attributes.get("display", "").lower() == "block"
                work.append(("child", Node("div" if apart else "span", None, _formula(node)), False, 0))
                continue
            kept = kept or tag in ("pre", "textarea", "listing", "xmp")
            if tag in BLOCK:
                nested = tag in _LISTS and bool(page.indent)
                page.block(tag in SPACED and not nested)
                extra = 0
                if tag == "li":
                    mark = node.attributes.get("_mark", "- ")
                    page.indent += " " * len(mark)
                    page.marker, extra = mark, len(mark)
                elif tag in ("blockquote", "dd"):
                    page.indent += "  "
                    extra = 2
                if tag == "ol":
                    start = node.attributes.get("start", "")
                    number = int(start) if start.isascii() and start.isdigit() and len(start) < 9 else 1
                    for item in node.children:
                        if isinstance(item, Node) and item.tag == "li" and visible(item):
                            item.attributes["_mark"] = f"{number}. "
                            number += 1
                work.append(("out", Node("div") if nested else node, kept, extra))
            elif tag == "q":
                page.put("“")
                work.append(("quote", node, kept, 0))
        work.extend(("child", c, kept, 0) for c in reversed(node.children))


def render(node: Node, depth: int = 0) -> str:
    page = Page()
    _lay(node, page, False, depth)
    page.end()
    return "\n".join(page.lines).strip("\n")


def text_of(page: str | None) -> str:
    """The visible text of a page; empty for null or empty pages."""
    return render(parse(page)) if page else ""


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_lines of every page (columns page_id, url, html).

    One row per row. Null and empty pages have an empty text and no lines;
    repeated rows get equal results; a page without markup is its own text;
    an empty table gives an empty result; other columns are ignored.
    """
    read = pages.select("page_id", "url", "html")

    def run(batches):
        for batch in batches:
            texts = [text_of(x) for x in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                pa.array([x.count("\n") + 1 if x else 0 for x in texts], pa.int64()),
            ], names=["page_id", "url", "text", "n_lines"])

    schema = T.StructType([*read.schema.fields[:2], T.StructField("text", T.StringType()), T.StructField("n_lines", T.LongType())])
    return read.mapInArrow(run, schema)
