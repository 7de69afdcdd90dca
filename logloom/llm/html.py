"""Layout-aware text of web pages: a tree builder with implied tags, and a renderer.

The builder turns markup into a tree the way browsers recover from it: it supplies missing end tags of
paragraphs, list items, cells and options, ignores end tags that open nothing, and reads scripts, styles
and other raw elements as data. The renderer walks the tree and emits all visible text: blocks on lines
of their own with a blank line around paragraphs and headings, list items with their mark and depth,
cells of a table in aligned columns, with a row's last one of any number of lines, preformatted text as it stands. What is hidden by its tag, the
hidden or aria-hidden attribute, an inline style, a rule of a style element or a closed <details> is left
out; what is made visible again within it is shown.

Time and memory grow with the page alone: open elements are found by their depth, list numbers and nesting
are counted on the way.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Names of HTML elements by how they are parsed and shown.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp template".split())
#: All else, and text that is not blank, ends an open head.
IN_HEAD = frozenset("html head base basefont bgsound link meta noframes noscript script style template title".split())
UNSEEN = frozenset("head script style noscript template title meta link iframe noembed noframes canvas audio video datalist map defs desc metadata symbol annotation annotation-xml".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl table pre xmp blockquote figure".split())
BLOCK = SPACED | frozenset("html body div section article aside header footer nav main form fieldset address li dt dd tr caption hr details summary figcaption legend menu center dir hgroup search dialog thead tbody tfoot".split())
#: An opening tag closes these, up to the nearest of the bounds.
CLOSES = {
    **dict.fromkeys(BLOCK - {"html", "body", "li", "dt", "dd", "tr", "caption", "thead", "tbody", "tfoot"}, ({"p"}, {"button", "td", "th", "table", "caption"})),
    "li": ({"li", "p"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd", "p"}, {"dl"}),
    "dd": ({"dt", "dd", "p"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "td": ({"td", "th", "p"}, {"tr", "table"}),
    "th": ({"td", "th", "p"}, {"tr", "table"}),
    "tr": ({"tr", "td", "th", "p"}, {"table"}),
    **dict.fromkeys(("thead", "tbody", "tfoot"), ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "p"}, {"table"})),
    "body": ({"head"}, {"html"}),
}
MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s=/\"'<>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
SPACE = re.compile(r"[ \t\n\r\f]+")
LISTS = frozenset(("ul", "ol", "menu", "dir"))
#: End tags of other elements end nothing outside of the nearest of these.
SCOPES = ("td", "th", "caption", "table")
IN_TABLE = frozenset("table caption colgroup thead tbody tfoot tr td th html body".split())
WIDEST = 60  # a column is padded to so many characters; longer cells push the next ones on
DEEPEST = 80  # lines are indented so far at most
# The largest spans that browsers take.
COLUMNS, ROWS = 1000, 65534
NESTED = 2  # tables that hold tables are aligned if these are nested no deeper, else shown cell by cell


class Node:
    """An element; `nested` says of a table how deeply tables are nested in it, `rules` which rules that look at the
    elements around it hold."""

    __slots__ = ("tag", "attrs", "children", "nested", "known", "rules")

    def __init__(self, tag: str, attrs: str = ""):
        self.tag, self.attrs = tag, attrs
        self.children: list[Node | str] = []
        self.nested = 0
        self.rules: tuple = ()
        self.known: dict[str, str] | None = None

    def get(self, name: str) -> str | None:
        if self.known is None:
            self.known = {}
            for m in ATTRIBUTE.finditer(self.attrs):
                self.known.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
        value = self.known.get(name)
        return value if value is None else entities.unescape(value)

    def number(self, name: str, most: int) -> int | None:
        value = (self.get(name) or "").strip()
        return min(int(value[:9]), most) if re.fullmatch("[0-9]+", value) else None


def parse(markup: str) -> tuple[Node, list[str]]:
    """The tree of a page and its style sheets; every text node is a str with entities resolved."""
    root, sheets = Node("#root"), []
    path = [root]
    depths: dict[str, list[int]] = {}  # where the open elements of each name stand in the path
    pos, end = 0, len(markup)

    def close(depth: int) -> None:
        """Ends what is open from this depth on."""
        while len(path) > depth:
            depths[path.pop().tag].pop()

    def nearest(tags) -> int:
        return max([depths[t][-1] for t in tags if depths.get(t)], default=0)

    while pos < end:
        m = MARKUP.search(markup, pos)
        stop = m.start() if m else end
        if stop > pos:
            text = markup[pos:stop]
            if depths.get("head") and not text.isspace():
                close(depths["head"][-1])
            path[-1].children.append(entities.unescape(text))
        if m is None:
            break
        pos = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            if depths.get("head") and tag in ("p", "br"):
                close(depths["head"][-1])
            if depths.get(tag) and (tag in IN_TABLE or depths[tag][-1] > nearest(SCOPES)):
                close(depths[tag][-1])
            elif tag in ("p", "br"):
                path[-1].children.append(Node(tag))  # a lone end of a paragraph is an empty one
            continue
        if depths.get("head") and tag not in IN_HEAD:
            close(depths["head"][-1])
        if tag in CLOSES:
            closed, bounds = CLOSES[tag]
            if some := [depths[t] for t in closed if depths.get(t)]:
                within = nearest(bounds)
                first = [d[k] for d in some if (k := bisect_right(d, within)) < len(d)]
                if first:
                    close(min(first))
        node = Node(tag, m[3])
        path[-1].children.append(node)
        if tag == "table":
            for deep, outer in enumerate(reversed(depths.get("table", [])[-NESTED - 1 :]), 1):
                path[outer].nested = max(path[outer].nested, deep)
        if tag in RAW:
            ending = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(markup, pos)
            stop = ending.start() if ending else end
            if tag == "textarea":
                node.children.append(entities.unescape(markup[pos:stop]))
            elif tag == "xmp":
                node.children.append(markup[pos:stop])
            elif tag == "style":
                sheets.append(markup[pos:stop])
            past = markup.find(">", ending.end() - 1) if ending else -1
            pos = past + 1 if past >= 0 else end
        elif tag not in VOID and not m[3].endswith("/"):
            depths.setdefault(tag, []).append(len(path))
            path.append(node)
    return root, sheets


COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)", re.S)
AT_RULE = re.compile(r"@(media\b)?([^{};]*+)(?:;|\{((?:[^{}]++|\{[^{}]*+\})*+)\}|\Z)", re.I)
RULE = re.compile(r"([^{}]+)\{([^{}]*)\}")
COMPOUND = re.compile(r"(\*|[a-z][\w-]*)?((?:[.#][\w-]+)*)", re.I)
SHOWN = re.compile(r"(?:^|;)\s*(display|visibility)\s*:\s*([a-z-]+)", re.I)
ON_SCREEN = re.compile(r"\s*(?:only\s+)?(?:all|screen)\s*", re.I)


class Styles:
    """Which elements are shown. Of style sheets the rules for a tag, classes and an id count, also within others
    (`.a p`), by weight and order, at any time or on all screens; other selectors and conditions are not evaluated."""

    def __init__(self, sheets: list[str]):
        self.rules: dict[str, list[tuple]] = {}  # by a class, id or tag that the element must have
        self.within: list[tuple] = []  # rules for elements inside of others: those outside, from the outermost, and the rule
        order = 0
        for sheet in sheets:
            flat = AT_RULE.sub(lambda m: m[3] or "" if m[1] and any(ON_SCREEN.fullmatch(x) for x in m[2].split(",")) else "", COMMENT.sub("", sheet))
            for m in RULE.finditer(flat):
                says = {k.lower(): v.lower() for k, v in SHOWN.findall(m[2])}
                for selector in m[1].split(",") if says else ():
                    parts = [c for x in selector.split() if (c := COMPOUND.fullmatch(x)) and c[0]]
                    if not parts or len(parts) < len(selector.split()):
                        continue
                    order += 1
                    found = [((c[1] or "*").lower(), re.findall(r"[.#][\w-]+", c[2])) for c in parts]
                    weight = (sum(n[0] == "#" for _, ns in found for n in ns), sum(len(ns) for _, ns in found), sum(t != "*" for t, _ in found), order)
                    tag, names = found[-1]
                    rule = (weight, tag, frozenset(names), says)
                    if len(found) > 1:
                        self.within.append(([(t, frozenset(ns)) for t, ns in found[:-1]], rule))
                    else:
                        self.rules.setdefault(names[0] if names else tag, []).append(rule)

    @staticmethod
    def names(node: Node) -> frozenset[str]:
        return frozenset({"." + c for c in (node.get("class") or "").split()} | ({"#" + i} if (i := node.get("id")) else set()))

    def mark(self, root: Node) -> None:
        """Gives elements the rules that hold for them because of those around them, and takes away what a closed
        <details> holds but its summary. One walk, on which each rule knows how many of its outer elements it has met."""
        met = [0] * len(self.within)
        todo: list[tuple] = [(root, None)]
        while todo:
            node, undo = todo.pop()
            if undo is not None:
                for k in undo:
                    met[k] -= 1
                continue
            if node.tag == "details" and node.get("open") is None:
                node.children = [c for c in node.children if isinstance(c, Node) and c.tag == "summary"][:1]
            raised = []
            if self.within:
                names = self.names(node)
                fits = lambda tag, wanted: tag in ("*", node.tag) and wanted <= names  # noqa: E731, B023
                node.rules = tuple(rule for k, (outer, rule) in enumerate(self.within) if met[k] == len(outer) and fits(rule[1], rule[2]))
                for k, (outer, _) in enumerate(self.within):
                    if met[k] < len(outer) and fits(*outer[met[k]]):
                        met[k] += 1
                        raised.append(k)
            todo.append((node, raised))
            todo += [(c, None) for c in reversed(node.children) if isinstance(c, Node)]

    def of(self, node: Node) -> tuple[bool, bool | None]:
        """Whether an element is left out with all that it holds, and its own visibility, if it has one."""
        tag = node.tag
        if tag in UNSEEN or tag == "dialog" and node.get("open") is None:
            return True, None
        plain = not node.attrs.strip(" /")
        if plain and not self.rules and not node.rules:
            return False, None
        says: dict[str, str] = {}
        if not plain and node.get("hidden") is not None:
            says["display"] = "none"
        if self.rules or node.rules:
            names = self.names(node)
            met = [r for key in (*names, tag, "*") for r in self.rules.get(key, ()) if r[1] in ("*", tag) and r[2] <= names] + list(node.rules)
            for rule in sorted(met, key=lambda r: r[0]):
                says |= rule[3]
        if not plain:
            if (node.get("aria-hidden") or "").lower() == "true":
                return True, None
            says |= {k.lower(): v.lower() for k, v in SHOWN.findall(node.get("style") or "")}
        visibility = says.get("visibility")
        return says.get("display") == "none", None if visibility in (None, "inherit") else visibility not in ("hidden", "collapse")


class Renderer:
    """Collects lines; `gap` is how many blank lines must stand before the next text. In a cell line breaks are
    spaces."""

    def __init__(self, styles: Styles, visible: bool = True, cell: bool = False):
        self.styles, self.visible, self.cell = styles, visible, cell
        self.lines: list[str] = []
        self.line: list[str] = []
        self.gap = 0
        self.indent = ""
        self.mark = ""
        self.lists: list[int | None] = []  # the next number of each open list, if it is an ordered one
        self.items = 0

    def end_line(self, gap: int = 0) -> None:
        text = SPACE.sub(" ", "".join(self.line)).strip(" ")
        self.line = []
        if text:
            self.put(text)
        self.gap = max(self.gap, gap)

    def put(self, text: str) -> None:
        if self.lines and self.gap:
            self.lines.extend([""] * self.gap)
        self.gap = 0
        self.lines.append(self.indent + self.mark + text)
        self.mark = " " * len(self.mark)

    def say(self, text: str) -> None:
        if self.visible:
            self.line.append(text)

    def text(self) -> str:
        self.end_line()
        return "\n".join(x.rstrip() for x in self.lines)

    def walk(self, nodes: list[Node | str]) -> None:
        """Depth first without recursion: pages may be nested deeply."""
        todo: list[tuple] = [(self.enter, x) for x in reversed(nodes)]
        while todo:
            step, *what = todo.pop()
            more = step(*what)
            if more:
                todo.extend(reversed(more))

    def enter(self, node: Node | str) -> list[tuple] | None:
        if isinstance(node, str):
            self.say(node)
            return None
        gone, visible = self.styles.of(node)
        if gone:
            return None
        if visible is None or visible == self.visible:
            return self.show(node)
        before, self.visible = self.visible, visible
        return [*(self.show(node) or ()), (self.see, before)]

    def see(self, visible: bool) -> None:
        self.visible = visible

    def show(self, node: Node) -> list[tuple] | None:
        tag = node.tag
        if tag == "br":
            if self.cell:
                self.line.append(" ")
            else:
                self.end_line()
        elif tag == "hr":
            self.end_line(1)
        elif tag == "img":
            self.say(node.get("alt") or "")
        elif tag == "input":
            kind = (node.get("type") or "text").lower()
            if kind not in ("hidden", "checkbox", "radio", "password", "file", "color", "range"):
                self.say(f" {node.get('alt' if kind == 'image' else 'value') or node.get('placeholder') or ''} ")
        elif tag in ("pre", "xmp"):
            self.end_line(1)
            for i, line in enumerate(plain(node, self.styles, self.visible).strip("\r\n").splitlines()):
                self.gap = 0 if i else self.gap
                self.put(line.rstrip())
            self.end_line(1)
        elif tag == "table" and node.nested <= NESTED and (lines := aligned(node, self.styles, self.visible)) is not None:
            self.end_line(1)
            for line in lines:
                self.put(line)
            self.end_line(1)
        elif tag in BLOCK:
            return self.block(node, 1 if tag in SPACED else 0)
        elif tag in ("td", "th", "option", "button", "label"):
            return [(self.space,), *((self.enter, c) for c in node.children), (self.space,)]
        else:
            return [(self.enter, c) for c in node.children]
        return None

    def space(self) -> None:
        self.line.append(" ")

    def block(self, node: Node, gap: int) -> list[tuple]:
        indent, mark, tag = self.indent, self.mark, node.tag
        inner, begin = indent, ""
        if tag in LISTS:
            gap = 0 if self.items else 1
            inner = indent + " " * len(mark)
        elif tag == "li":
            begin = self.item_mark(node)
        elif tag == "dd":
            inner = indent + "    "
        elif tag == "blockquote":
            inner = indent + "> "

        def start() -> None:
            self.end_line(gap)
            self.indent = inner[:DEEPEST]
            if tag in LISTS:
                self.mark = ""
                self.lists.append((int(first) if re.fullmatch("-?[0-9]{1,9}", first := node.get("start") or "") else 1) if tag == "ol" else None)
            elif begin:
                self.mark = begin
            self.items += tag == "li"

        def stop() -> None:
            self.end_line(gap)
            if tag in LISTS:
                self.lists.pop()
            self.items -= tag == "li"
            self.indent, self.mark = indent, (self.mark if not begin and inner == indent else mark)

        return [(start,), *((self.enter, c) for c in node.children), (stop,)]

    def item_mark(self, node: Node) -> str:
        """'- ', or the item's number in an ordered list."""
        if not self.lists or self.lists[-1] is None:
            return "- "
        at = int(value) if re.fullmatch("-?[0-9]{1,9}", value := node.get("value") or "") else self.lists[-1]
        self.lists[-1] = at + 1
        return f"{at}. "


def plain(node: Node, styles: Styles, visible: bool) -> str:
    """All visible text below a node and what its images are called, with line breaks of <br> and blocks alone."""
    out, todo = [], [(x, visible) for x in reversed(node.children)]
    while todo:
        x, seen = todo.pop()
        if isinstance(x, str):
            out.append(x if seen else "")
            continue
        gone, own = styles.of(x)
        seen = seen if own is None else own
        if gone:
            continue
        if x.tag == "br":
            out.append("\n")
        elif x.tag == "img":
            out.append((x.get("alt") or "") if seen else "")
        elif x.tag in BLOCK:
            out.append("" if not out or out[-1].endswith("\n") else "\n")
            todo += [("\n", True), *((c, seen) for c in reversed(x.children))]
        else:
            todo += [(c, seen) for c in reversed(x.children)]
    return "".join(out)


def cells_of(table: Node, styles: Styles, visible: bool) -> tuple[list[str], list[list[tuple[int, int, str]]]] | None:
    """What stands above the rows (captions, and text in no cell) and, by row, the cells (column, columns, text).
    None if text in no cell stands between them, or a cell of several lines before another one that isn't empty:
    text is to be read in the page's order."""
    captions: list[str] = []
    rows: list[list[tuple[int, int, str]]] = []
    open_cells: list[tuple[int, int, int]] = []  # those that reach into later rows: column, columns, rows left
    todo = [(x, visible) for x in reversed(table.children)]
    while todo:
        x, seen = todo.pop()
        if isinstance(x, str):
            if x.strip() and seen:
                if rows:
                    return None
                captions.append(SPACE.sub(" ", x).strip())
            continue
        gone, own = styles.of(x)
        seen = seen if own is None else own
        if gone:
            continue
        if x.tag == "caption":
            captions.append(SPACE.sub(" ", plain(x, styles, seen)).strip())
        elif x.tag in ("thead", "tbody", "tfoot"):
            open_cells = []
            todo += [(c, seen) for c in reversed(x.children)]
        elif x.tag == "tr":
            row: list[tuple[int, int, str]] = []
            below, taken, column = [], sorted(open_cells), 0
            for c in x.children:
                if isinstance(c, str):
                    if c.strip() and seen:
                        return None
                    continue
                gone, own = styles.of(c)
                if gone:
                    continue
                if c.tag not in ("td", "th"):
                    return None
                while taken and taken[0][0] <= column:
                    column = max(column, taken[0][0] + taken[0][1])
                    taken.pop(0)
                cell = Renderer(styles, seen if own is None else own, cell=True)
                cell.walk(c.children)
                text = cell.text()
                if text and row and any("\n" in t for _, _, t in row):
                    return None
                wide, high = c.number("colspan", COLUMNS) or 1, c.number("rowspan", ROWS)
                row.append((column, wide, text))
                if high != 1 and high is not None:
                    below.append((column, wide, (high or ROWS + 1) - 1))
                column += wide
            open_cells = [(a, w, n - 1) for a, w, n in open_cells if n > 1] + below
            if row:
                rows.append(row)
        elif x.tag not in ("colgroup", "col"):
            return None
    return captions, rows


def aligned(table: Node, styles: Styles, visible: bool) -> list[str] | None:
    """The table's lines, each cell at its column's place; columns without text take no room."""
    if (found := cells_of(table, styles, visible)) is None:
        return None
    captions, rows = found
    widths: dict[int, list[int]] = {}
    for row in rows:
        for column, wide, text in row:
            if text:
                width = widths.setdefault(column, [0, 0])
                width[wide > 1] = max(width[wide > 1], min(max(map(len, text.split("\n"))), WIDEST))
    at, place = 0, {}
    for column in sorted(widths):
        place[column] = at
        at += (widths[column][0] or widths[column][1]) + 2
    out = [c for c in captions if c]
    for row in rows:
        line, text = "", ""
        for column, _, text in [c for c in row if c[2]]:
            if text:
                line = line.ljust(place[column]) if len(line) + 2 <= place[column] or not line else line + "  "
                line += text
        first, *more = line.split("\n")  # only a row's last text has several lines
        if line:
            out.append(first)
            out += [" " * (len(first) - len(text.split("\n")[0])) + x if x else "" for x in more]
    return out


def render(markup: str | None) -> str:
    root, sheets = parse(markup or "")
    styles = Styles(sheets)
    styles.mark(root)
    renderer = Renderer(styles)
    renderer.walk(root.children)
    return renderer.text()


def extract(pages: DataFrame) -> DataFrame:
    """page_id, text: one row per row of pages. Null and empty pages give an empty text.

    A page's text has all its visible characters but for runs of white space; nothing is cut, of pages of any
    length. Repeated rows and null ids are kept; other columns are not read.
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([render(x.as_py()) for x in b.column(1)], pa.string())], ["page_id", "text"])

    return pages.select(F.col("page_id").cast("long"), F.col("html").cast("string")).mapInArrow(each, "page_id long, text string")
