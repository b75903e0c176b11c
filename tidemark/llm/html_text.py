"""HTML to the text a reader sees, laid out: blocks, lists, preformatted text and aligned tables.

``events`` is the tree builder: it cuts a page into tags and texts, keeps the stack of open elements, supplies implied
start and end tags and drops stray ones. ``Layout`` writes the text of visible elements block by block. Both work on an
explicit stack, so depth does not matter, and hold one page at a time.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.frames import free_name, map_batches

# A quote opens a value only after an equals sign, so one inside an unquoted value ends nothing.
TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*>?|</([a-zA-Z][^\s/>]*)[^>]*>?"
    r"|<([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*(?:\"[^\"]*\"|'[^']*')|=)*)>?",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>][^\s>]*)))?")
PRE = {"pre": True, "pre-wrap": True, "break-spaces": True, "pre-line": "lines", "normal": False, "nowrap": False}
WHOLE = re.compile("-?[0-9]{1,9}")
WORDS = re.compile(r"[^ \t\n\f\r]+")
# Element names and their roles, from the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
HIDDEN = frozenset(
    "head script style title template noscript iframe noembed noframes object audio video canvas datalist "
    "rp area base col link meta param source track".split()
)
# Not shown within svg and math, but as unknown elements elsewhere.
FOREIGN = frozenset(["svg", "math"])
HIDDEN_FOREIGN = frozenset(
    "desc metadata defs symbol clippath mask marker pattern lineargradient radialgradient annotation annotation-xml "
    "mphantom".split()
)
APART = frozenset("text foreignobject mfrac mtr mtd".split())  # stand apart from what is before and after
# Elements in which svg and math hold HTML, and start tags that end an open svg or math.
INTEGRATION = frozenset("foreignobject desc title annotation-xml mi mo mn ms mtext".split())
BREAKOUT = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta "
    "nobr ol p pre ruby s small span strong strike sub sup table tt u ul var".split()
)
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl pre blockquote table figure fieldset".split())
BLOCK = SPACED | frozenset(
    "html body div article section nav aside header footer main address form li dt dd tr td th caption thead tbody "
    "tfoot hr details summary figcaption legend option optgroup dialog center".split()
)
CLOSES_P = BLOCK - frozenset("html body td th tr caption thead tbody tfoot option optgroup legend summary".split())
# A start tag of the first kind ends an open element of the second, unless one of the third is nearer.
IMPLIED_END = {
    "li": ("li", "ul ol"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "option": ("option", "select datalist"),
    "optgroup": ("option optgroup", "select"), "tr": ("tr td th caption", "table"),
    "td": ("td th caption", "tr table"), "th": ("td th caption", "tr table"),
    "thead": ("thead tbody tfoot caption", "table"), "tbody": ("thead tbody tfoot caption", "table"),
    "tfoot": ("thead tbody tfoot caption", "table"), "body": ("head", "body"),
}
IMPLIED_END = {k: (frozenset(a.split()), frozenset(b.split())) for k, (a, b) in IMPLIED_END.items()}
BODY_STARTS = frozenset("meta link title style script base noscript template head html body".split())
FENCE = frozenset("table td th caption html".split())  # an end tag does not reach across these, but for its own kind

CELLS, NONE = frozenset("td th caption".split()), frozenset()
TABLE_PARTS = frozenset("table tr thead tbody tfoot".split())


def attributes(source: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for name, a, b, c in ATTRIBUTE.findall(source):
        out.setdefault(name.lower(), html.unescape(a or b or c))
    return out


def declarations(style: str) -> dict[str, str]:
    """The properties of a style attribute; the last of equal ones holds."""
    parts = (p.partition(":") for p in style.lower().split(";"))
    return {name.strip(): value.replace("!important", "").strip() for name, _, value in parts}


def events(page: str) -> Iterator[tuple[str, str, dict[str, str]]]:
    """('open', tag, attributes), ('close', tag, {}) and ('text', text, {}); opens and closes are well nested."""
    stack: list[str] = []
    places: defaultdict[str, list[int]] = defaultdict(list)  # in the stack, by tag

    def push(tag: str) -> None:
        places[tag].append(len(stack))
        stack.append(tag)

    def close_to(depth: int) -> Iterator[tuple[str, str, dict[str, str]]]:
        while len(stack) > depth:
            places[stack[-1]].pop()
            yield "close", stack.pop(), {}

    def last(tags: frozenset) -> int:
        return max((places[t][-1] for t in tags if places.get(t)), default=-1)

    def nearest(tags: frozenset, fence: frozenset) -> int:
        """The depth of the innermost open element of ``tags`` that no ``fence`` hides, or -1."""
        found = last(tags)
        return found if found > last(fence) or found >= 0 and stack[found] in fence and found == last(fence) else -1

    def foreign() -> int:
        """The depth of the innermost svg or math if what comes next belongs to it, or -1."""
        found = last(FOREIGN)
        return found if found > last(INTEGRATION) else -1

    def start(tag: str, attrs: dict[str, str]) -> Iterator[tuple[str, str, dict[str, str]]]:
        while tag in BREAKOUT and (outer := foreign()) >= 0:
            yield from close_to(outer)
        if tag not in BODY_STARTS and (head := nearest(frozenset(["head"]), frozenset(["body"]))) >= 0:
            yield from close_to(head)
        if tag in CLOSES_P and (p := nearest(frozenset(["p"]), FENCE | {"button"})) >= 0:
            yield from close_to(p)
        if tag in IMPLIED_END:
            tags, fence = IMPLIED_END[tag]
            while (i := nearest(tags, fence)) >= 0:
                yield from close_to(i)
        if tag in ("td", "th") and nearest(frozenset(["tr"]), frozenset(["table"])) < 0:
            yield from start("tr", {})
        if tag == "tr" and nearest(frozenset(["thead", "tbody", "tfoot"]), frozenset(["table"])) < 0 and places["table"]:
            push("tbody")
            yield "open", "tbody", {}
        if tag in ("html", "body") and places[tag]:
            return
        yield "open", tag, attrs
        if tag in VOID:
            yield "close", tag, {}
        else:
            push(tag)

    at = 0
    while at < len(page):
        token = TOKEN.search(page, at)
        text = page[at: token.start() if token else len(page)]
        if text:
            if text.strip(" \t\n\f\r") and (head := nearest(frozenset(["head"]), frozenset(["body"]))) >= 0:
                yield from close_to(head)
            yield "text", html.unescape(text), {}
        if not token:
            break
        at = token.end()
        end, begin = token[1], token[2]
        if begin:
            tag = begin.lower()
            lone = token[3].endswith("/") and tag not in BREAKOUT and (tag in FOREIGN or foreign() >= 0)
            yield from start(tag, attributes(token[3]) if token[3] else {})
            if lone:
                if tag not in VOID:
                    yield from close_to(len(stack) - 1)
            elif tag in RAW:
                stop = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(page, at)
                raw = page[at: stop.start() if stop else len(page)]
                yield "text", html.unescape(raw) if tag in ("textarea", "title") else raw, {}
                at = stop.start() if stop else len(page)
        elif end:
            tag = end.lower()
            if tag == "br":
                yield from start("br", {})
            elif tag == "p" and nearest(frozenset(["p"]), FENCE) < 0:
                yield from start("p", {})
                yield from close_to(len(stack) - 1)
            elif (i := nearest(frozenset([tag]), FENCE - {tag} - (CELLS if tag in TABLE_PARTS else NONE))) >= 0:
                yield from close_to(i)
    yield from close_to(0)


class Block:
    """A column of lines in the making."""

    def __init__(self):
        self.lines: list[str] = []
        self.run: list[str] = []
        self.space = False
        self.gap = 0
        self.indent: list[str] = []
        self.marker = ""

    def word(self, text: str) -> None:
        if self.space and self.run:
            self.run.append(" ")
        self.space = False
        self.run.append(text)

    def line(self, keep_empty: bool = False) -> None:
        """Ends the current line, if there is one."""
        text = "".join(self.run)
        if text or keep_empty:
            self.put(text)
        self.run, self.space = [], False

    def put(self, text: str) -> None:
        if self.gap and self.lines:
            self.lines.extend([""] * self.gap)
        self.gap = 0
        prefix = "".join(self.indent)
        if self.marker:
            prefix, self.marker = prefix[: len(prefix) - len(self.marker)] + self.marker, ""
        self.lines.append((prefix + text).rstrip(" "))

    def margin(self, lines: int) -> None:
        self.line()
        self.gap = max(self.gap, lines)


def grid_lines(rows: list[list[tuple[list[str], int, int]]], groups: list[int], between: str = "  ") -> list[str]:
    """The lines of a table: cells of a column start at the same place; a cell may have many lines.

    A cell is its lines, the columns and the rows it spans (0: all that are left); ``groups`` are the first rows of row
    groups, which no cell reaches across. Columns that a cell from above holds are passed over.
    """
    placed: list[list[tuple[int, list[str], int]]] = []
    taken: dict[int, int] = {}  # the row at which a column is free again
    ends = sorted({*groups, len(rows)})
    for at, row in enumerate(rows):
        end = next(e for e in ends if e > at)
        col, here = 0, []
        for lines, span, down in row:
            while busy := [c for c in range(col, col + span) if taken.get(c, 0) > at]:
                col = busy[-1] + 1
            here.append((col, lines, span))
            if down != 1:
                taken.update(dict.fromkeys(range(col, col + span), min(end, at + down) if down else end))
            col += span
        placed.append(here)
    widths = [0] * max((col + span for row in placed for col, _, span in row), default=0)
    for spanning in (False, True):
        for row in placed:
            for col, lines, span in row:
                if spanning == (span > 1):
                    have = sum(widths[col: col + span]) + len(between) * (span - 1)
                    widths[col + span - 1] += max(0, max(map(len, lines), default=0) - have)
    starts = [0]
    for width in widths:
        starts.append(starts[-1] + width + len(between))
    out = []
    for row in placed:
        for k in range(max((len(lines) for _, lines, _ in row), default=0)):
            line = ""
            for col, lines, _ in row:
                line = line.ljust(starts[col]) + (lines[k] if k < len(lines) else "")
            out.append(line.rstrip(" "))
    return out


class Layout:
    def __init__(self):
        self.blocks = [Block()]
        self.tables: list[list[list[tuple[list[str], int, int]]]] = []
        self.groups: list[list[int]] = []  # of each open table, the first rows of its row groups
        self.spans: list[tuple[int, int]] = []
        self.lists: list[list] = []
        # tag, gone, unseen, pre, did something, and where: in "svg" (its stray text is not shown), "label" (a text
        # element of svg), "math", "closed" (details of which only the summary shows) or ""
        self.open: list[tuple[str, bool, bool, bool | str, bool, str]] = []

    def visible(self) -> bool:
        return not self.open or not (self.open[-1][1] or self.open[-1][2] or self.open[-1][5] in ("svg", "closed"))

    def start(self, tag: str, attrs: dict[str, str]) -> None:
        gone, unseen, pre = self.open[-1][1:4] if self.open else (False, False, False)
        where = outer = self.open[-1][5] if self.open else ""
        if tag in FOREIGN:
            where = tag
        elif where in ("svg", "label") and tag in ("text", "foreignobject"):
            where = "label" if tag == "text" else ""
        folded = where == "closed"
        if folded:
            where = outer = ""
        if tag == "details" and "open" not in attrs:
            where = "closed"
        style = declarations(attrs["style"]) if "style" in attrs else {}
        gone = (
            gone or tag in HIDDEN or "hidden" in attrs or style.get("display") == "none" or (folded and tag != "summary")
            or (tag == "input" and attrs.get("type", "").lower() == "hidden") or (tag == "dialog" and "open" not in attrs)
            or (outer and tag in HIDDEN_FOREIGN)
        )
        if style.get("visibility") in ("hidden", "collapse", "visible"):
            unseen = style["visibility"] != "visible"
        pre = PRE.get(style.get("white-space"), pre or tag in ("pre", "textarea", "xmp"))
        acts = not gone
        inside = self.open[-1][0] if self.open else ""
        self.open.append((tag, gone, unseen, pre, acts, where))
        if not acts:
            return
        block = self.blocks[-1]
        if outer and (tag in APART or inside == "mfrac" or tag == "tspan" and not attrs.keys().isdisjoint(("x", "y", "dy"))):
            block.space = True
        if tag == "br":
            block.line(keep_empty=True)
        elif tag == "hr":
            block.margin(1)
            block.put("---")
            block.gap = 1
        elif tag in ("td", "th"):
            if self.tables:
                span, down = attrs.get("colspan", "1"), attrs.get("rowspan", "1")
                self.spans.append((
                    min(1000, max(1, int(span))) if re.fullmatch("[0-9]{1,9}", span) else 1,
                    min(65534, int(down)) if re.fullmatch("[0-9]{1,9}", down) else 1,
                ))
                self.blocks.append(Block())
            else:
                block.margin(0)
        elif tag == "tr":
            if self.tables:
                self.tables[-1].append([])
            else:
                block.margin(0)
        elif tag == "table":
            block.margin(1)
            self.tables.append([])
            self.groups.append([])
        elif tag in BLOCK:
            if tag in ("thead", "tbody", "tfoot") and self.tables:
                self.groups[-1].append(len(self.tables[-1]))
            block.margin(1 if tag in SPACED and not (tag in ("ul", "ol") and self.lists) else 0)
            if tag in ("ul", "ol"):
                first = attrs.get("start", "1")
                self.lists.append([tag, int(first) if WHOLE.fullmatch(first) else 1, -1 if "reversed" in attrs and "start" in attrs else 1])
            elif tag == "li":
                kind = self.lists[-1] if self.lists else ["ul", 1, 1]
                if WHOLE.fullmatch(attrs.get("value", "")):
                    kind[1] = int(attrs["value"])
                block.marker = "- " if kind[0] == "ul" else f"{kind[1]}. "
                kind[1] += kind[2]
                block.indent.append(" " * len(block.marker))
            elif tag in ("blockquote", "dd"):
                block.indent.append("    ")

    def end(self, tag: str) -> None:
        acts = self.open.pop()[4]
        if not acts:
            return
        if tag in APART and self.open and self.open[-1][5]:
            self.blocks[-1].space = True
        if tag in ("td", "th") and self.tables:
            cell = self.blocks.pop()
            cell.line()
            if not self.tables[-1]:
                self.tables[-1].append([])
            self.tables[-1][-1].append((cell.lines, *self.spans.pop()))
        elif tag == "table":
            rows, groups = self.tables.pop(), self.groups.pop()
            block = self.blocks[-1]
            block.line()
            for line in grid_lines(rows, groups):
                block.put(line)
            block.margin(1)
        elif tag in BLOCK and tag != "tr":
            block = self.blocks[-1]
            block.margin(1 if tag in SPACED and not (tag in ("ul", "ol") and len(self.lists) > 1) else 0)
            if tag in ("ul", "ol") and self.lists:
                self.lists.pop()
            elif tag in ("li", "blockquote", "dd") and block.indent:
                block.indent.pop()
                block.marker = ""

    def text(self, data: str) -> None:
        if not self.visible():
            return
        block = self.blocks[-1]
        if self.open and self.open[-1][3] == "lines":
            for i, part in enumerate(data.replace("\r\n", "\n").replace("\r", "\n").split("\n")):
                if i:
                    block.line(keep_empty=True)
                words = WORDS.findall(part)
                if words:
                    block.space = block.space or part[0] in " \t\f"
                    block.word(" ".join(words))
                    block.space = part[-1] in " \t\f"
            return
        if self.open and self.open[-1][3]:
            parts = data.replace("\r\n", "\n").replace("\r", "\n").split("\n")
            for i, part in enumerate(parts):
                if i:
                    block.line(keep_empty=True)
                if part:
                    block.word(part)
            return
        words = WORDS.findall(data)
        if not words:
            block.space = block.space or bool(data)
            return
        block.space = block.space or data[0] in " \t\n\f\r"
        block.word(" ".join(words))
        block.space = data[-1] in " \t\n\f\r"


def render(page: str | None) -> str:
    """The visible text of a page; a page without any is empty."""
    layout = Layout()
    for kind, value, attrs in events(page or ""):
        if kind == "open":
            layout.start(value, attrs)
        elif kind == "close":
            layout.end(value)
        else:
            layout.text(value)
    block = layout.blocks[0]
    block.line()
    return "\n".join(block.lines).strip("\n")


def extract_text(pages: DataFrame, html_column: str = "html", column: str = "text") -> tuple[DataFrame, str]:
    """``pages`` with one more column, the laid-out visible text, and its name (underscores in front if taken).

    A null or empty page has empty text. Rows, also repeated ones, and other columns stay as they are.
    """
    name = free_name(pages, column)
    place = pages.columns.index(html_column)
    schema = f"{pages._jdf.schema().toDDL()}, `{name}` string"

    def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [render(v.as_py()) for v in batch.column(place).cast(pa.string())]
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, name])

    return map_batches(pages, fn, schema), name
