"""Visible text of web pages, laid out as a browser would (operator 10).

A page becomes a tree (implied and forgotten tags, as the HTML standard has them), the tree a sequence of lines: blocks begin on lines of their own with a blank line
where browsers have a margin, list items are marked, indented and numbered, table cells are aligned in columns. What a browser does not show on a wide screen is left out; of the page's own style sheets
rules with selectors of one element count. Of a drawing its text elements are shown, and all of a formula but annotations.
"""

from __future__ import annotations

import html
import re
import unicodedata
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed sets of elements, by the HTML standard and its default style sheet.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes noscript textarea title".split())
DECODED = frozenset(("textarea", "title"))
HIDDEN = frozenset("head script style template title meta link base noscript iframe noembed noframes datalist param source track area audio video canvas object annotation annotation-xml".split())
#: what of a drawing is shown as text
DRAWN = frozenset("text foreignobject".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table ul xmp caption".split()
)
MARGIN = frozenset("blockquote dl figure h1 h2 h3 h4 h5 h6 hr ol p pre ul menu dir xmp".split())
LISTS = frozenset("ul ol menu dir".split())
CLOSES_P = BLOCK - {"body", "html", "option", "optgroup", "legend", "caption", "dd", "dt", "li"}
HEAD_ONLY = frozenset("base link meta title style script noscript template head html".split())
#: what a start tag ends, and the elements beyond which it does not look
ENDS = {
    "li": ({"li"}, LISTS), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select", "datalist", "optgroup"}),
    "optgroup": ({"option", "optgroup"}, {"select"}), "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"table", "tbody", "thead", "tfoot"}), "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}), "tbody": ({"tbody", "thead", "tfoot", "tr", "caption", "colgroup"}, {"table"}), "thead": ({"tbody", "thead", "tfoot", "caption", "colgroup"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "tr", "caption", "colgroup"}, {"table"}), "body": ({"head"}, set()),
}
SCOPE = frozenset("table td th caption html template button object".split())
#: elements nest no deeper than this, as in browsers; what comes deeper is a sibling
DEPTH = 512

_MARKUP = re.compile(r"<(?=[a-zA-Z!?/])")
_COMMENT = re.compile(r"<!--(?:>|->|.*?(?:--!?>|\Z))|<[!?/][^>]*(?:>|\Z)", re.S)
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)((?:=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|[^>])*+)>", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_DECLARED = re.compile(r"(display|visibility)\s*:\s*([\w-]+)\s*(!\s*important)?", re.I)
_BRACE = re.compile(r"[{};]")
#: a selector of one element: its name, then ids and classes
_COMPOUND = re.compile(r"(\*|[a-zA-Z][\w-]*)?((?:[.#][\w-]+)*)\Z")
_UNSEEN = {"display": {"none"}, "visibility": {"hidden", "collapse"}}
_BLANKS = re.compile(r"[ \t\n\r\f]+")


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.children = tag, attrs, []


def tokens(page: str) -> Iterator[tuple[str, str, dict[str, str]]]:
    """("text", text, {}), ("start", tag, attributes) and ("end", tag, {}) in order. Script, style and the like have one text up to their end tag."""
    at = 0
    while at < len(page):
        begin = _MARKUP.search(page, at)
        if not begin:
            break
        if begin.start() > at:
            yield "text", html.unescape(page[at : begin.start()]), {}
        at = begin.start()
        if not page[at + 1 : at + 3].lstrip("/")[:1].isalpha():
            at = _COMMENT.match(page, at).end()
            continue
        found = _TAG.match(page, at)
        if not found:  # a tag that the page ends in is not shown
            return
        at, tag = found.end(), found[2].lower()
        if found[1]:
            yield "end", tag, {}
            continue
        attrs: dict[str, str] = {}
        for m in _ATTRIBUTE.finditer(found[3]):
            attrs.setdefault(m[1].lower(), html.unescape(next((v for v in m.group(2, 3, 4) if v is not None), "")))
        yield "start", tag, attrs
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(page, at)
            inner = page[at : end.start() if end else len(page)]
            yield "text", html.unescape(inner) if tag in DECODED else inner, {}
            yield "end", tag, {}
            at = end.end() if end else len(page)
    if at < len(page):
        yield "text", html.unescape(page[at:]), {}


def build(page: str) -> Node:
    """The tree of a page."""
    root = Node("html", {})
    stack, open_tags = [root], {"html": 1}

    def pop() -> None:
        open_tags[stack.pop().tag] -= 1

    def close(tags, until) -> None:
        """End the nearest of the tags that is open, with all in it, unless one of ``until`` is nearer."""
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag in tags:
                while len(stack) > k:
                    pop()
                return
            if stack[k].tag in until:
                return

    def push(tag: str, attrs: dict[str, str]) -> None:
        node = Node(tag, attrs)
        stack[-1].children.append(node)
        if tag not in VOID:
            if len(stack) >= DEPTH:
                pop()
            stack.append(node)
            open_tags[tag] = open_tags.get(tag, 0) + 1

    for kind, value, attrs in tokens(page):
        if kind == "text":
            if open_tags.get("head") and value.strip() and stack[-1].tag == "head":
                close({"head"}, ())
            if value:
                stack[-1].children.append(value)
        elif kind == "start":
            if value == "html":
                root.attrs.update(attrs)
                continue
            if open_tags.get("head") and value not in HEAD_ONLY and stack[-1].tag == "head":
                close({"head"}, ())
            if value in CLOSES_P and open_tags.get("p"):
                close({"p"}, SCOPE)
            if value in ENDS:
                tags, until = ENDS[value]
                for _ in range(4):  # a cell, its row and its section may be open
                    before = len(stack)
                    if any(open_tags.get(t) for t in tags):
                        close(tags, until)
                    if len(stack) == before:
                        break
            if value in ("td", "th") and stack[-1].tag in ("table", "tbody", "thead", "tfoot"):
                push("tr", {})
            push(value, attrs)
        elif value == "br":
            push("br", {})
        elif value == "p" and not open_tags.get("p"):
            push("p", {})
            pop()
        elif open_tags.get(value) and value not in ("html", "body"):  # what comes after the body belongs to it
            close({value}, () if value in ("table", "head") else SCOPE - {value})
    return root


# --- layout ----------------------------------------------------------------------------------------------------------------


class Lines:
    """Lines under way. Blanks collapse; margins of blocks that meet become one blank line."""

    def __init__(self):
        self.done: list[str] = []
        self.line = ""
        self.indent = ""
        self.mark = ""
        self.margin = False

    def text(self, value: str, kept: bool) -> None:
        if kept:
            first, *others = value.replace("\r\n", "\n").split("\n")
            self._add(first)
            for part in others:
                self.end(True)
                self._add(part)
            return
        value = _BLANKS.sub(" ", value)
        if value[:1] == " " and (not self.line or self.line[-1] == " "):
            value = value[1:]
        self._add(value)

    def _add(self, value: str) -> None:
        if value and not self.line:
            if self.margin and self.done and self.done[-1]:
                self.done.append("")
            self.margin = False
            self.line = self.mark or self.indent
            self.mark = ""
        self.line += value

    def end(self, even_empty: bool = False) -> None:
        """End the line; an empty one counts only where it is asked for."""
        if self.line.strip():
            self.done.append(self.line.rstrip())
        elif even_empty:
            self.done.append("")
        self.line = ""

    def result(self) -> list[str]:
        self.end()
        while self.done and not self.done[-1]:
            self.done.pop()
        return self.done


def _width(text: str) -> int:
    return len(text) if text.isascii() else sum(0 if unicodedata.combining(c) else 1 + (unicodedata.east_asian_width(c) in "WF") for c in text)


class Table:
    """Cells of a table, each a list of lines, put in columns."""

    def __init__(self):
        self.rows: list[dict[int, tuple[list[str], int]]] = []
        self.taken: dict[int, int] = {}
        self.column = 0

    def row(self) -> None:
        self.rows.append({})
        self.taken = {c: n - 1 for c, n in self.taken.items() if n > 1}
        self.column = 0

    def cell(self, lines: list[str], wide: int, high: int) -> None:
        if not self.rows:
            self.row()
        while self.taken.get(self.column):
            self.column += 1
        self.rows[-1][self.column] = (lines, wide)
        if high > 1:
            self.taken.update({c: high for c in range(self.column, self.column + wide)})
        self.column += wide

    def lines(self) -> list[str]:
        """Columns as wide as their widest cell, two blanks apart; a cell over several columns stretches the last of them."""
        widths: dict[int, int] = {}
        for spanning in (False, True):
            for row in self.rows:
                for column, (own, wide) in row.items():
                    if own and (wide > 1) == spanning:
                        last = column + wide - 1
                        held = sum(widths[c] + 2 for c in range(column, last) if c in widths)
                        widths[last] = max(widths.get(last, 0), max(map(_width, own)) - held)
        columns = sorted(widths)
        before = [0, *accumulate(widths[c] + 2 for c in columns)]
        out = []
        for row in self.rows:
            cells = [(before[bisect_left(columns, c)], own) for c, (own, _) in sorted(row.items())]
            for k in range(max((len(own) for _, own in cells), default=0)):
                parts, at = [], 0
                for start, own in cells:
                    if k < len(own) and own[k]:
                        parts += [" " * (start - at), own[k]]
                        at = max(at, start) + _width(own[k])
                out.append("".join(parts).rstrip())
        return out


def _number(value: str | None, default: int) -> int:
    return int(value) if value and re.fullmatch(r"[+-]?\d{1,9}", value.strip()) else default


def _on_screen(at_rule: str) -> bool:
    """Whether a wide screen takes the rules inside an at-rule: media queries for it (of conditions, only least widths), layers and supported features."""
    name, _, rest = at_rule.strip().lower().partition(" ")
    if name != "@media":
        return name in ("@supports", "@layer", "@container", "@scope")
    for query in rest.split(","):
        parts = [p.strip() for p in re.split(r"\band\b", query)]
        if all(p in ("", "all", "screen", "only screen", "only all") or p.startswith("(min-width") for p in parts):
            return True
    return False


def _sheet_rules(sheet: str) -> Iterator[tuple[str, str]]:
    """(selectors, declarations) of a style sheet that count on a screen, in order; blocks may be nested, and what is not ended ends with the sheet."""
    sheet = re.sub(r"/\*.*?(?:\*/|\Z)|<!--|-->", "", sheet, flags=re.S)
    above: list[tuple[str, bool]] = []  # the open blocks, and whether rules inside count
    at, counts = 0, True
    for brace in [*_BRACE.finditer(sheet), None]:
        text = sheet[at : brace.start() if brace else len(sheet)]
        at = brace.end() if brace else len(sheet)
        if brace is not None and brace[0] == "{":
            head = text.strip()
            above.append((head, counts))
            counts = counts and (not head.startswith("@") or _on_screen(head))
            continue
        if counts and above and not above[-1][0].startswith("@") and text.strip():
            yield above[-1][0], text
        if brace is not None and brace[0] == "}" and above:
            counts = above.pop()[1]


class Styles:
    """What a page's own style sheets say of display and visibility, by the cascade: importance, then how telling a selector is, then order. Selectors of one element count (name, ids, classes)."""

    def __init__(self, sheets: list[str]):
        self.by_key: dict[str, list[tuple]] = {}
        order = 0
        for sheet in sheets:
            for selectors, declared in _sheet_rules(sheet):
                values = [(m[1].lower(), m[2].lower(), bool(m[3])) for m in _DECLARED.finditer(declared)]
                for selector in selectors.split(",") if values else ():
                    found = _COMPOUND.match(selector.strip())
                    if not found or not selector.strip():
                        continue
                    name, marks = (found[1] or "*").lower(), re.findall(r"[.#][\w-]+", found[2])
                    weight = sum(100 if m[0] == "#" else 10 for m in marks) + (name != "*")
                    # filed under one of its parts, so that an element looks at few rules
                    key = marks[-1] if marks else name
                    for value in values:
                        order += 1
                        self.by_key.setdefault(key, []).append((name, frozenset(marks), weight, order, *value))

    def unseen(self, node: Node) -> bool:
        own = {"#" + node.attrs["id"]} if "id" in node.attrs else set()
        own |= {"." + c for c in node.attrs.get("class", "").split()}
        best: dict[str, tuple] = {}
        for key in (*own, node.tag, "*") if self.by_key else ():
            for name, marks, weight, order, what, value, important in self.by_key.get(key, ()):
                if name in ("*", node.tag) and marks <= own:
                    best[what] = max(best.get(what, (False, -1, -1, "")), (important, weight, order, value))
        for m in _DECLARED.finditer(node.attrs.get("style", "")):
            best[m[1].lower()] = max(best.get(m[1].lower(), (False, -1, -1, "")), (bool(m[3]), 1 << 30, m.start(), m[2].lower()))
        return any(value[3] in _UNSEEN[what] for what, value in best.items())


def _drawn(node: Node) -> list[Node]:
    """The text elements of a drawing, in order."""
    out, todo = [], [c for c in reversed(node.children) if isinstance(c, Node)]
    while todo:
        child = todo.pop()
        if child.tag in DRAWN:
            out.append(child)
        elif child.tag not in ("defs", "symbol", "mask", "clippath"):
            todo += [c for c in reversed(child.children) if isinstance(c, Node)]
    return out


def render(page: str) -> str:
    """The visible text of a page."""
    root = build(page)
    sheets, todo = [], [root]
    while todo:
        node = todo.pop()
        if node.tag == "style":
            sheets += [c for c in node.children if isinstance(c, str)]
        todo += [c for c in node.children if isinstance(c, Node)]
    styles = Styles(sheets[::-1])

    def hidden(node: Node) -> bool:
        a = node.attrs
        if node.tag in HIDDEN or "hidden" in a or (node.tag == "dialog" and "open" not in a) or (node.tag == "input" and a.get("type", "").lower() == "hidden"):
            return True
        return styles.unseen(node)

    out, kept = Lines(), 0
    outs, tables, counters = [], [], []
    work: list[tuple] = [("enter", root)]
    while work:
        step, node, *rest = work.pop()
        if step == "text":
            if tables and rest[0] in ("table", "tr", "tbody", "thead", "tfoot") and not node.strip():
                continue
            out.text(node, kept > 0)
        elif step == "enter":
            tag, a = node.tag, node.attrs
            if hidden(node):
                continue
            children = _drawn(node) if tag == "svg" else node.children
            if tag == "details" and "open" not in a:
                children = [c for c in children if isinstance(c, Node) and c.tag == "summary"][:1]
            if tag == "select" and "multiple" not in a:  # shows its chosen option, else the first
                groups = [c for c in children if isinstance(c, Node)]
                options = [c for g in groups for c in ([g] if g.tag == "option" else g.children) if isinstance(c, Node)]
                children = next((c for c in options if "selected" in c.attrs), options[0]).children if options else []
            state = (out.indent, kept)
            if tag == "br":
                out.end(not out.line.strip())
                continue
            if tag == "input":
                if a.get("type", "text").lower() in ("text", "submit", "button", "reset", "search", "email", "url", "tel", "number", ""):
                    out.text(a.get("value", ""), False)
                continue
            if tag in BLOCK:
                out.end()
                nested = tag in LISTS and bool(counters)
                out.margin |= tag in MARGIN and not nested
            if tag == "hr":
                out.text("---", False)
                out.end()
                out.margin = True
                continue
            if tag in ("pre", "textarea", "xmp"):
                kept += 1
                if children and isinstance(children[0], str):
                    children = [children[0][children[0].startswith("\n") :], *children[1:]]
            if tag in LISTS:
                counters.append([tag == "ol", _number(a.get("start"), 1), -1 if "reversed" in a and tag == "ol" else 1])
                if tag == "ol" and "reversed" in a and "start" not in a:
                    counters[-1][1] = sum(isinstance(c, Node) and c.tag == "li" for c in children)
            elif tag == "li":
                own = counters[-1] if counters else [False, 1, 1]
                own[1] = _number(a.get("value"), own[1])
                mark = f"{own[1]}. " if own[0] else "- "
                own[1] += own[2]
                out.mark, out.indent = out.indent + mark, out.indent + " " * len(mark)
            elif tag in ("blockquote", "dd"):
                out.indent += "    "
            elif tag == "table":
                tables.append(Table())
            elif tag == "tr" and tables:
                tables[-1].row()
            elif tag in ("td", "th") and tables:
                outs.append((out, counters))
                out, counters = Lines(), []
            work.append(("leave", node, state))
            work += [("text", c, tag) if isinstance(c, str) else ("enter", c) for c in reversed(children)]
        else:
            tag, (indent, kept) = node.tag, rest[0]
            if tag in ("td", "th") and tables:
                lines = out.result()
                out, counters = outs.pop()
                tables[-1].cell(lines, min(1000, max(1, _number(node.attrs.get("colspan"), 1))), min(65534, max(1, _number(node.attrs.get("rowspan"), 1))))
                continue
            if tag == "table" and tables:
                for line in tables.pop().lines():
                    if line:
                        out.text(line, True)
                    out.end(not line)
            if tag in BLOCK:
                out.end()
                out.margin |= tag in MARGIN and not (tag in LISTS and len(counters) > 1)
                if tag == "li":
                    out.mark = ""
            if tag in LISTS:
                counters.pop()
            out.indent = indent
    return "\n".join(out.result())


def extract_text(pages: DataFrame, html_column: str = "html", into: str = "text") -> DataFrame:
    """Every page with its visible text in ``into``. A null page has null text, an empty one and one without visible text an empty text.

    Broken markup never fails: what cannot be a tag is text, what is not ended ends with the page. Repeated rows have equal results; a column of the name ``into`` is replaced, others are kept.
    """

    @F.pandas_udf("string")
    def text_of(column):
        return column.map(lambda page: None if page is None else render(page))

    return pages.select(*[F.col(f"`{c}`") for c in pages.columns if c != into], text_of(F.col(f"`{html_column}`").cast("string")).alias(into))


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The visible text of every page."""
    found = extract_text(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"), (F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1).cast("bigint").alias("n_lines"))
