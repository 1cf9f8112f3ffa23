"""Text of web pages as a reader sees it.

A small tree builder takes markup as it comes: void and raw-text elements,
end tags that are implied (paragraphs, list items, table cells, options) or
missing, stray end tags.  Visibility rules drop what is not shown: head,
scripts, templates, ``hidden``, inline styles and simple style-sheet rules
(those for the screen at any size; of one selector the last one counts).
The layout then emits all visible text: blocks on lines of their own, one
blank line around paragraphs and headings, list items with bullets or
numbers indented by depth, table cells aligned in columns, preformatted
text as it is.

Null html: null text.  Rows without a page_id and repeated rows are rendered
like any other; an empty table gives no rows; further columns are ignored.
Builder and layout use explicit stacks, so deep nesting does not fail.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railyard.llm.common import own_columns, python_batches

# fixed values: element classes of the HTML standard
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
HIDDEN = frozenset("head script style template noscript iframe object audio video canvas datalist "
                   "noembed noframes title meta link desc metadata defs symbol annotation annotation-xml".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl blockquote pre table figure form fieldset".split())
BLOCK = SPACED | frozenset("html body div article section nav header footer main aside address li dt dd tr caption "
                           "thead tbody tfoot hr figcaption details summary legend option select center".split())
CLOSES_P = BLOCK - frozenset("html body li dt dd tr caption thead tbody tfoot option select summary legend".split())
# what a start tag ends, and the elements that this does not reach beyond
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"table", "thead", "tbody", "tfoot"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "thead": ({"caption", "colgroup", "thead", "tbody", "tfoot"}, {"table"}),
    "tbody": ({"caption", "colgroup", "thead", "tbody", "tfoot"}, {"table"}),
    "tfoot": ({"caption", "colgroup", "thead", "tbody", "tfoot"}, {"table"}),
    "option": ({"option"}, {"select", "datalist", "optgroup"}), "optgroup": ({"option", "optgroup"}, {"select"}),
    "body": ({"head"}, {"html"}),
}
P_SCOPE = frozenset("html body div article section nav header footer main aside td th li dd table button "
                    "blockquote form".split())
END_SCOPE = {"li": {"ul", "ol"}, "td": {"table"}, "th": {"table"}, "tr": {"table"}, "p": P_SCOPE,
             "dt": {"dl"}, "dd": {"dl"}}

_TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)|</([A-Za-z][^\s/>]*)[^>]*(?:>|\Z)"
    r"|<([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_HIDING = re.compile(r"(?i)display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse)")
_COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)|\"(?:[^\"\\\n]|\\.)*\"|'(?:[^'\\\n]|\\.)*'", re.S)   # and strings
_PART = re.compile(r"([^{};]*)([{};]|\Z)")
_MEDIA = re.compile(r"(?i)(?:only\s+)?(?:all|screen)")
_SIMPLE = re.compile(r"[.#]?[A-Za-z][\w-]*|[a-z][a-z0-9]*\.[\w-]+")
_SPACE = re.compile(r"[ \t\n\f\r]+")


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.children = tag, attrs, []


def _attributes(source: str) -> dict[str, str]:
    if not source.strip(" /"):
        return {}
    out: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(source):
        out.setdefault(m[1].lower(), entities.unescape(m[2] or m[3] or m[4] or ""))
    return out


def _on_screen(media: str) -> bool:
    """Whether a media query list holds for every ordinary screen."""
    return not media.strip() or any(_MEDIA.fullmatch(x.strip()) for x in media.split(","))


def _style_rules(css: str, states: dict[tuple[str, str], tuple[bool, bool]]) -> None:
    """Enter what a style sheet says of simple selectors into ``states``:
    (selector, property) to (important, hides)."""
    open_blocks: list[tuple[bool, list[str] | None]] = []      # rules in it count; its selectors
    for m in _PART.finditer(_COMMENT.sub(" ", css)):
        part, mark = m[1].strip(), m[2]
        counts, own = open_blocks[-1] if open_blocks else (True, None)
        if mark == "{":
            if part.startswith("@"):
                name, _, rest = part.partition(" ")
                name, bracket, more = name.partition("(")
                name, rest = name.lower(), bracket + more + rest
                inside = name == "@layer" or (name == "@media" and _on_screen(rest)) or (
                    name == "@supports" and not rest.strip().lower().startswith("not"))
                open_blocks.append((counts and inside, None))
            else:
                open_blocks.append((counts and own is None, [
                    x for x in map(str.strip, part.split(",")) if _SIMPLE.fullmatch(x)]))
            continue
        if counts and own:
            name, _, value = part.partition(":")
            name, value = name.strip().lower(), value.strip().lower()
            if name in ("display", "visibility") and value:
                important = value.endswith("!important")
                hides = bool(_HIDING.match(f"{name}:{value}"))
                for x in own:
                    if important or not states.get((x, name), (False, False))[0]:
                        states[x, name] = (important, hides)
        if mark == "}" and open_blocks:
            open_blocks.pop()


def tree(html: str) -> tuple[Node, set[str]]:
    """Document tree, and the simple selectors that style sheets hide."""
    root = Node("#root", {})
    stack, at = [root], 0
    states: dict[tuple[str, str], tuple[bool, bool]] = {}

    places: dict[str, list[int]] = {}       # open elements of each name in the stack

    def up_to(tags, scope) -> None:
        def last(names) -> int:
            return max((places[x][-1] for x in names if places.get(x)), default=0)

        k = last(tags)
        if k and k >= last(scope):
            for node in reversed(stack[k:]):
                places[node.tag].pop()
            del stack[k:]

    def push(node: Node) -> None:
        places.setdefault(node.tag, []).append(len(stack))
        stack.append(node)

    def text(s: str) -> None:
        if s:
            stack[-1].children.append(entities.unescape(s) if "&" in s else s)

    while at < len(html):
        m = _TOKEN.search(html, at)
        if not m:
            text(html[at:])
            break
        text(html[at:m.start()])
        at = m.end()
        if m[1]:
            tag = m[1].lower()
            if tag == "br":
                stack[-1].children.append(Node("br", {}))
            elif tag not in VOID:
                up_to({tag}, END_SCOPE.get(tag, ()))
        elif m[2]:
            tag = m[2].lower()
            if tag in CLOSES_P and any(n.tag == "p" for n in stack[-8:]):
                up_to({"p"}, P_SCOPE)
            if tag in IMPLIED:
                up_to(*IMPLIED[tag])
            node = Node(tag, _attributes(m[3]))
            stack[-1].children.append(node)
            if tag in RAW:
                end = re.compile(rf"(?i)</{tag}\s*[^>]*>").search(html, at)
                body = html[at:end.start() if end else len(html)]
                at = end.end() if end else len(html)
                if tag == "style":
                    if _on_screen(node.attrs.get("media", "")):
                        _style_rules(body, states)
                elif tag in ("textarea", "title", "xmp"):
                    node.children.append(entities.unescape(body) if tag != "xmp" else body)
            elif tag not in VOID and not m[3].endswith("/"):
                push(node)
            elif tag not in VOID and tag in BLOCK:
                push(node)          # a slash does not close an HTML block
    return root, {x for (x, _), (_, hides) in states.items() if hides}


def shown(node: Node, hidden: set[str]) -> bool:
    tag, attrs = node.tag, node.attrs
    if tag in HIDDEN:
        return False
    if attrs:
        if "hidden" in attrs or (tag == "input" and attrs.get("type", "").lower() == "hidden"):
            return False
        if "style" in attrs and _HIDING.search(attrs["style"]):
            return False
        if tag == "dialog" and "open" not in attrs:
            return False
    if hidden:
        if tag in hidden or f"#{attrs.get('id', '')}" in hidden:
            return False
        names = attrs.get("class", "").split()
        if any(f".{c}" in hidden or f"{tag}.{c}" in hidden for c in names):
            return False
    return True


class Lines:
    """Output lines with pending breaks and collapsed spaces."""

    def __init__(self):
        self.lines: list[str] = []
        self.current: list[str] = []
        self.gap, self.lead, self.mark = 0, "", ""

    def end_line(self) -> None:
        line = "".join(self.current).rstrip(" ")
        self.current = []
        if line.strip():
            if self.gap > 1 and self.lines:
                self.lines.append("")
            self.lines.append(self.lead_of(line))
            self.gap = 0

    def lead_of(self, line: str) -> str:
        mark, self.mark = self.mark, ""
        if mark:
            return self.lead[:len(self.lead) - len(mark)] + mark + line
        return self.lead + line

    def block(self, gap: int) -> None:
        self.end_line()
        self.gap = max(self.gap, gap)

    def inline(self, s: str) -> None:
        s = _SPACE.sub(" ", s)
        if not self.current or self.current[-1].endswith(" "):
            s = s.lstrip(" ")
        if s:
            self.current.append(s)

    def text(self) -> str:
        self.end_line()
        return "\n".join(self.lines)


def _table(rows: list[list[tuple[str, int]]]) -> list[str]:
    """Rows of (cell, columns it spans), each column as wide as it needs."""
    width: list[int] = []
    for row in rows:
        k = 0
        for cell, span in row:
            width += [0] * (k + span - len(width))
            if span == 1:
                width[k] = max(width[k], len(cell))
            k += span
    out = []
    for row in rows:
        line, k = "", 0
        for cell, span in row:
            room = sum(width[k:k + span]) + 2 * (span - 1)
            line += cell.ljust(room) + "  "
            k += span
        out.append(line.rstrip())
    return out


def render(html: str) -> str:
    """All visible text of a page, laid out."""
    root, hidden = tree(html)
    out = Lines()
    frames: list[Lines] = []
    lists: list[list] = []              # [ordered, number]
    tables: list[list[list[tuple[str, int]]]] = []
    pre = 0
    todo: list[tuple] = [(root, False)]
    while todo:
        node, leave = todo.pop()
        if isinstance(node, str):
            if pre:
                parts = node.split("\n")
                for i, part in enumerate(parts):
                    if i:
                        line = "".join(out.current)
                        out.current = []
                        if out.lines or line.strip():
                            if out.gap > 1 and out.lines:
                                out.lines.append("")
                            out.gap = 0
                            out.lines.append(out.lead_of(line))
                    out.current.append(part)
            else:
                out.inline(node)
            continue
        tag = node.tag
        cell = tag in ("td", "th") and bool(tables)
        if leave:
            if cell:
                done, out = out.text(), frames.pop()
                span = node.attrs.get("colspan", "1")
                if not tables[-1]:
                    tables[-1].append([])
                tables[-1][-1].append((_SPACE.sub(" ", done), min(100, max(1, int(span))) if span.isdecimal()
                                       and len(span) < 4 else 1))
            elif tag == "table":
                rows = tables.pop()
                for line in _table([r for r in rows if any(c for c, _ in r)]):
                    out.current = [line]
                    out.end_line()
                out.block(2)
            elif tag in ("ul", "ol") and lists:
                lists.pop()
                out.block(1 if lists else 2)
                out.lead = out.lead[:-2]
            elif tag == "li" and lists:
                out.block(1)
                out.mark = ""
            elif tag == "blockquote":
                out.block(2)
                out.lead = out.lead[:-2]
            elif tag == "pre":
                out.block(2)
                pre -= 1
            elif tag in BLOCK:
                out.block(2 if tag in SPACED else 1)
            continue
        if not shown(node, hidden):
            continue
        if tag == "br":
            out.end_line()
            continue
        if cell:
            frames.append(out)
            out = Lines()
        elif tag == "table":
            out.block(2)
            tables.append([])
        elif tag == "tr" and tables:
            tables[-1].append([])
        elif tag in ("ul", "ol"):
            out.block(1 if lists else 2)
            start = node.attrs.get("start", "1")
            lists.append([tag == "ol", int(start) if start.isdecimal() and len(start) < 9 else 1])
            out.lead += "  "
        elif tag == "li" and lists:
            out.block(1)
            ordered, number = lists[-1]
            out.mark = f"{number}. " if ordered else "- "
            lists[-1][1] += 1
        elif tag == "blockquote":
            out.block(2)
            out.lead += "  "
        elif tag == "pre":
            out.block(2)
            pre += 1
        elif tag == "hr":
            out.block(2)
        elif tag == "text":
            out.inline(" ")             # pieces of a drawing stand apart
        elif tag in BLOCK:
            out.block(2 if tag in SPACED else 1)
        if tag not in VOID:
            todo.append((node, True))
            todo += [(c, False) for c in reversed(node.children)]
    return out.text()


def rendered(pages: DataFrame) -> DataFrame:
    """page_id, url and text of every page."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [h if h is None else render(h) for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())],
                                             ["page_id", "url", "text"])

    python_batches(pages.sparkSession, 1000)
    rows = own_columns(pages, "page_id", "url", "html").select(
        F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return rows.mapInArrow(run, "page_id long, url string, text string")
