"""Layout-aware text of web pages: a tree builder with implied tags, and a renderer of what is visible."""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element classes of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp".split())
HIDDEN = frozenset("script style head title template noscript iframe object svg math datalist noembed noframes audio video canvas select textarea".split())
BLOCK = frozenset(("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
                   "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table ul").split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl table pre blockquote figure".split())
#: Opening one of these ends an open paragraph.
ENDS_P = BLOCK - {"body", "html", "li", "dd", "dt", "legend", "summary"}
#: Opening the key ends an open element of the values, up to the border.
IMPLIED = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
           "tr": ({"tr", "td", "th", "caption"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
           "thead": ({"tr", "td", "th", "thead", "tbody", "tfoot", "caption"}, {"table"}),
           "tbody": ({"tr", "td", "th", "thead", "tbody", "tfoot", "caption"}, {"table"}),
           "tfoot": ({"tr", "td", "th", "thead", "tbody", "tfoot", "caption"}, {"table"}), "option": ({"option"}, {"select"})}
#: A closing tag reaches no further than these.
SCOPE = frozenset("table td th caption html".split())
DEEPEST = 40

_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|$)|'[^']*(?:'|$))*)>?|[^<]+|<", re.S)
_ATTR = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(\"[^\"]*\"?|'[^']*'?|[^\s>]+))?")
_BLANK = re.compile(r"[ \t\n\r\f]+")
_NOT_SEEN = re.compile(r"(?:display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse))", re.I)


_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I) for tag in RAW}


class Node:
    __slots__ = ("tag", "kids", "hidden", "span")

    def __init__(self, tag: str, hidden: bool = False, span: int = 1):
        self.tag, self.kids, self.hidden, self.span = tag, [], hidden, span


def _attributes(raw: str) -> dict[str, str]:
    return {k.lower(): html.unescape(v.strip("\"'")) for k, v in _ATTR.findall(raw)}


class _Stack:
    """Open elements, innermost last."""

    def __init__(self, root: Node):
        self.open, self.counts = [root], Counter({root.tag: 1})

    @property
    def top(self) -> Node:
        return self.open[-1]

    def holds(self, tag: str) -> bool:
        return self.counts[tag] > (tag == "html")

    def push(self, node: Node) -> None:
        self.open.append(node)
        self.counts[node.tag] += 1

    def pop(self) -> None:
        self.counts[self.open.pop().tag] -= 1

    def close(self, tags: set[str] | frozenset[str], border: set[str] | frozenset[str], innermost: bool = False) -> bool:
        """End elements of ``tags`` up to the outermost one (or the innermost), no further than ``border``."""
        found = 0
        if any(self.counts[t] for t in tags):
            for i in range(len(self.open) - 1, 0, -1):
                if self.open[i].tag in tags:
                    found = i
                    if innermost:
                        break
                elif self.open[i].tag in border:
                    break
        if found:
            for x in self.open[found:]:
                self.counts[x.tag] -= 1
            del self.open[found:]
        return bool(found)


def parse(page: str) -> Node:
    """The tree of a page; text nodes are strings. No input is refused."""
    root = Node("html")
    stack = _Stack(root)
    at, n = 0, len(page)
    while at < n:
        m = _TOKEN.match(page, at)
        at = m.end()
        tag = m[2]
        if tag is None:
            text = m[0]
            if text[0] != "<" or len(text) == 1:
                stack.top.kids.append(html.unescape(text))
            continue
        tag = tag.lower()
        if m[1]:
            border = frozenset() if tag in ("table", "tr", "tbody", "thead", "tfoot", "body", "html") else SCOPE
            if not stack.close({tag}, border, innermost=True) and tag == "p":  # a stray end tag is an empty paragraph
                stack.top.kids.append(Node("p"))
            continue
        if tag in ("html", "body") and stack.holds(tag):
            continue
        if tag in ENDS_P and tag != "table":
            stack.close({"p"}, SCOPE)
        if tag in IMPLIED:
            stack.close(*IMPLIED[tag])
        if stack.top.tag == "head" and tag not in RAW and tag not in VOID and tag != "template":
            stack.pop()
        if tag in ("td", "th") and stack.top.tag in ("table", "tbody", "thead", "tfoot"):
            row = Node("tr")
            stack.top.kids.append(row)
            stack.push(row)
        raw = m[3]
        own = _attributes(raw) if "=" in raw or "hidden" in raw else {}
        hidden = tag in HIDDEN or "hidden" in own or own.get("aria-hidden") == "true" or bool(_NOT_SEEN.search(own.get("style", "")))
        width = own.get("colspan", "")
        node = Node(tag, hidden, min(int(width), 1000) if width.isdigit() and width.isascii() and len(width) < 6 and int(width) else 1)
        stack.top.kids.append(node)
        if tag in RAW:
            end = _RAW_END[tag].search(page, at)
            at = end.end() if end else n
        elif tag not in VOID:
            stack.push(node)
    return root


class _Out:
    """Lines of output; blanks between inline pieces are one, block borders are line ends."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.parts: list[str] = []
        self.gap, self.blank, self.first = False, False, ""

    def text(self, s: str) -> None:
        words = _BLANK.split(s)
        if len(words) > 1 and not words[0]:
            self.gap = True
        body = " ".join(w for w in words if w)
        if not body:
            self.gap = self.gap or bool(s)
            return
        if self.parts and self.gap:
            self.parts.append(" ")
        self.parts.append(body)
        self.gap = not words[-1]

    def line(self) -> None:
        self.gap = False
        if self.parts:
            if self.blank and self.lines:
                self.lines.append("")
            self.blank = False
            self.lines.append(self.first + "".join(self.parts))
            self.parts, self.first = [], ""

    def space(self) -> None:
        self.line()
        self.blank = True

    def whole(self, lines: list[str]) -> None:
        """Finished lines of an inner layout."""
        self.line()
        if any(lines):
            if self.blank and self.lines:
                self.lines.append("")
            self.blank = False
            self.lines += [self.first + x if k == 0 else x for k, x in enumerate(lines)]
            self.first = ""


def _preformatted(node: Node) -> str:
    parts, todo = [], [node]
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            parts.append(x)
        elif x.tag == "br":
            parts.append("\n")
        elif not x.hidden:
            todo += reversed(x.kids)
    return "".join(parts).strip("\n")


def render(node: Node, depth: int = 0) -> list[str]:
    """Lines of the visible text below a node: blocks apart, list items marked, table cells aligned.

    Lists and tables nested deeper than DEEPEST are laid out as plain blocks.
    """
    out = _Out()
    # (node, index of list item or None) to enter, or a tag to leave.
    todo: list[tuple[object, object]] = [(k, None) for k in reversed(node.kids)]
    while todo:
        x, mark = todo.pop()
        if isinstance(x, str):
            out.text(x) if mark != "leave" else (out.space() if x in SPACED else out.line())
            continue
        if x.hidden:
            continue
        if x.tag == "br":
            out.parts or out.lines and out.lines.append("")
            out.line()
            continue
        if x.tag == "hr":
            out.whole(["---"])
            continue
        if x.tag == "table" and depth < DEEPEST:
            out.space()
            out.whole(_table(x, depth + 1))
            out.space()
            continue
        if x.tag == "pre":
            out.space()
            out.whole([s.rstrip() for s in _preformatted(x).split("\n")])
            out.space()
            continue
        if x.tag in ("ul", "ol", "menu", "dir") and depth < DEEPEST:
            lines: list[str] = []
            number = 0
            apart = out.line if depth else out.space
            apart()
            for k in x.kids:
                if isinstance(k, Node) and k.tag == "li" and not k.hidden:
                    number += 1
                    head = f"{number}. " if x.tag == "ol" else "- "
                    inner = render(k, depth + 1) or [""]
                    lines += [(head if i == 0 else " " * len(head)) + s if s or i == 0 else s for i, s in enumerate(inner)]
                elif isinstance(k, Node) and not k.hidden:
                    lines += ["  " + s if s else s for s in render(_wrap(k), depth + 1)]
                elif isinstance(k, str) and k.strip():
                    lines.append("  " + " ".join(k.split()))
            out.whole([s.rstrip() for s in lines])
            apart()
            continue
        if x.tag in BLOCK:
            out.space() if x.tag in SPACED else out.line()
            todo.append((x.tag, "leave"))
        todo += [(k, None) for k in reversed(x.kids)]
    out.line()
    return out.lines


def _wrap(node: Node) -> Node:
    box = Node("div")
    box.kids.append(node)
    return box


def _rows(table: Node) -> Iterator[tuple[str, Node]]:
    for k in table.kids:
        if isinstance(k, Node) and not k.hidden:
            if k.tag in ("thead", "tbody", "tfoot"):
                yield from _rows(k)
            elif k.tag == "tr":
                yield "row", k
            elif k.tag not in ("colgroup", "col"):
                yield "other", k


def _table(table: Node, depth: int) -> list[str]:
    """Rows as lines, columns padded to the widest cell; a cell of several lines makes a taller row."""
    before: list[str] = []
    grid: list[list[list[str]]] = []
    for kind, row in _rows(table):
        if kind == "other":
            before += render(_wrap(row), depth)
            continue
        cells: list[list[str]] = []
        for c in row.kids:
            if isinstance(c, Node) and not c.hidden:
                cells.append(render(c, depth) if c.tag in ("td", "th") else render(_wrap(c), depth))
                cells += [[] for _ in range(c.span - 1)]
            elif isinstance(c, str) and c.strip():
                before.append(" ".join(c.split()))
        grid.append(cells)
    widths: list[int] = []
    for cells in grid:
        for i, cell in enumerate(cells):
            if i == len(widths):
                widths.append(0)
            widths[i] = max(widths[i], *map(len, cell), 0)
    lines = list(before)
    for cells in grid:
        for k in range(max(map(len, cells), default=0)):
            line = "  ".join((cell[k] if k < len(cell) else "").ljust(widths[i]) for i, cell in enumerate(cells))
            lines.append(line.rstrip())
    return lines


def extract(page: str | None) -> str:
    return "\n".join(render(parse(page))) if page else ""


def page_texts(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """One row per row of ``pages``: id, text, n_lines, n_words.

    ``text`` is all visible text of the page: no scripts, styles, comments, hidden elements. Blocks
    stand on lines of their own, paragraphs, lists and tables have a blank line around them, list
    items are marked, table cells aligned. A null or empty page has an empty text; broken markup is
    read as browsers do, as far as implied end tags go. Repeated rows and ids get repeated results;
    other columns are ignored; an empty table gives no rows.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pdf["text"] = [extract(h) for h in pdf.pop("html")]
            yield pdf
    rows = pages.select(F.col(id_col).cast("string").alias("id"), F.col(html_col).cast("string").alias("html"))
    told = rows.mapInPandas(run, "id string, text string").withColumn("id", F.col("id").cast(pages.schema[id_col].dataType))
    lines = F.when(F.col("text") == "", 0).otherwise(F.size(F.split("text", "\n"))).cast("long")
    return told.select("id", "text", lines.alias("n_lines"), F.regexp_count("text", F.lit(r"\S+")).cast("long").alias("n_words"))
