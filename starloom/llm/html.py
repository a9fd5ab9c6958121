"""Layout-aware rendering of HTML pages to text.

A tree builder with implied end tags makes elements of the tags; visibility
rules (element, ``hidden``, inline style, ``<style>`` rules, closed details) take out what
a reader would not see. Sheet rules count by importance, specificity and order, where a
selector is one compound of tag, classes and id and the rule is for screens without further
condition; others are left out, so that no text is hidden by a rule that might not hold.
The rest is laid out: blocks on
lines of their own, blank lines around paragraphs, headings, lists and tables,
markers for list items, table cells in aligned columns. Labels of drawings
(svg) and formulas (math) are inline text. No visible text is dropped, but for
what a drawing shows by reference (``use``). Pages are rendered one by one in Arrow batches.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import python_ready

#: Elements by role in the layout (fixed values of the HTML standard).
VOID = frozenset(
    ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr")
)
RAW = frozenset(("script", "style", "xmp", "iframe", "noembed", "noframes", "textarea", "title"))
UNSEEN = frozenset(
    ("head", "title", "script", "style", "template", "noscript", "iframe", "object", "canvas", "audio",
     "video", "noembed", "noframes", "datalist", "param", "rp")
)
#: Parts of drawings and formulas that are never shown in place.
FOREIGN_UNSEEN = frozenset(
    ("title", "desc", "defs", "metadata", "style", "script", "annotation", "annotation-xml", "symbol",
     "clippath", "mask", "marker", "pattern", "filter")
)
#: Labels and cells that stand apart from their neighbours; the parts of a fraction do so too.
_APART = frozenset(("text", "mtd", "mtr", "mlabeledtr"))
#: HTML starts again inside these elements of a drawing or formula.
_HTML_INSIDE = frozenset(("foreignobject", "desc", "title", "mi", "mo", "mn", "ms", "mtext", "annotation-xml"))
#: Start tags that end an open drawing or formula (fixed values of the HTML standard).
_BREAKS_OUT = frozenset(
    ("b", "big", "blockquote", "body", "br", "center", "code", "dd", "div", "dl", "dt", "em", "embed", "h1",
     "h2", "h3", "h4", "h5", "h6", "head", "hr", "i", "img", "li", "listing", "menu", "meta", "nobr", "ol",
     "p", "pre", "ruby", "s", "small", "span", "strong", "strike", "sub", "sup", "table", "tt", "u", "ul",
     "var")
)
SPACED = frozenset(
    ("p", "h1", "h2", "h3", "h4", "h5", "h6", "ul", "ol", "dl", "table", "blockquote", "pre", "figure",
     "hr", "fieldset", "menu")
)
BLOCK = SPACED | frozenset(
    ("html", "body", "div", "article", "section", "nav", "header", "footer", "main", "aside", "address",
     "form", "li", "dt", "dd", "tr", "td", "th", "thead", "tbody", "tfoot", "caption", "figcaption",
     "details", "summary", "dialog", "option", "optgroup", "select", "legend", "hgroup", "center", "search")
)
#: Start tags that end an open paragraph.
_ENDS_P = (BLOCK - {"html", "body", "option", "optgroup", "select", "tr", "td", "th", "caption"}) | {"hr"}
#: An open element (value) ends when the tag (key) starts, up to the nearest fence.
_IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "td": ({"td", "th"}, {"table"}),
    "th": ({"td", "th"}, {"table"}),
    "tr": ({"tr", "td", "th", "caption"}, {"table"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "caption"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "caption"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "caption"}, {"table"}),
}
_HEAD_ONLY = frozenset(("meta", "link", "base", "title", "style", "script", "noscript", "template"))
_MAX_DEPTH = 200
_MAX_PAD = 40

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_TAG_REST = re.compile(r"""(?:[^>"']|"[^"]*"|'[^']*')*>""")
_BLANKS = re.compile(r"[ \t\n\r\f]+")
_COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)", re.S)
_SELECTOR = re.compile(r"(\*|[a-z][\w-]*)?((?:[.#][\w-]+)*)")
#: How far up the open elements are searched for one to end, so that any page takes linear time.
_SCAN = 500


@dataclass(slots=True)
class Element:
    tag: str
    attributes: dict[str, str] = field(default_factory=dict)
    children: list = field(default_factory=list)
    foreign: bool = False
    """Part of a drawing (svg) or formula (math)."""
    seen: bool | None = None
    """Of an element below the greatest depth: whether its own text is visible, None where it is the parent's."""


class TreeBuilder:
    """Elements and texts of a page; never fails, whatever the markup.

    Elements below a depth of ``_MAX_DEPTH`` give their texts to the element there. ``looks`` tells
    which of them are hidden; without it the tree of a page that is ``too_deep`` is no good.
    """

    def __init__(self, looks: Callable[[Element, bool], tuple[bool, bool]] | None = None) -> None:
        self.root = Element("html")
        self.open = [self.root]
        self.count: Counter[str] = Counter()
        self.styles: list[str] = []
        self.looks = looks
        self.too_deep = False

    def push(self, element: Element) -> None:
        self.open.append(element)
        self.count[element.tag] += 1

    def cut(self, at: int) -> None:
        """Ends the open elements from this place on."""
        for element in self.open[at:]:
            self.count[element.tag] -= 1
        del self.open[at:]

    def put(self, text: str) -> None:
        """Text of the innermost open element."""
        inner = self.open[-1]
        if inner.seen is None:
            inner.children.append(text)
        else:
            style = {"style": f"visibility: {'visible' if inner.seen else 'hidden'}"}
            inner.children.append(Element("span", style, [text]))

    def push_deep(self, element: Element) -> None:
        """An element below the greatest depth: hidden ones keep their content to themselves."""
        self.too_deep = True
        outer = self.open[-1]
        laid_out, seen = self.looks(element, outer.seen is not False) if self.looks else (True, True)
        if laid_out:
            if element.tag in BLOCK:
                outer.children.append(Element("div"))
            element.children = outer.children
            element.seen = seen if seen != (outer.seen is not False) else outer.seen
        self.push(element)

    def build(self, page: str) -> Element:
        at, size = 0, len(page)
        while at < size:
            tag = page.find("<", at)
            if tag < 0:
                self.text(page[at:])
                break
            if tag > at:
                self.text(page[at:tag])
            at = self.markup(page, tag)
        return self.root

    def markup(self, page: str, at: int) -> int:
        """Handle what begins at ``<``; returns where it ends."""
        if page.startswith("<!--", at):
            end = page.find("-->", at + 4)
            return len(page) if end < 0 else end + 3
        if page.startswith("<![CDATA[", at) and self.in_foreign():
            end = page.find("]]>", at + 9)
            self.put(page[at + 9 :] if end < 0 else page[at + 9 : end])
            return len(page) if end < 0 else end + 3
        closing = page.startswith("</", at)
        name = _NAME.match(page, at + 1 + closing)
        if name is None:
            if page.startswith(("<!", "<?", "</"), at):
                end = page.find(">", at)
                return len(page) if end < 0 else end + 1
            self.text("<")
            return at + 1
        rest = _TAG_REST.match(page, name.end())
        if rest is None:  # a quote that never ends: up to the next ">"
            end = page.find(">", name.end())
            end = len(page) if end < 0 else end + 1
        else:
            end = rest.end()
        tag = name.group().lower()
        if closing:
            self.end(tag)
            return end
        inside = page[name.end() : end]
        attributes = {}
        if len(inside) > 1:
            for key, a, b, c in _ATTRIBUTE.findall(inside[:-1]):
                attributes.setdefault(key.lower(), unescape(a or b or c))
        closed = inside.endswith("/>")
        self.start(tag, attributes, closed)
        if tag in RAW and not (closed and self.in_foreign()):
            return self.raw(page, end, tag)
        return end

    def in_foreign(self) -> bool:
        """Whether a tag here belongs to a drawing or formula."""
        return self.open[-1].foreign and self.open[-1].tag not in _HTML_INSIDE

    def raw(self, page: str, at: int, tag: str) -> int:
        close = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(page, at)
        body = page[at : close.start()] if close else page[at:]
        if tag == "style":
            self.styles.append(body)
        elif body:
            self.put(unescape(body) if tag in ("textarea", "title") else body)
        self.end(tag)
        return close.end() if close else len(page)

    def text(self, text: str) -> None:
        if len(self.open) > 1 and self.open[-1].tag == "head" and text.strip():
            self.end("head")
        self.put(unescape(text) if "&" in text else text)

    def _inner(self) -> range:
        """Places of the open elements, the innermost first."""
        return range(len(self.open) - 1, max(0, len(self.open) - 1 - _SCAN), -1)

    def close_up_to(self, ends: set[str], fences: set[str]) -> None:
        if not any(self.count[tag] for tag in ends):
            return
        for k in self._inner():
            tag = self.open[k].tag
            if tag in fences or (self.open[k].foreign and tag in _HTML_INSIDE):
                return
            if tag in ends:
                self.cut(k)
                # the outer ones of the same kind, such as a row around a cell
                self.close_up_to(ends, fences)
                return

    def start(self, tag: str, attributes: dict[str, str], closed: bool = False) -> None:
        while tag in _BREAKS_OUT and self.in_foreign():
            self.cut(len(self.open) - 1)
        if tag == "html" or (tag == "body" and self.count["body"]):
            return
        if tag not in _HEAD_ONLY and self.open[-1].tag == "head":
            self.end("head")
        if tag in _ENDS_P:
            self.close_up_to({"p"}, {"table", "td", "th", "button", "object", "caption"})
        if tag in _IMPLIED:
            self.close_up_to(*_IMPLIED[tag])
        foreign = tag in ("svg", "math") or self.in_foreign()
        element = Element(tag, attributes, foreign=foreign)
        holds = tag not in VOID if not foreign else not closed
        if holds and len(self.open) >= _MAX_DEPTH:
            self.push_deep(element)
            return
        self.open[-1].children.append(element)
        if holds:
            self.push(element)

    def end(self, tag: str) -> None:
        if tag == "p" and not self.count["p"]:
            self.open[-1].children.append(Element("p"))
            return
        if tag == "br":
            self.open[-1].children.append(Element("br"))
            return
        if not self.count[tag]:
            return
        for k in self._inner():
            if self.open[k].tag == tag:
                self.cut(k)
                return
            if self.open[k].tag in ("td", "th", "table") and tag not in ("tr", "table", "tbody", "thead", "tfoot", "body", "html", "td", "th"):
                return


def _declared(style: str) -> dict[str, tuple[bool, str]]:
    """Property → (important, value); of equal ones the later counts, unless the earlier is important."""
    found: dict[str, tuple[bool, str]] = {}
    for part in _COMMENT.sub("", style).lower().split(";"):
        name, colon, value = part.partition(":")
        if colon:
            value, bang, mark = value.partition("!")
            said = (bool(bang) and mark.strip() == "important", value.strip())
            name = name.strip()
            if name not in found or said[0] or not found[name][0]:
                found[name] = said
    return found


def _sheet_rules(sheet: str) -> Iterator[tuple[str, str]]:
    """(selectors, declarations) of a style sheet that hold on any screen."""
    at, size = 0, len(sheet)
    while at < size:
        stop = re.compile(r"[{};]").search(sheet, at)
        if stop is None:
            return
        prelude, at = sheet[at : stop.start()].strip().lower(), stop.end()
        if stop.group() != "{":
            continue  # an at-rule without a block, or a stray mark
        if prelude.startswith("@media") and any(
            re.fullmatch(r"(?:only\s+)?(?:all|screen)|", q.strip()) for q in prelude[6:].split(",")
        ):
            continue  # what follows are its rules; its last brace is a stray mark
        depth, begin = 1, at
        for brace in re.compile(r"[{}]").finditer(sheet, at):
            depth += 1 if brace.group() == "{" else -1
            at = brace.end()
            if not depth:
                break
        else:
            at = size
        if not prelude.startswith("@"):
            yield prelude, sheet[begin : at - 1 if not depth else at]


@dataclass(frozen=True)
class HidingRule:
    tag: str
    classes: frozenset[str]
    names: frozenset[str]
    """Ids that the selector asks for."""
    order: tuple[int, int, int, int]
    """Specificity (ids, classes, tag), then the place in the sheets."""
    declared: tuple[tuple[str, bool, str], ...]


class HidingRules:
    """display and visibility by compound selector (``tag``, ``.class``, ``#id`` and joins of them)."""

    def __init__(self, styles: list[str]) -> None:
        self.by_key: dict[str, list[HidingRule]] = {}
        self.found: dict[tuple[str, str, str], dict[str, tuple[bool, str]]] = {}
        place = 0
        for style in styles:
            for selectors, body in _sheet_rules(_COMMENT.sub("", style)):
                wanted = tuple((k, *v) for k, v in _declared(body).items() if k in ("display", "visibility"))
                for selector in selectors.split(",") if wanted else ():
                    match = _SELECTOR.fullmatch(selector.strip())
                    if not match or not selector.strip():
                        continue
                    tag = (match[1] or "*").lower()
                    marks = re.findall(r"[.#][\w-]+", match[2].lower())
                    classes = frozenset(m[1:] for m in marks if m[0] == ".")
                    names = frozenset(m[1:] for m in marks if m[0] == "#")
                    place += 1
                    order = (sum(m[0] == "#" for m in marks), sum(m[0] == "." for m in marks), int(tag != "*"), place)
                    key = next((f"#{n}" for n in sorted(names)), None) or next((f".{c}" for c in sorted(classes)), tag)
                    self.by_key.setdefault(key, []).append(HidingRule(tag, classes, names, order, wanted))

    def __bool__(self) -> bool:
        return bool(self.by_key)

    def style(self, tag: str, classes: str, name: str) -> dict[str, tuple[bool, str]]:
        """What the sheets say of an element: property → (important, value)."""
        key = (tag, classes, name)
        if key not in self.found:
            own = frozenset(classes.split())
            fitting = [
                r
                for k in (tag, "*", f"#{name}", *(f".{c}" for c in own))
                for r in self.by_key.get(k, ())
                if r.tag in ("*", tag) and r.classes <= own and r.names <= {name}
            ]
            said: dict[str, tuple[bool, str]] = {}
            for rule in sorted(fitting, key=lambda r: r.order):
                for prop, important, value in rule.declared:
                    if important or prop not in said or not said[prop][0]:
                        said[prop] = (important, value)
            self.found[key] = said
        return self.found[key]


class Lines:
    """Text laid out so far: finished lines, the open one, and the blank lines owed."""

    def __init__(self) -> None:
        self.done: list[str] = []
        self.parts: list[str] = []
        self.gap = 0
        self.space = False

    def word(self, text: str) -> None:
        """Inline text; runs of blanks become one, at line ends none."""
        if not text:
            return
        flat = _BLANKS.sub(" ", text)
        if flat == " ":
            self.space = bool(self.parts)
            return
        if (self.space or flat[0] == " ") and self.parts:
            self.parts.append(" ")
        self.parts.append(flat.strip(" "))
        self.space = flat[-1] == " "

    def end_line(self, always: bool = False) -> None:
        if self.parts or always:
            if self.gap and self.done:
                self.done.append("")
            self.done.append("".join(self.parts))
            self.gap, self.parts = 0, []
        self.space = False

    def block(self, spaced: bool) -> None:
        self.end_line()
        self.gap = max(self.gap, int(spaced))

    def put(self, lines: list[str]) -> None:
        """Finished lines, as they are."""
        self.end_line()
        if lines:
            if self.gap and self.done:
                self.done.append("")
            self.gap = 0
            self.done += lines

    def finish(self) -> list[str]:
        self.end_line()
        return self.done


class Renderer:
    def __init__(self, rules: HidingRules) -> None:
        self.rules = rules

    def looks(self, element: Element, shown: bool) -> tuple[bool, bool]:
        """(in the layout, its own text visible); shown: inherited visibility."""
        a = element.attributes
        if element.tag in UNSEEN or (element.foreign and element.tag in FOREIGN_UNSEEN):
            return False, False
        closed = "hidden" in a or (element.tag == "dialog" and "open" not in a)
        if not a and not self.rules:
            return not closed, shown
        style: dict[str, tuple[bool, str]] = {}
        if element.foreign:  # these may stand as attributes there, below any rule
            style = {k: (False, a[k].strip().lower()) for k in ("display", "visibility") if k in a}
        if self.rules:
            style |= self.rules.style(element.tag, a.get("class", "").lower(), a.get("id", "").lower())
        if "style" in a:
            for name, said in _declared(a["style"]).items():
                if said[0] or not style.get(name, (False,))[0]:
                    style[name] = said
        # an author's display stands above what hides the element by itself
        if style.get("display", (False, "none" if closed else ""))[1] == "none":
            return False, False
        sight = style.get("visibility", (False, ""))[1]
        if sight in ("hidden", "collapse"):
            shown = False
        elif sight == "visible":
            shown = True
        return True, shown

    def children(self, element: Element, out: Lines, shown: bool, depth: int = 0) -> None:
        for child in element.children:
            if isinstance(child, str):
                if shown:
                    out.word(child)
            else:
                self.element(child, out, shown, depth)

    def inside(self, element: Element, shown: bool) -> list[str]:
        out = Lines()
        self.children(element, out, shown)
        return out.finish()

    def element(self, e: Element, out: Lines, shown: bool, depth: int = 0) -> None:
        laid_out, shown = self.looks(e, shown)
        if not laid_out:
            return
        tag = e.tag
        if e.foreign:
            self.drawing(e, out, shown)
        elif tag == "br":
            out.end_line(always=True)
        elif tag == "pre" or tag == "textarea" or tag == "xmp":
            out.block(True)
            if shown:
                out.put("".join(_texts(e, self, shown)).strip("\n").split("\n"))
            out.block(True)
        elif tag == "table":
            out.block(True)
            self.table(e, out, shown)
            out.block(True)
        elif tag in ("ul", "ol", "menu"):
            out.block(True)
            self.items(e, out, shown)
            out.block(True)
        elif tag == "blockquote" or tag == "dd":
            out.block(tag == "blockquote")
            out.put([("  " + x).rstrip() for x in self.inside(e, shown)])
            out.block(tag == "blockquote")
        elif tag == "details" and "open" not in e.attributes:
            out.block(False)
            for child in e.children:
                if isinstance(child, Element) and child.tag == "summary":
                    self.element(child, out, shown)
            out.block(False)
        elif tag == "input":
            if shown and e.attributes.get("type", "text").lower() in ("text", "submit", "button", "search", "email"):
                out.word(" " + e.attributes.get("value", "") + " ")
        elif tag in BLOCK:
            out.block(tag in SPACED)
            self.children(e, out, shown)
            out.block(tag in SPACED)
        else:
            self.children(e, out, shown)

    def drawing(self, e: Element, out: Lines, shown: bool) -> None:
        """Text of a drawing or formula, inline."""
        if e.tag in _APART:
            out.word(" ")
        for child in e.children:
            if isinstance(child, str):
                if shown:
                    out.word(child)
                continue
            self.element(child, out, shown)
            if e.tag == "mfrac":
                out.word(" ")
        if e.tag in _APART:
            out.word(" ")

    def items(self, e: Element, out: Lines, shown: bool) -> None:
        """A list: markers before the items, their further lines indented under the text."""
        number = _whole(e.attributes.get("start"), 1)
        loose = Lines()
        for child in e.children:
            if isinstance(child, str):
                if shown:
                    loose.word(child)
                continue
            if child.tag != "li":
                self.element(child, loose, shown)
                continue
            out.put(loose.finish())
            loose = Lines()
            laid_out, seen = self.looks(child, shown)
            if not laid_out:
                continue
            mark = "- "
            if e.tag == "ol":
                number = _whole(child.attributes.get("value"), number)
                mark = f"{number}. "
                number += 1
            lines = self.inside(child, seen)
            if lines:
                rest = [(" " * len(mark) + x).rstrip() for x in lines[1:]]
                out.put([mark + lines[0], *rest])
        out.put(loose.finish())

    def table(self, e: Element, out: Lines, shown: bool) -> None:
        """Rows of cells; columns as wide as their widest line, up to a bound that long lines pass."""
        rows: list[list[tuple[int, int, list[str]]]] = []
        queue = [(child, shown) for child in reversed(e.children)]
        loose = Lines()
        tail: list[str] = []
        while queue:
            child, seen = queue.pop()
            if isinstance(child, str):
                if seen:
                    loose.word(child)
                continue
            laid_out, seen = self.looks(child, seen)
            if not laid_out:
                continue
            if child.tag in ("thead", "tbody", "tfoot"):
                queue += [(c, seen) for c in reversed(child.children)]
            elif child.tag == "tr":
                rows.append(self.cells(child, seen, loose))
            elif child.tag in ("td", "th"):
                rows.append([(_whole(child.attributes.get("colspan"), 1), 1, self.inside(child, seen))])
            elif child.tag == "caption":
                tail += self.inside(child, seen)
            elif child.tag not in ("col", "colgroup"):
                self.element(child, loose, seen)
        out.put(tail)
        out.put(loose.finish())
        grid: list[list[list[str]]] = []
        held: dict[int, int] = {}  # column -> rows for which a cell above still holds it
        for row in rows:
            line: list[list[str]] = []
            for span, down, lines in row:
                while held.get(len(line), 0) > 0:
                    held[len(line)] -= 1
                    line.append([])
                for k in range(min(max(span, 1), 100)):
                    if down > 1:
                        held[len(line)] = min(down, 1000) - 1
                    line.append(lines if k == 0 else [])
            grid.append(line)
        widths: dict[int, int] = {}
        for line in grid:
            for k, cell in enumerate(line):
                widths[k] = max(widths.get(k, 0), min(_MAX_PAD, max(map(len, cell), default=0)))
        for line in grid:
            for k in range(max(map(len, line), default=0)):
                cells = [(c[k] if k < len(c) else "").ljust(widths[i]) for i, c in enumerate(line)]
                text = "  ".join(cells).rstrip()
                if text:
                    out.put([text])

    def cells(self, row: Element, shown: bool, loose: Lines) -> list[tuple[int, int, list[str]]]:
        found = []
        for child in row.children:
            if isinstance(child, str):
                if shown:
                    loose.word(child)
                continue
            laid_out, seen = self.looks(child, shown)
            if not laid_out:
                continue
            if child.tag in ("td", "th"):
                a = child.attributes
                found.append((_whole(a.get("colspan"), 1), _whole(a.get("rowspan"), 1), self.inside(child, seen)))
            else:
                self.element(child, loose, seen)
        return found


def _texts(e: Element, renderer: Renderer, shown: bool) -> Iterator[str]:
    queue = [(child, shown) for child in reversed(e.children)]
    while queue:
        child, seen = queue.pop()
        if isinstance(child, str):
            if seen:
                yield child
            continue
        laid_out, seen = renderer.looks(child, seen)
        if child.tag == "br" and laid_out:
            yield "\n"
        elif laid_out:
            queue += [(c, seen) for c in reversed(child.children)]


def _whole(text: str | None, otherwise: int) -> int:
    return int(text) if text and re.fullmatch(r"-?[0-9]{1,6}", text.strip()) else otherwise


def render(page: str) -> str:
    """Visible text of one page. Empty for an empty page."""
    builder = TreeBuilder()
    root = builder.build(page)
    renderer = Renderer(HidingRules(builder.styles))
    if builder.too_deep:  # once more, knowing what is hidden below the greatest depth
        root = TreeBuilder(renderer.looks).build(page)
    return "\n".join(renderer.inside(root, True)).strip("\n")


def extract_text(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """page_id and text of every row. A null page has an empty text.

    Broken markup is read as a browser would; texts of elements below a depth of 200
    lie flat at it, hidden ones stay hidden. Repeated rows are rendered row by row; an empty table gives an
    empty result; other columns are not read.
    """

    @F.pandas_udf("string")
    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for html in batches:
            yield pd.Series([render(h) for h in html], index=html.index, dtype=object)

    python_ready(pages.sparkSession)
    page = F.coalesce(F.col(f"`{html_col}`").cast("string"), F.lit(""))
    return pages.select(F.col(f"`{id_col}`").alias(id_col), text(page).alias("text"))
