"""HTML to a tree of block elements and text leaves, as a browser would nest them.

Tags that only style text (links, bold) are no nodes: their text runs together in one leaf per block,
which remembers how many of its characters are links. Scripts, styles, titles, comments and the like
are no text. End tags that were left out are put in where the next tag implies them; end tags without
a start are ignored. A page takes time in proportion to its length, however its tags nest.
"""

from __future__ import annotations

import html as references
import re
from dataclasses import dataclass, field

# --- fixed values: tags -------------------------------------------------------------------------------
VOID = frozenset("area base br col embed frame hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea iframe noembed noframes xmp".split())
DROPPED = frozenset("svg math template datalist object canvas audio video".split())
ROOTS = frozenset(("html", "head", "body"))
BLOCKS = (
    "article main section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd blockquote pre figure figcaption "
    "table caption thead tbody tfoot tr td th nav header footer aside form fieldset legend label button "
    "select optgroup option details summary dialog menu address center noscript hgroup search").split()
BLOCK = frozenset(BLOCKS)
CLOSES_P = BLOCK - {"label", "button", "select", "optgroup", "option", "caption", "thead", "tbody",
                    "tfoot", "tr", "td", "th", "noscript"}
#: Items that a further item of the same list closes, and what a list is.
ITEMS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",),
         "optgroup": ("option", "optgroup")}
LISTS = frozenset(("ul", "ol", "menu", "dl", "select"))
CELLS = frozenset(("td", "th", "caption"))
ROW_GROUPS = ("thead", "tbody", "tfoot")
#: End tags do not reach beyond these.
SCOPES = CELLS | {"table", "button"}

TEXT = 0                                          # tag number of a leaf
TAGS = {tag: i + 1 for i, tag in enumerate([*BLOCKS, "other", "root"])}

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
    r"""|<(/?)([A-Za-z][^\s/>]*)([^>]*+)>|<[!?/][^>]*+>|([^<]++|<)""", re.DOTALL)
_HINT = re.compile(r"""\b(class|id|role|hidden|style|aria-hidden|data-main)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+))?""",
                   re.IGNORECASE)
_STARTS = re.compile(r"[!?/]?[A-Za-z]|[!?]")


@dataclass(slots=True)
class Leaf:
    """A block of text, and its characters that are links or stand in inline elements with a hint."""

    node: int
    parts: list[str] = field(default_factory=list)
    links: int = 0
    hints: dict[str, int] = field(default_factory=dict)


@dataclass(slots=True)
class Page:
    """Nodes in page order: number of their tag, their parent (-1: root) and the text of their hints
    (class, id, role); leaves by node; the value of data-main where an element has it."""

    tags: list[int]
    parents: list[int]
    hints: list[str]
    texts: dict[int, tuple[str, int, dict[str, int]]]
    labels: dict[int, str]


def _hint_of(attributes: str) -> tuple[str, str | None]:
    """Class, id and role as one text in lower case, with ``hidden`` for what is not shown; label."""
    if not attributes or "=" not in attributes and "hidden" not in attributes:
        return "", None
    found, label = [], None
    for name, value in _HINT.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name in ("class", "id", "role"):
            found.append(value)
        elif name == "data-main":
            label = value
        elif name == "hidden" or (name == "aria-hidden" and value == "true") or (
                name == "style" and "display:none" in value.replace(" ", "")):
            found.append("hidden")
    return " ".join(found), label


class _Builder:
    def __init__(self) -> None:
        self.page = Page([TAGS["root"]], [-1], [""], {}, {})
        # Open blocks: tag, node, inline elements (tag, hint) inside, how many of each are open.
        self.open = [("root", 0, [], {})]
        self.counts, self.scopes = [{}], [""]   # open blocks by tag inside each scope; its tag
        self.items, self.tables = [{}], 0       # open items by tag inside each list
        self.links = self.dropped = 0
        self.inline_hints: list[str] = []
        self.leaf: Leaf | None = None

    def end_leaf(self) -> None:
        leaf, self.leaf = self.leaf, None
        if leaf is None:
            return
        text = " ".join("".join(leaf.parts).split())
        if text:
            page = self.page
            page.texts[len(page.tags)] = (text, leaf.links, leaf.hints)
            page.tags.append(TEXT)
            page.parents.append(leaf.node)
            page.hints.append("")

    def text(self, data: str) -> None:
        if self.dropped:
            return
        if self.leaf is None:
            if data.isspace():
                return
            self.leaf = Leaf(self.open[-1][1])
        if "&" in data:
            data = references.unescape(data)
        self.leaf.parts.append(data)
        if self.links or self.inline_hints:
            n = len(data) - data.count(" ")
            if self.links:
                self.leaf.links += n
            if self.inline_hints:
                hint = self.inline_hints[-1]
                self.leaf.hints[hint] = self.leaf.hints.get(hint, 0) + n

    def start(self, tag: str, attributes: str) -> None:
        if tag in ROOTS:
            return
        hint, label = _hint_of(attributes)
        if tag not in BLOCK and "-" not in tag:
            if tag == "br":
                self.text(" ") if self.leaf else None
            elif tag == "hr":
                self.close_p()
                self.end_leaf()
            elif tag not in VOID:
                self.push_inline(tag, hint)
            return
        if tag in CLOSES_P:
            self.close_p()
        elif tag in CELLS or tag == "tr" or tag in ROW_GROUPS:
            self.close_rows(tag)
        if tag in ITEMS and any(self.items[-1].get(t) for t in ITEMS[tag]):
            while self.pop_block() not in ITEMS[tag]:
                pass
        self.end_leaf()
        page, node = self.page, len(self.page.tags)
        page.tags.append(TAGS.get(tag, TAGS["other"]))
        page.parents.append(self.open[-1][1])
        page.hints.append(hint)
        if label is not None:
            page.labels[node] = label
        self.open.append((tag, node, [], {}))
        self.counts[-1][tag] = self.counts[-1].get(tag, 0) + 1
        if tag in SCOPES:
            self.counts.append({})
            self.scopes.append(tag)
            self.tables += tag == "table"
        if tag in ITEMS:
            self.items[-1][tag] = self.items[-1].get(tag, 0) + 1
        elif tag in LISTS or tag in SCOPES:
            self.items.append({})

    def push_inline(self, tag: str, hint: str) -> None:
        _, _, inside, counts = self.open[-1]
        inside.append((tag, hint))
        counts[tag] = counts.get(tag, 0) + 1
        self.links += tag == "a"
        self.dropped += tag in DROPPED
        if hint:
            self.inline_hints.append(hint)

    def pop_inline(self) -> str:
        _, _, inside, counts = self.open[-1]
        tag, hint = inside.pop()
        counts[tag] -= 1
        self.links -= tag == "a"
        self.dropped -= tag in DROPPED
        if hint:
            self.inline_hints.pop()
        return tag

    def pop_block(self) -> str:
        self.end_leaf()
        while self.open[-1][2]:
            self.pop_inline()
        tag = self.open.pop()[0]
        if tag in SCOPES:
            self.counts.pop()
            self.scopes.pop()
            self.tables -= tag == "table"
        if tag in LISTS or tag in SCOPES:
            self.items.pop()
        elif tag in ITEMS:
            self.items[-1][tag] -= 1
        self.counts[-1][tag] -= 1
        return tag

    def close_p(self) -> None:
        if self.counts[-1].get("p"):
            while self.pop_block() != "p":
                pass

    def close_rows(self, tag: str) -> None:
        """End the cell, and the row or group of rows, that a further one of a table ends."""
        if self.scopes[-1] in CELLS:
            scope = self.scopes[-1]
            while self.pop_block() != scope:
                pass
        closes = () if tag in CELLS else ("tr",) if tag == "tr" else ROW_GROUPS
        if any(self.counts[-1].get(t) for t in closes):
            while self.pop_block() not in closes:
                pass

    def end(self, tag: str) -> None:
        if tag in ROOTS:
            return
        if tag not in BLOCK and "-" not in tag:
            if self.open[-1][3].get(tag):
                while self.pop_inline() != tag:
                    pass
            return
        scope = self.scopes[-1]
        if tag == "table":
            if not self.tables or scope == "button":
                return
        elif tag in SCOPES:
            if scope != tag:
                return
        elif not self.counts[-1].get(tag):
            # The end of a row may lie beyond a cell that was left open.
            if scope not in CELLS or tag not in ("tr", *ROW_GROUPS) or not self.counts[-2].get(tag):
                return
        while self.pop_block() != tag:
            pass


def parse(html: str) -> Page:
    """The tree of a page; an empty page has only a root."""
    builder, place, n = _Builder(), 0, len(html)
    while place < n:
        token = _TOKEN.match(html, place)
        place = token.end()
        data = token.group(7)
        if data is not None:
            if data == "<" and _STARTS.match(html, place):
                break          # a tag that never ends: the rest is no text
            builder.text(data)
            continue
        slash, tag, attributes = token.group(1, 2, 3)
        if tag is None:
            slash, tag, attributes = token.group(4, 5, 6)
        if tag is None:
            continue
        tag = tag.lower()
        if slash:
            builder.end(tag)
        elif tag in RAW:
            close = re.compile(f"</{tag}(?=[\\s/>])", re.IGNORECASE).search(html, place)
            place = close.start() if close else n
        else:
            builder.start(tag, attributes)
    while len(builder.open) > 1:
        builder.pop_block()
    builder.end_leaf()
    return builder.page
