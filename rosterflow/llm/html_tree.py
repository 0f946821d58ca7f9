"""Pages as trees of block elements whose leaves are runs of text."""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from collections import Counter, defaultdict
from dataclasses import dataclass, field

# An attribute: a value in quotes starts right after the equals sign; any other runs to white space or the end of the tag,
# whatever quotes it holds.
_NAME = r"[^\s>/=][^\s>/=]*+"
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)"
    rf"""((?:[\s/]++|{_NAME}(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>]*+))?|=)*+)>?""",
    re.S,
)
ATTRIBUTE = re.compile(rf"""({_NAME})(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>]*+)))?""")

# Fixed values of the markup language: elements by how they shape text.
BLOCKS = set(
    "html body main article section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd blockquote pre table caption thead tbody tfoot tr td th "
    "nav header footer aside form fieldset legend figure figcaption address details summary hgroup dialog menu search center".split()
)
ENDS_PARAGRAPH = BLOCKS - {"html", "body", "caption", "thead", "tbody", "tfoot", "tr", "td", "th", "dt", "dd", "li", "legend"} | {"hr"}
RAW = ("script", "style", "title", "textarea", "iframe", "noembed", "noframes", "xmp")
SKIPPED = set("noscript template svg select button object canvas audio video datalist map".split())
# Tags that may stand in a head; others end one whose own end is left out.
IN_HEAD = set("html head base basefont bgsound link meta title style script noscript template noframes".split())
BREAKS = {"br", "hr"}
# An element that ends open ones of these kinds, up to one of those.
CLOSES = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "tbody": (("thead", "tbody", "tfoot", "tr", "td", "th"), ("table",)),
    "tfoot": (("thead", "tbody", "tfoot", "tr", "td", "th"), ("table",)),
}
RAW_END = {tag: re.compile(f"</{tag}\\b[^>]*>?", re.I) for tag in RAW}


@dataclass
class Tree:
    """Nodes in page order, a parent before its children. A leaf has tag ``#text``; its text has references
    resolved and white space as single spaces, and ``linked`` counts the characters of it that stand in links."""

    parent: list[int] = field(default_factory=list)
    tag: list[str] = field(default_factory=list)
    attributes: list[dict[str, str]] = field(default_factory=list)
    text: list[str] = field(default_factory=list)
    linked: list[int] = field(default_factory=list)

    def add(self, parent: int, tag: str, attributes: dict[str, str], text: str = "", linked: int = 0) -> int:
        for column, value in zip((self.parent, self.tag, self.attributes, self.text, self.linked), (parent, tag, attributes, text, linked)):
            column.append(value)
        return len(self.tag) - 1


def attributes_of(source: str) -> dict[str, str]:
    if not source or source.isspace():
        return {}
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(source)}


def skipped_ends(page: str) -> dict[int, int]:
    """Where each closed element of ``SKIPPED`` ends, by the end of its start tag. One that is still open when a block around it closes is not closed."""
    ends: dict[int, int] = {}
    stack: list[tuple[str, int]] = []
    held: Counter[str] = Counter()
    at = 0
    while match := TOKEN.search(page, at):
        at = match.end()
        if not match[2]:
            continue
        ending, tag = match[1] == "/", match[2].lower()
        if not ending and tag in RAW:
            end = RAW_END[tag].search(page, at)
            at = end.end() if end else len(page)
        elif not ending and tag == "body":
            stack, held = [(tag, at)], Counter((tag,))
        elif not (tag in SKIPPED or tag in BLOCKS or tag == "head"):
            continue
        elif not ending:
            if tag not in SKIPPED or not match[3].endswith("/"):
                stack.append((tag, at))
                held[tag] += 1
        elif held[tag]:
            while True:
                name, start = stack.pop()
                held[name] -= 1
                if name == tag:
                    break
            if tag in SKIPPED:
                ends[start] = at
    return ends


def parse_page(page: str) -> Tree:
    """The tree of a page; any text is a page, however its tags are broken.

    A head ends at its end tag or at the first tag or text that cannot stand in it. An element of ``SKIPPED`` without an end
    tag before its enclosing block closes is left out up to the next tag of a block.
    """
    tree = Tree()
    open_nodes = [tree.add(-1, "#page", {})]
    # Depths of the open elements of each tag, growing.
    depths: defaultdict[str, list[int]] = defaultdict(list)
    run: list[tuple[str, bool]] = []
    links = 0
    in_head = unclosed = False
    ends: dict[int, int] | None = None

    def flush() -> None:
        if run:
            text = " ".join(html.unescape("".join(t for t, _ in run)).split())
            if text:
                linked = sum(len(" ".join(html.unescape(t).split())) for t, in_link in run if in_link)
                tree.add(open_nodes[-1], "#text", {}, text, linked)
            run.clear()

    def close_to(depth: int) -> None:
        flush()
        for node in open_nodes[depth:]:
            depths[tree.tag[node]].pop()
        del open_nodes[depth:]

    def depth_of(tags, stop=()) -> int:
        """Depth of the outermost open element of ``tags`` above the innermost of ``stop``; 0 if there is none."""
        floor = max((depths[t][-1] for t in stop if depths[t]), default=0)
        above = [depths[t][bisect_right(depths[t], floor)] for t in tags if depths[t] and depths[t][-1] > floor]
        return min(above, default=0)

    at, size = 0, len(page)
    while at < size:
        match = TOKEN.search(page, at)
        start = match.start() if match else size
        if start > at and not unclosed:
            in_head = in_head and page[at:start].isspace()
            if not in_head:
                run.append((page[at:start], links > 0))
        if not match:
            break
        at = match.end()
        if not match[2]:
            continue
        ending, tag = match[1] == "/", match[2].lower()
        if in_head and (tag in ("head", "body", "html", "br") if ending else tag not in IN_HEAD):
            in_head = False
        if unclosed and (tag in BLOCKS or tag == "head"):
            unclosed = False
        if tag == "head":
            in_head = not ending
        elif not ending and tag in RAW:
            end = RAW_END[tag].search(page, at)
            at = end.end() if end else size
        elif not ending and tag in SKIPPED:
            if not match[3].endswith("/"):
                if ends is None:
                    ends = skipped_ends(page)
                if at in ends:
                    at = ends[at]
                else:
                    unclosed = True
        elif tag == "a":
            links = 0 if ending else 1
        elif tag in BREAKS:
            if tag == "hr" and (depth := depth_of(("p",))):
                close_to(depth)
            run.append((" ", False))
        elif tag in BLOCKS:
            if ending:
                flush()
                if depths[tag]:
                    close_to(depths[tag][-1])
                    links = 0
                continue
            if tag in ENDS_PARAGRAPH and (depth := depth_of(("p",), ("td", "th"))):
                close_to(depth)
            if tag in CLOSES and (depth := depth_of(*CLOSES[tag])):
                close_to(depth)
            flush()
            if tag in ("html", "body") and depths[tag]:
                continue
            depths[tag].append(len(open_nodes))
            open_nodes.append(tree.add(open_nodes[-1], tag, attributes_of(match[3])))
    flush()
    return tree
