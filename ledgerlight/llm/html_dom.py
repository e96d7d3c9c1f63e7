"""Pages as arrays of nodes: a forgiving parser, the features of nodes, and text put together again from kept nodes.

Nodes are block elements, other elements with attributes of their own, and runs of text beside block elements (``#text``). Other inline
elements belong to the node around them. End tags that HTML lets authors leave out are supplied; nothing here recurses.
"""

from __future__ import annotations

import html as entities
import re
from dataclasses import dataclass, field

import numpy as np

#: Fixed values of HTML: elements without content, with raw text, never shown, block elements, and what ends what.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("iframe noembed noframes script style textarea title xmp".split())
HIDDEN = set("audio button canvas datalist dialog head iframe math noembed noframes noscript object script select style svg template textarea title video xmp".split())
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav noscript ol option p pre section summary table tbody td template tfoot th thead tr ul".split()
)
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
IN_HEAD = set("base basefont bgsound head html link meta noframes noscript script style template title".split())
#: Elements that a start tag ends if they are open, up to the nearest of the elements behind.
CELLS = {"table", "td", "th", "caption", "body", "html"}
ENDS = {
    "li": ({"li"}, CELLS | {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, CELLS | {"dl"}), "dd": ({"dt", "dd"}, CELLS | {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}),
    "thead": ({"thead", "tbody", "tfoot", "caption"}, {"table"}), "tbody": ({"thead", "tbody", "tfoot", "caption"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "caption"}, {"table"}), "option": ({"option"}, {"select"}), "body": ({"head"}, {"html"}),
}
KEEPS_PARAGRAPH = {"html", "head", "body", "option", "tr", "td", "th", "thead", "tbody", "tfoot", "caption", "noscript", "template"}

_TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]*)))?")
_NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

#: Words in class, id, role and label of an element, by what they tell; fixed values, each stands for its plural too.
FAMILIES = {
    "content": "article articlebody content entry main post story text body page read prose",
    "menu": "nav navbar navigation menu menubar breadcrumb crumb tab toc pager pagination skip sitemap topbar toolbar",
    "header": "header masthead banner top logo brand head",
    "footer": "footer foot copyright legal bottom colophon imprint contentinfo",
    "side": "sidebar side aside widget related recommend recommended recommendation more popular trending rail complementary tag",
    "comment": "comment reply discussion discus disqus respond feedback review reader commentlist guestbook",
    "advert": "ad advert advertisement advertising sponsor sponsored promo promotion adsense banner outbrain taboola commercial",
    "notice": "cookie notice alert consent gdpr modal popup overlay warning message toast announcement paywall disclaimer privacy notification",
    "share": "share social sharing follow facebook twitter like bookmark print",
    "form": "form search login signin signup register subscribe subscription newsletter input field",
    "hidden": "hidden sr invisible screenreader hide",
}
_FAMILY = {word + end: i for i, words in enumerate(FAMILIES.values()) for word in words.split() for end in ("", "s")}

TAG_GROUPS = [
    {"p"}, {"h1"}, {"h2", "h3", "h4", "h5", "h6"}, {"li"}, {"ul", "ol", "menu", "dir"}, {"div", "center"}, {"section"}, {"article"}, {"main"}, {"nav"}, {"aside"}, {"footer"},
    {"header", "hgroup"}, {"form", "fieldset", "legend"}, {"table", "tbody", "thead", "tfoot", "tr", "caption"}, {"td", "th"}, {"blockquote", "pre"}, {"figure", "figcaption"},
    {"dl", "dt", "dd"}, {"address"}, {"body", "html"}, {"details", "summary"}, {"#text"},
]
_GROUP = {tag: i for i, group in enumerate(TAG_GROUPS) for tag in group}
OTHER = len(TAG_GROUPS)
#: Groups whose elements are told to everything below them.
SHOWN_BELOW = [i for i, group in enumerate(TAG_GROUPS) if group & {"article", "main", "nav", "aside", "footer", "header", "form", "ul", "table"}]
#: Place of the number of characters among the features.
CHARS = OTHER + 1 + len(SHOWN_BELOW) + 2 * len(FAMILIES) + 1
_SENTENCE = re.compile(r"[.,;:!?…。，]")


@dataclass
class Page:
    """Nodes in page order (parents first) and the pieces of text: (node, number of its block, text)."""

    parents: list[int] = field(default_factory=list)
    tags: list[str] = field(default_factory=list)
    families: list[int] = field(default_factory=list)
    marks: list[str | None] = field(default_factory=list)
    pieces: list[tuple[int, int, str]] = field(default_factory=list)
    chars: list[int] = field(default_factory=list)
    linked: list[int] = field(default_factory=list)
    words: list[int] = field(default_factory=list)
    stops: list[int] = field(default_factory=list)
    signs: list[int] = field(default_factory=list)

    def add(self, tag: str, parent: int, families: int = 0, mark: str | None = None) -> int:
        self.parents.append(parent)
        self.tags.append(tag)
        self.families.append(families)
        self.marks.append(mark)
        for counts in (self.chars, self.linked, self.words, self.stops, self.signs):
            counts.append(0)
        return len(self.parents) - 1


def attributes(text: str, mark: str | None) -> tuple[int, str | None]:
    """The families of an element's words as bits, and the value of the attribute ``mark``."""
    bits, marked = 0, None
    for name, *values in _ATTRIBUTE.findall(text):
        name, value = name.lower(), next((v for v in values if v), "")
        if name in ("class", "id", "role", "aria-label", "itemprop"):
            for part in _NAME_PART.findall(value):
                family = _FAMILY.get(part.lower())
                bits |= 0 if family is None else 1 << family
        elif name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "style" and "display:none" in value.replace(" ", "").lower():
            bits |= 1 << len(FAMILIES) - 1
        elif name == mark:
            marked = value
    return bits, marked


def parse(markup: str, mark: str | None = None) -> Page:
    """The nodes of a page. ``mark`` names an attribute whose value is kept, for pages with labels."""
    page = Page()
    root = page.add("html", -1)
    # open elements: tag, node, whether within a link, whether hidden
    stack: list[tuple[str, int, bool, bool]] = [("html", root, False, False)]
    runs: list[tuple[int, int, int]] = []  # (node, first piece, piece after the last) of text between block borders
    block, first, mixed = 0, 0, set()

    def border() -> None:
        nonlocal block, first
        if len(page.pieces) > first:
            begin = first
            for i in range(first + 1, len(page.pieces) + 1):
                if i == len(page.pieces) or page.pieces[i][0] != page.pieces[begin][0]:
                    runs.append((page.pieces[begin][0], begin, i))
                    begin = i
            first = len(page.pieces)
        block += 1

    def close(down_to: int) -> None:
        if any(tag in BLOCKS for tag, *_ in stack[down_to:]):
            border()
        del stack[down_to:]

    def close_open(names: set[str], until: set[str]) -> None:
        """End the outermost open element of ``names`` that is not behind one of ``until``."""
        found = None
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][0] in until:
                break
            if stack[i][0] in names:
                found = i
        if found is not None:
            close(found)

    def text(content: str) -> None:
        tag, node, link, hidden = stack[-1]
        if tag == "head" and content.strip():
            close(len(stack) - 1)
            tag, node, link, hidden = stack[-1]
        if hidden or not content:
            return
        content = entities.unescape(content)
        page.pieces.append((node, block, content))
        words = content.split()
        size = sum(map(len, words))
        if size:
            page.chars[node] += size
            page.words[node] += len(words)
            page.stops[node] += len(_SENTENCE.findall(content))
            page.signs[node] += "©" in content or "|" in content
            if link:
                page.linked[node] += size

    at, end, ends = 0, len(markup), {}
    while at < end:
        found = _TOKEN.search(markup, at)
        if not found:
            text(markup[at:])
            break
        text(markup[at:found.start()])
        at = found.end()
        closing, name, rest = found.group(1, 2, 3) if found.group(2) else found.group(4, 5, 6)
        if not name:
            continue
        name = name.lower()
        if closing:
            if name == "br":
                text(" ")
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == name or name in HEADINGS and stack[i][0] in HEADINGS:
                    close(i)
                    break
                if name not in BLOCKS | HIDDEN and stack[i][0] in BLOCKS or name != "table" and stack[i][0] == "table" and name in BLOCKS - {"body", "html", "article", "main", "section", "div"}:
                    break
            continue
        if stack[-1][0] == "head" and name not in IN_HEAD:
            close(len(stack) - 1)
        if name in ENDS:
            close_open(*ENDS[name])
        if name in BLOCKS and name not in KEEPS_PARAGRAPH:
            close_open({"p"}, CELLS)
        if name in HEADINGS and stack[-1][0] in HEADINGS:
            close(len(stack) - 1)
        if name in VOID:
            if name == "br":
                text(" ")
            elif name == "hr":
                border()
            continue
        if name == "html" or name == "body" and any(tag == "body" for tag, *_ in stack):
            continue
        _, node, link, hidden = stack[-1]
        if name in BLOCKS:
            border()
            mixed.add(node)
        families, marked = attributes(rest, mark) if rest.strip("/ \t\r\n") else (0, None)
        if name in RAW:
            if name not in ends or ends[name] < at and ends[name] >= 0:
                ends[name] = next((m.start() for m in re.compile(rf"</{name}(?=[\s/>])", re.I).finditer(markup, at)), -1)
            if ends[name] >= 0:
                at = ends[name]
                stop = markup.find(">", at)
                at = end if stop < 0 else stop + 1
            elif name in ("script", "style"):
                at = end
            continue
        hidden = hidden or name in HIDDEN
        if not hidden and name != "a" and (name in BLOCKS or families or marked is not None):
            node = page.add(name, node, families, marked)
        if not (hidden and rest.endswith("/")):  # only drawings have elements that end themselves
            stack.append((name, node, link or name == "a", hidden))
    border()
    return _with_runs(page, runs, mixed)


def _with_runs(page: Page, runs: list[tuple[int, int, int]], mixed: set[int]) -> Page:
    """Text beside block elements gets a node of its own, placed after its parent."""
    for node, first, last in runs:
        if node in mixed and any(page.pieces[i][2].strip() for i in range(first, last)):
            own = page.add("#text", node, 0, page.marks[node])
            for i in range(first, last):
                _, block, content = page.pieces[i]
                words = content.split()
                size = sum(map(len, words))
                page.pieces[i] = (own, block, content)
                stops, signs = len(_SENTENCE.findall(content)) if size else 0, int(size > 0 and ("©" in content or "|" in content))
                for counts, value in ((page.chars, size), (page.words, len(words)), (page.stops, stops), (page.signs, signs)):
                    counts[own] += value
                    counts[node] -= value
    for node in mixed:  # links of text that moved are counted where they stood; they can't exceed the text that is left
        page.linked[node] = min(page.linked[node], page.chars[node])
    return page


def features(page: Page) -> np.ndarray:
    """One row of numbers for each node: its tag, words of its attributes and of those above, its subtree, its siblings, its place."""
    n = len(page.parents)
    parent = np.array(page.parents)
    up = np.maximum(parent, 0)
    group = np.array([_GROUP.get(tag, OTHER) for tag in page.tags])
    own = np.array([page.chars, page.linked, page.words, page.stops, page.signs, [1] * n, [tag == "p" for tag in page.tags], [tag == "li" for tag in page.tags]], np.float64)
    tree = own.copy()
    depth, above = np.zeros(n), np.zeros(n, np.int64)
    families, shown = np.array(page.families, np.int64), np.zeros(n, np.int64)
    for i, below in enumerate(SHOWN_BELOW):
        shown |= (group == below).astype(np.int64) << i
    lineage = shown.copy()
    for node in range(1, n):
        depth[node] = depth[parent[node]] + 1
        above[node] = above[parent[node]] | families[parent[node]]
        lineage[node] |= lineage[parent[node]]
    for node in range(n - 1, 0, -1):
        tree[:, parent[node]] += tree[:, node]
    chars, linked, words, stops, signs, tags, paragraphs, items = tree
    share = linked / np.maximum(chars, 1)
    # nodes with the same parent, in page order: numbers, text and links of the siblings
    order = np.argsort(up[1:], kind="stable") + 1
    siblings = np.bincount(up[1:], minlength=n)
    sums = np.bincount(up[1:], chars[1:], minlength=n)
    nth = np.zeros(n)
    starts = np.concatenate([[0], np.cumsum(siblings)])
    nth[order] = np.arange(n - 1) - starts[up[order]]
    same = np.zeros(n)
    pair = up * (OTHER + 1) + group
    _, inverse, counts = np.unique(pair[1:], return_inverse=True, return_counts=True)
    same[1:] = counts[inverse]
    before, after = np.zeros((2, n)), np.zeros((2, n))
    if n > 2:
        together = up[order[1:]] == up[order[:-1]]
        for row, values in enumerate((np.log1p(chars), share)):
            before[row, order[1:]] = np.where(together, values[order[:-1]], -1)
            after[row, order[:-1]] = np.where(together, values[order[1:]], -1)
    others = np.maximum(siblings[up] - 1, 1)
    log = np.log1p
    bits = np.arange(len(FAMILIES))
    columns = [
        *(group[:, None] == np.arange(OTHER + 1)).T, *((lineage[:, None] >> np.arange(len(SHOWN_BELOW))) & 1).T,
        *((families[:, None] >> bits) & 1).T, *((above[:, None] >> bits) & 1).T,
        depth, log(chars), log(own[0]), log(words), share, log(tags), chars / tags, stops / np.maximum(words, 1), signs > 0, log(paragraphs), log(items),
        chars / np.maximum(words, 1), chars / max(chars[0], 1), log(siblings[up]), log(siblings), nth / np.maximum(siblings[up], 1), log(same),
        log((sums[up] - chars) / others), share[up], *before, *after,
    ]
    return np.stack([np.asarray(column, np.float32) for column in columns], axis=1)


def choose(page: Page, logits: np.ndarray) -> np.ndarray:
    """The most likely nodes such that no kept node lies in a node that is not kept."""
    best = logits.astype(np.float64).copy()
    parents = page.parents
    for node in range(len(parents) - 1, 0, -1):
        if best[node] > 0:
            best[parents[node]] += best[node]
    kept = best > 0
    for node in range(1, len(parents)):
        kept[node] &= kept[parents[node]]
    return kept


def kept_text(page: Page, kept: np.ndarray) -> str:
    """The blocks of kept nodes in page order, white space as one space, a line each."""
    lines, now, block = [], [], None
    for node, of, content in page.pieces:
        if of != block:
            lines.append("".join(now))
            now, block = [], of
        if kept[node]:
            now.append(content)
    lines.append("".join(now))
    return "\n".join(line for line in (" ".join(line.split()) for line in lines) if line)
