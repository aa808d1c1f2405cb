"""The text blocks of a web page, with where they stand in the tree."""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass, field

# Element names of HTML.
RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes"}
SKIPPED = {"head", "script", "style", "title", "noscript", "template", "svg", "annotation", "annotation-xml", "canvas", "object", "audio", "video", "iframe", "textarea", "select", "option", "button", "datalist", "noembed", "noframes", "xmp"}
INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img input ins kbd label mark meter output progress q ruby rt rp s samp small span strike strong sub sup time tt u var wbr "
    "math mi mn mo ms mtext mspace mrow mfrac msqrt mroot msub msup msubsup munder mover munderover mmultiscripts mtable mtr mtd mstyle mpadded mphantom merror "
    "semantics".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
# Elements that an opening tag of the given kinds closes.
CLOSED_BY = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "thead": {"tr", "td", "th"}, "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"},
}
# Implied ends do not reach beyond these.
SCOPES = {"ul", "ol", "dl", "table", "div", "article", "section", "main", "body", "nav", "aside", "header", "footer", "form"}

# A name, and the value as written: in quotes, which may be missing at the end, or up to the next space. No part of it is tried
# twice, so a tag is read in one go.
_VALUE = r"""(?:"[^"]*+"|'[^']*+'|[^\s>]*+)"""
_ATTRIBUTE = re.compile(rf"([^\s/>][^\s/>=]*+)(?:\s*+=\s*+({_VALUE}))?+")
_TAG = re.compile(rf"<(/?)([a-zA-Z][^\s/>]*+)((?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+{_VALUE})?+)*+)>")
_TAG_START = re.compile(r"</?[a-zA-Z]")
_SPACE = re.compile(r"\s+")


@dataclass
class Element:
    name: str
    marks: str  # class, id and role, in small letters
    parent: int
    depth: int


@dataclass
class Block:
    text: str
    element: int  # the innermost block element
    link_chars: int = 0
    tags: set[str] = field(default_factory=set)


def _spaced(text: str) -> str:
    return _SPACE.sub(" ", text).strip()


def _marks(attributes: str) -> str:
    """The class, id and role of a tag, and ``hidden`` if it is."""
    found: dict[str, str] = {}
    for match in _ATTRIBUTE.finditer(attributes):
        value = match[2] or ""
        if len(value) > 1 and value[0] in "\"'" and value[-1] == value[0]:
            value = value[1:-1]
        # Of attributes that are repeated the first counts.
        found.setdefault(match[1].lower(), value.lower())
    marks = " ".join(value for key, value in found.items() if key in ("class", "id", "role"))
    if "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", ""):
        marks += " hidden"
    return marks


def parse(page: str | None) -> tuple[list[Element], list[Block]]:
    """The elements of the page (the first is its root) and its blocks in page order.

    A block is the text between two borders of block elements. Character references are decoded, a run of white
    space is one space. Broken markup is read as far as it goes: ends that are missing are implied, others
    are ignored. A comment without an end runs to the page's end; a tag without one is text, and so is all behind it. The page is
    read once from front to back.
    """
    elements = [Element("", "", 0, 0)]
    blocks: list[Block] = []
    if not page:
        return elements, blocks
    stack = [0]  # open block elements
    opened: Counter[str] = Counter()  # how many of each name
    skipping: list[str] = []  # open elements whose content is no text
    links = 0
    pieces: list[str] = []
    linked: list[int] = []
    inline: set[str] = set()

    def close_block() -> None:
        if pieces:
            text = _spaced(html.unescape("".join(pieces)))
            if text:
                blocks.append(Block(text, stack[-1], sum(linked), set(inline)))
            pieces.clear()
            linked.clear()
        inline.clear()

    def add(text: str) -> None:
        if text and not skipping:
            pieces.append(text)
            if links:
                linked.append(len(text))

    at = 0
    while True:
        start = page.find("<", at)
        if start < 0:
            add(page[at:])
            break
        if page.startswith("<!--", start):
            add(page[at:start])
            end = page.find("-->", start + 2)
            at = len(page) if end < 0 else end + 3
            continue
        if page.startswith(("<!", "<?"), start):  # doctype or processing instruction
            add(page[at:start])
            end = page.find(">", start)
            at = len(page) if end < 0 else end + 1
            continue
        match = _TAG.match(page, start)
        if match is None:
            if _TAG_START.match(page, start):
                add(page[at:])
                break
            add(page[at : start + 1])
            at = start + 1
            continue
        add(page[at:start])
        at = match.end()
        name, closing = match[2].lower(), bool(match[1])
        if skipping:
            if closing and name in skipping:
                while skipping.pop() != name:
                    pass
            elif not closing and name in SKIPPED and name not in RAW:
                skipping.append(name)
            elif not closing and name == "body":  # a head without an end
                skipping.clear()
            if skipping or closing:
                continue
        if name in SKIPPED:
            if closing:
                continue
            if name in RAW:
                found = re.compile(rf"</{name}(?=[\s/>])", re.I).search(page, at)
                end = -1 if found is None else page.find(">", found.end())
                at = len(page) if end < 0 else end + 1
            elif not match[3].rstrip().endswith("/"):
                skipping.append(name)
            if name not in INLINE:
                add(" ")
            continue
        if name in INLINE:
            if name == "a":
                links = 0 if closing else 1
            elif name == "br":
                add(" ")
            if not closing:
                inline.add(name)
            continue
        # The border of a block element.
        close_block()
        links = 0
        if closing:
            while opened[name]:
                opened[last := elements[stack.pop()].name] -= 1
                if last == name:
                    break
            continue
        if name in VOID:
            continue
        if elements[stack[-1]].name == "p" or elements[stack[-1]].name in HEADINGS and name in HEADINGS:
            opened[elements[stack.pop()].name] -= 1
        closes = CLOSED_BY.get(name)
        if closes and any(opened[other] for other in closes):
            for place in range(len(stack) - 1, 0, -1):
                if elements[stack[place]].name in closes:
                    opened.subtract(elements[e].name for e in stack[place:])
                    del stack[place:]
                    # A row's end also ends its cells, found further out.
                    if name not in ("tr", "thead", "tbody", "tfoot"):
                        break
                elif elements[stack[place]].name in SCOPES:
                    break
        marks = _marks(match[3]) if match[3] else ""
        elements.append(Element(name, marks, stack[-1], elements[stack[-1]].depth + 1))
        stack.append(len(elements) - 1)
        opened[name] += 1
    close_block()
    return elements, blocks
