"""Leaf blocks of an HTML page: the text between two block boundaries, with the elements around it.

Scripts, styles, comments, the head and other elements without readable text are left out; formulas are text of their
line. Character references are decoded, white space becomes single spaces. Tags that were not closed are closed as
browsers do for paragraphs, list items and table parts; a stray end tag is ignored. The head ends where something
stands that may not be in it. A drawing, list of options or player that is never closed ends at the first block after
it, or where an element around it ends. Markup that breaks off at the end of the page is no text.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
#: These end at their end tag and nowhere else: what looks like markup in them is none.
_RAW = {
    tag: re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I)
    for tag in ("script", "style", "title", "textarea", "iframe", "noscript")
}
_PART = re.compile(r"[a-z]+")

#: Fixed by HTML: elements without an end tag, elements inside a line of text, and elements whose content is no text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong "
    "sub sup time tt u var wbr img "
    "math mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle merror mpadded mphantom menclose mfenced msub msup "
    "msubsup munder mover munderover mmultiscripts mprescripts mtable mtr mtd semantics maction".split()
)
#: Besides the raw ones; a template is the only one that runs to the end of the page if it is not closed.
OPAQUE = frozenset("template svg object canvas audio video select annotation annotation-xml".split())
_PAIRED = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|title|textarea|iframe|noscript)\b.*?(?:</\1\b|\Z)"
    rf"|<(/?)({'|'.join(sorted(OPAQUE, key=len, reverse=True))})(?=[\s/>])((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>",
    re.S | re.I,
)
#: What may stand in the head; anything else begins the body.
_IN_HEAD = frozenset("base basefont bgsound link meta title noscript noframes style script template head html".split())
#: Start tags that end an opaque element without end tag.
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre section summary table tbody td tfoot th thead tr "
    "ul".split()
)
#: Elements that end an open element of the same kind, and how far up that is looked for.
_ENDS = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select",)),
}


@dataclass(slots=True)
class Block:
    """Text with the names of the elements around it, outermost first, and the share of it that is linked."""

    text: str
    path: tuple[str, ...]
    linked: float


def _names(tag: str, attributes: str) -> tuple[str, ...]:
    """The tag and the words of its class, id and role."""
    if not attributes or attributes.isspace():
        return (tag,)
    words = [w for m in _ATTRIBUTE.finditer(attributes) for w in _PART.findall(next(filter(None, m.groups()), "").lower())]
    return (tag, *(f".{w}" for w in dict.fromkeys(words)))


def _ends_of_opaque(page: str) -> dict[int, int]:
    """Where each closed opaque element ends, by the place of its start tag. An end tag closes the last one open."""
    found: dict[int, int] = {}
    open_: dict[str, list[int]] = {}
    for match in _PAIRED.finditer(page):
        ending, tag, rest = match.group(2, 3, 4)
        if tag is None:
            continue
        begins = open_.setdefault(tag.lower(), [])
        if not ending:
            if not rest.endswith("/"):
                begins.append(match.start())
        elif begins:
            found[begins.pop()] = match.end()
    return found


def blocks(page: str | None) -> list[Block]:
    """All leaf blocks of a page in order; none for a null or empty page."""
    out: list[Block] = []
    if not page:
        return out
    stack: list[tuple[str, tuple[str, ...]]] = []
    parts: list[str] = []
    linked = total = links = 0
    opaque = ""  # an element without end tag, whose content is left out
    head = False
    ends: dict[int, int] | None = None
    at = 0

    def close() -> None:
        nonlocal linked, total
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                path = tuple(n for tag, names in stack if tag not in INLINE for n in names)
                out.append(Block(text, path, linked / max(total, 1)))
            parts.clear()
            linked = total = 0

    def leave(index: int) -> None:
        nonlocal links
        for tag, _ in stack[index:]:
            links -= tag == "a"
        del stack[index:]

    while match := _TOKEN.search(page, at):
        begin, end = match.span()
        if not opaque and begin > at:
            head = head and page[at:begin].isspace()
            parts.append(page[at:begin])
            total += begin - at
            linked += (begin - at) * (links > 0)
        at = end
        ending, tag, rest = match.group(1, 2, 3)
        if tag is None:
            ending, tag, rest = match.group(4, 5, 6)
            if tag is None:
                continue
        tag = tag.lower()
        if tag in _RAW:
            if not ending and (tag in ("script", "style") or not rest.endswith("/")):
                raw = _RAW[tag].search(page, end)
                at = raw.end() if raw else len(page)
            continue
        if opaque:
            around = tag not in INLINE and any(name == tag for name, _ in stack)
            if opaque == "template" or not (around if ending else tag in BLOCK):
                continue
            opaque = ""
        if tag == "head":
            close()
            head = not ending
            continue
        if head and (tag in ("body", "html", "br") if ending else tag not in _IN_HEAD):
            head = False
        if head and tag != "template":
            continue
        if tag in OPAQUE:
            if not ending and not rest.endswith("/"):
                if ends is None:
                    ends = _ends_of_opaque(page)
                if begin in ends:
                    at = ends[begin]
                else:
                    opaque = tag
            continue
        inline = tag in INLINE
        if not inline:
            close()
        if ending:
            for index in range(len(stack) - 1, -1, -1):
                if stack[index][0] == tag:
                    leave(index)
                    break
                if inline and stack[index][0] not in INLINE:
                    break
            continue
        if tag in VOID:
            continue
        if not inline:
            _implied(stack, tag, leave)
        stack.append((tag, _names(tag, rest)))
        links += tag == "a"
    if not opaque and at < len(page):
        parts.append(page[at:])
        total += len(page) - at
    close()
    return out


def _implied(stack: list, tag: str, leave) -> None:
    """Close what a block's start tag closes: an open paragraph, or an item of the same kind."""
    ends, stop = _ENDS.get(tag, (("p",), ("article", "section", "div", "td", "th", "li", "body", "blockquote")))
    for index in range(len(stack) - 1, -1, -1):
        name = stack[index][0]
        if name in ends:
            leave(index)
            return
        if name in stop:
            return
