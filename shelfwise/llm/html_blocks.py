"""Leaf blocks of a web page: text between block-level tags, with the elements around it."""

from __future__ import annotations

import html
import re
from typing import NamedTuple

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style".split())
UNSEEN = frozenset("head title template textarea svg math iframe object canvas audio video noframes noembed".split())
#: What can stand in a head; any other start tag ends it.
HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
#: Unseen elements that any start tag of HTML's own blocks ends.
FOREIGN = frozenset("svg math".split())
BLOCK = frozenset(
    "article aside blockquote body center dd div dl dt fieldset footer form h1 h2 h3 h4 h5 h6 header hr li main nav ol p pre"
    " section table ul".split()
)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small"
    " span strike strong sub sup time tt u var wbr".split()
)
#: A start tag that ends an open element of the same kind, and where to stop looking for it.
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
    "th": ("td", "th"), "option": ("option",), "thead": ("tr",), "tbody": ("tr", "thead"), "tfoot": ("tr", "tbody"),
}
SCOPE = frozenset("html body table ul ol dl select article section main div nav aside header footer form td th".split())

_MARKUP = re.compile(
    r"""<!--(?:-?>|.*?(?:-->|\Z))|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)"""
    # Quotes delimit a value only right after its equals sign; they are plain characters elsewhere.
    r"""((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)?+)*+)>|<[a-zA-Z/!?][^>]*>""",
    re.S,
)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|style|aria-hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""", re.I)
_TOKEN = re.compile(r"[a-z0-9]+")


class Block(NamedTuple):
    path: tuple[str, ...]  # names of the elements around it, each with its marks after a space
    parent: int  # number of the innermost block-level element
    text: str
    link_chars: int


def _marks(attributes: str) -> str:
    """Class, id and role as plain words, and whether the element is hidden."""
    words = []
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), next((v for v in values if v), "").lower()
        if name in ("class", "id", "role"):
            words += _TOKEN.findall(value)
        elif name == "style":
            words += ["unseen"] if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value) else []
        elif value != "false":
            words.append("unseen")
    return " ".join(words)


def blocks(page: str | None) -> list[Block]:
    """All leaf blocks with text, in page order; none for null.

    Scripts, styles, comments and the head are left out; character references
    are decoded; white space becomes single spaces; an open paragraph or list
    item ends where the next one begins.  A head without an end tag ends where
    the body begins; another unseen element that is never closed hides nothing.
    """
    page = page or ""
    out: list[Block] = []
    open_tags: list[tuple[str, str, int]] = []  # name, name with marks, number
    number = 0
    texts: list[str] = []
    linked = 0
    unseen = 0

    def flush() -> None:
        nonlocal texts, linked
        if texts:
            text = " ".join(html.unescape("".join(texts)).split())
            if text:
                path = tuple(full for _, full, _ in open_tags)
                parent = next((n for name, _, n in reversed(open_tags) if name not in INLINE), 0)
                out.append(Block(path, parent, text, linked))
            texts, linked = [], 0

    def pop_to(place: int) -> None:
        nonlocal unseen
        for name, _, _ in open_tags[place:]:
            unseen -= name in UNSEEN
        del open_tags[place:]

    last_end: dict[str, int] = {}

    def closed_later(name: str, at: int) -> bool:
        if name not in last_end:
            last_end[name] = max((m.start() for m in re.finditer(rf"</{name}(?![a-z0-9:-])", page, re.I)), default=-1)
        return last_end[name] >= at

    at = 0
    while at < len(page):
        found = _MARKUP.search(page, at)
        end = found.start() if found else len(page)
        if unseen and open_tags[-1][0] == "head" and page[at:end].strip():
            pop_to(len(open_tags) - 1)
        if end > at and not unseen:
            texts.append(page[at:end])
            if any(name == "a" for name, _, _ in open_tags[-4:]):
                linked += end - at
        if not found:
            break
        at = found.end()
        closing, name, attributes = found[1], found[2], found[3]
        if name is None:
            continue
        name = name.lower()
        if name in RAW:  # no part of the text, and no end of a block
            if not closing:
                close = re.compile(rf"</{name}\b[^>]*>", re.I).search(page, at)
                at = close.end() if close else len(page)
            continue
        if name not in INLINE:
            flush()
        elif name == "br":
            texts.append(" ")
        if closing:
            for place in range(len(open_tags) - 1, -1, -1):
                if open_tags[place][0] == name:
                    pop_to(place)
                    break
                if name in INLINE and open_tags[place][0] not in INLINE:
                    break
            continue
        for place in range(len(open_tags) - 1, -1, -1) if unseen else ():
            around = open_tags[place][0]
            if around in FOREIGN and name in BLOCK:
                pop_to(place)
            elif around == "head" and (name == "body" or place == len(open_tags) - 1 and name not in HEAD):
                pop_to(place)
                break
            elif around in UNSEEN and around not in FOREIGN or around == "foreignobject":
                break
        if name in VOID or attributes.endswith("/") and (name in INLINE or name in FOREIGN):
            continue
        if name == "title" and not any(around in FOREIGN for around, _, _ in open_tags):
            close = re.compile(r"</title\b[^>]*>|<body\b", re.I).search(page, at) if closed_later(name, at) else None
            if close and close[0][1] == "/":  # its text may hold anything
                at = close.end()
            else:
                start = page.find("<", at)
                at = start if start >= 0 else len(page)
            continue
        if name in UNSEEN and name != "head" and not closed_later(name, at):
            continue
        ends = CLOSES.get(name, () if name in INLINE else ("p",))
        if name not in INLINE:
            ends = (*ends, "p")
        for place in range(len(open_tags) - 1, -1, -1):
            if open_tags[place][0] in ends:
                pop_to(place)
                continue
            if open_tags[place][0] in SCOPE:
                break
        number += 1
        marks = _marks(attributes) if attributes else ""
        open_tags.append((name, f"{name} {marks}" if marks else name, number))
        unseen += name in UNSEEN
    flush()
    return out
