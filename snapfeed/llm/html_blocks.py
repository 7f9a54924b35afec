"""Leaf blocks of a page: the text between two block tags, with what surrounds it."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

#: Elements that do not end a block (fixed values).
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
#: Elements whose content is never text of a page (fixed values).
OPAQUE = frozenset("script style template noscript iframe object svg math canvas audio video select textarea title head".split())
#: Elements without an end tag (fixed values).
EMPTY = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that an equal one or a block ends.
_CLOSES_P = frozenset("p div ul ol dl table h1 h2 h3 h4 h5 h6 article section aside nav header footer main form blockquote pre figure".split())

_OPEN = re.compile(r"([A-Za-z][^\s/>]*)(.*)", re.S)
_ATTRIBUTE = re.compile(r"\b(class|id|role|style|hidden|aria-hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
# The rest of a tag up to its end: a quoted value may hold the sign; a quote that
# never closes is an ordinary character. What a part has taken is not tried again.
_TAG_END = re.compile(r"(?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+>")
_TOKEN = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")
_ENDS = {name: re.compile(rf"</{name}\b[^>]*>?", re.I) for name in OPAQUE}
_BODY = re.compile(r"</head\b[^>]*>|<body\b[^>]*>", re.I)


@dataclass
class Block:
    text: str
    around: frozenset[str]  # tags and names of the ancestors
    tag: str
    linked: int  # characters inside links


def _names(tag: str, attributes: str) -> frozenset[str]:
    out = {f"<{tag}>"}
    if attributes and not attributes.isspace():
        for m in _ATTRIBUTE.finditer(attributes):
            name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
            if name in ("class", "id", "role"):
                out.update(f".{token}" for token in _TOKEN.findall(value))
            elif name == "hidden" or name == "aria-hidden" and value == "true" or "display:none" in value.replace(" ", ""):
                out.add(".hidden")
    return frozenset(out)


def leaf_blocks(page: str, known: frozenset[str] | None = None) -> list[Block]:
    """Blocks with text, in page order. Only ``known`` ancestor features are kept, if given.

    Every character is looked at a bounded number of times, also where tags,
    quotes, comments or scripts are not closed.
    """
    blocks: list[Block] = []
    stack: list[tuple[str, frozenset[str]]] = [("", frozenset())]
    open_tags: dict[str, int] = {}
    parts: list[str] = []
    linked, in_link = 0, False
    at, size = 0, len(page)
    quotes = True

    def flush() -> None:
        nonlocal linked
        if parts:
            text = _SPACE.sub(" ", html.unescape("".join(parts))).strip()
            if text:
                blocks.append(Block(text, stack[-1][1], stack[-1][0], min(linked, len(text))))
            parts.clear()
        linked = 0

    def pop() -> None:
        open_tags[stack.pop()[0]] -= 1

    while at < size:
        start = page.find("<", at)
        if start < 0:
            start = size
        if start > at:
            parts.append(page[at:start])
            linked += (start - at) * in_link
        if start == size:
            break
        if page.startswith("<!--", start):
            end = page.find("-->", start + 4)
            at = size if end < 0 else end + 3
            continue
        follows = page[start + 1 : start + 2]
        if not (follows.isalpha() and follows.isascii() or follows in ("/", "!", "?") and follows):
            parts.append("<")  # a bare sign
            at = start + 1
            continue
        end = page.find(">", start)
        if end < 0:
            break  # the rest is a tag that never ends
        if quotes and follows not in ("!", "?") and (page.find('"', start, end) >= 0 or page.find("'", start, end) >= 0):
            whole = _TAG_END.match(page, start)
            quotes = whole is not None  # else they do not pair up to the end of the page
            end = whole.end() - 1 if whole else end
        inner = page[start + 1 : end]
        at = end + 1
        closing = inner.startswith("/")
        m = _OPEN.match(inner, closing)
        if not m:
            continue
        tag = m[1].lower()
        if tag == "a":
            in_link = not closing
        if tag in INLINE:
            if tag in ("br", "img", "wbr"):
                parts.append(" " if tag == "br" else "")
            continue
        flush()
        in_link = False
        if closing:
            if open_tags.get(tag):
                while stack[-1][0] != tag:
                    pop()
                pop()
            continue
        if tag in OPAQUE and not inner.endswith("/"):
            found = (_BODY if tag == "head" else _ENDS[tag]).search(page, at)
            at = size if not found else found.start() if tag == "head" and found[0][1] != "/" else found.end()
            continue
        if tag in EMPTY or inner.endswith("/"):
            continue
        if stack[-1][0] == "p" and tag in _CLOSES_P or tag in ("li", "td", "th", "tr", "dt", "dd", "option") and stack[-1][0] == tag:
            pop()
        above = stack[-1][1]
        names = _names(tag, m[2])
        if known is not None:
            names &= known
        stack.append((tag, above if names <= above else above | names))
        open_tags[tag] = open_tags.get(tag, 0) + 1
    flush()
    return blocks
