"""HTML to leaf blocks: markup is cut by one pattern, text between block tags is a block."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

#: Elements whose content is never text of the page, nor markup; unclosed, they reach to its end.
_OPAQUE = "script|style|noscript|template|iframe|textarea|title"
#: What stands between a tag's name and its end: a quote opens a value only right after an equals sign.
_ATTRIBUTES = r"""(?:=\s*(?:"[^"]*(?:"|\Z)|'[^']*(?:'|\Z)|[^\s>"'][^\s>]*)?|[^>=])*"""
_MARKUP = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))"
    rf"|<({_OPAQUE})(?=[\s/>])[^>]*?(?:/>|>.*?(?:</\1(?=[\s/>])[^>]*(?:>|\Z)|\Z))"
    r"|<[!?][^>]*(?:>|\Z)"
    rf"|<(/?)([a-zA-Z][^\s/>]*)({_ATTRIBUTES})(?:>|\Z)",
    re.S | re.I,
)
_NAMES = re.compile(r"""\b(?:class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_PARTS = re.compile(r"[a-z]+")
#: Elements inside a line of text; every other element begins and ends a block.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr img br input".split()
)
#: Elements without content.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: An opening tag of the first kind closes an open one of the same kind (unclosed ends are common).
_CLOSES_SELF = frozenset("p li dt dd tr td th option".split())


@dataclass(slots=True)
class Block:
    """A leaf text with the path of elements around it; each with its class, id and role words."""

    path: tuple[tuple[str, ...], ...]
    text: str


def leaf_blocks(page: str | None) -> list[Block]:
    """The page's non-empty blocks in order; character references decoded, white space joined."""
    page = page or ""
    blocks: list[Block] = []
    stack: list[tuple[str, ...]] = []
    parts: list[str] = []
    at = 0

    def close_block() -> None:
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            parts.clear()
            if text:
                blocks.append(Block(tuple(stack), text))

    for m in _MARKUP.finditer(page):
        if m.start() > at:
            parts.append(page[at : m.start()])
        at = m.end()
        name = m[3]
        if name is None:
            if m[1] is not None:
                parts.append(" ")
            continue
        name = name.lower()
        if name in INLINE:
            if name == "br":
                parts.append(" ")
            if name in VOID or not m[4]:
                continue
            # an inline element with a class or role of its own still names its text
            continue
        close_block()
        if m[2]:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == name:
                    del stack[depth:]
                    break
        elif name not in VOID and not m[4].rstrip().endswith("/"):
            if name in _CLOSES_SELF and stack and stack[-1][0] == name:
                stack.pop()
            named = [w for a in _NAMES.finditer(m[4]) for w in _PARTS.findall((a[1] or a[2] or a[3] or "").lower())]
            stack.append((name, *named))
    if at < len(page):
        parts.append(page[at:])
    close_block()
    return blocks
