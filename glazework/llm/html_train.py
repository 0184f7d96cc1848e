"""Made-up pages with known labels, the training input of the block labeller.

The corpus has no labelled pages, so layouts are drawn at random: containers of the
main text and of everything around it, with words that have no meaning of their own.
"""

from __future__ import annotations

import numpy as np

from .html_pages import Block

#: Containers of main text: (element, class words).
MAIN = [
    ("article",), ("article",), ("article", "post"), ("main",), ("main", "content"), ("div", "content"),
    ("div", "post"), ("div", "entry", "content"), ("div", "article", "body"), ("section", "story"),
    ("div", "text"), ("div", "main"),
]
#: Containers that are never main text, with the elements of their blocks.
AROUND = [
    ("nav",), ("nav", "menu"), ("div", "nav"), ("div", "menu"), ("ul", "navbar"), ("div", "breadcrumb"),
    ("header",), ("div", "header"), ("div", "masthead"), ("div", "banner"),
    ("footer",), ("footer", "site"), ("div", "footer"), ("div", "copyright"),
    ("aside",), ("aside", "widget"), ("div", "sidebar"), ("div", "side"), ("div", "widget"), ("div", "related"),
    ("div", "ad"), ("div", "ad"), ("div", "ads"), ("div", "advert"), ("div", "advertisement"), ("section", "sponsored"),
    ("div", "promo"), ("div", "notice"), ("div", "cookie"), ("div", "consent"), ("div", "alert"), ("div", "popup"),
    ("form",), ("form", "search"), ("div", "newsletter"), ("div", "subscribe"), ("div", "login"),
    ("section", "comments"), ("div", "comments"), ("div", "comment"), ("ol", "comment", "list"), ("div", "reply"),
    ("div", "share"), ("div", "social"), ("div", "pagination"), ("div", "tags"), ("div", "meta"), ("div", "menu", "main"),
]
#: Elements around both kinds.
WRAP = [("div",), ("div", "wrapper"), ("div", "page"), ("div", "container"), ("section",), ("div", "row"), ("center",)]
INNER = [("p",), ("p",), ("p",), ("p",), ("h",), ("blockquote",), ("pre",), ("ul", "li"), ("div",), ("table", "tr", "td")]
SYLLABLES = [a + b for a in "bcdfghjklmnprstvw" for b in ("a", "e", "i", "o", "u", "an", "er", "in", "on", "th")]
BOILER = "cookie cookies subscribe newsletter copyright rights reserved comment comments share login menu home search \xa9".split()


def word_pool(rng: np.random.Generator, n: int = 4000) -> list[str]:
    """Words that mean nothing, a few with accents or digits."""
    parts = rng.integers(0, len(SYLLABLES), (n, 3))
    sizes = rng.integers(1, 4, n)
    pool = ["".join(SYLLABLES[j] for j in row[:k]) for row, k in zip(parts, sizes)]
    return [w + "\xe9" if i % 11 == 0 else str(i) if i % 97 == 0 else w for i, w in enumerate(pool)]


def _text(rng: np.random.Generator, pool: list[str], n: int, boiler: bool) -> str:
    words = [pool[i] for i in rng.integers(0, len(pool), n)]
    if boiler and rng.random() < 0.3:
        words[int(rng.integers(n))] = BOILER[rng.integers(len(BOILER))]
    # sentences or bare phrases on both sides: the text alone must not decide
    if rng.random() < 0.7:
        for i in range(int(rng.integers(2, 12)), n, int(rng.integers(4, 15))):
            words[i - 1] += "."
        words[-1] += "."
    return " ".join(words).capitalize()


def _inner(rng: np.random.Generator, first: bool) -> tuple[tuple[str, ...], ...]:
    if first and rng.random() < 0.8:
        return ((f"h{rng.integers(1, 3)}",),)
    kind = INNER[rng.integers(len(INNER))]
    return tuple((f"h{rng.integers(2, 5)}" if e == "h" else e,) for e in kind)


def _around(rng: np.random.Generator, pool: list[str], path: tuple, out: list, size: int = 8) -> None:
    inside = (*path, AROUND[rng.integers(len(AROUND))])
    listed = rng.random() < 0.5
    for _ in range(int(rng.integers(1, size))):
        words = int(rng.integers(8, 60) if rng.random() < 0.3 else rng.integers(1, 8))
        leaf = (("ul",), ("li",)) if listed else () if rng.random() < 0.4 else _inner(rng, False)
        out.append((Block(inside + leaf, _text(rng, pool, words, True)), 0))


def made_up_page(rng: np.random.Generator, pool: list[str]) -> list[tuple[Block, int]]:
    """One page: its blocks with 1 for main text, 0 for the rest."""
    out: list[tuple[Block, int]] = []
    top = (("html",), ("body",))
    for _ in range(int(rng.integers(0, 4))):
        _around(rng, pool, top + (WRAP[rng.integers(len(WRAP))],) * int(rng.random() < 0.3), out)
    path = top + tuple(WRAP[rng.integers(len(WRAP))] for _ in range(int(rng.integers(0, 3))))
    main = (*path, MAIN[rng.integers(len(MAIN))])
    if rng.random() < 0.3:
        main = (*main, (("div",), ("section",), ("div", "body"))[rng.integers(3)])
    n = int(rng.integers(1, 14))
    for i in range(n):
        if i and rng.random() < 0.15:
            _around(rng, pool, main, out, 4)
        words = int(rng.integers(1, 12) if rng.random() < 0.4 else rng.integers(12, 120))
        out.append((Block(main + (_inner(rng, i == 0) if rng.random() < 0.95 else ()), _text(rng, pool, words, False)), 1))
    for _ in range(int(rng.integers(0, 3))):
        _around(rng, pool, main, out, 6)
    for _ in range(int(rng.integers(0, 4))):
        _around(rng, pool, path if rng.random() < 0.5 else top, out)
    return out
