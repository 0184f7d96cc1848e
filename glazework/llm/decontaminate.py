"""Pigeonhole edit matching of benchmark items in documents (operator 7).

Texts are lower-cased, white space runs become one space. An item of m characters may
differ from a passage by ``k = floor(RATE * m)`` edits; it is cut into k + 1
pieces, so at least one piece occurs unchanged in any such passage. One
automaton finds the pieces of all items in a whole document. A hit tells where
the item would start; hits of an item that agree on that within the budget are one
candidate, verified over its window with Myers' bit-parallel distance (the pattern
may start and end anywhere in the window).

A candidate with one hit alone needs no window unless the next piece fits with one
edit: with k edits and every other of the k pieces changed, each has exactly one.

An item of fewer than 1 / ``RATE`` characters has no budget: it is found as it is, inside words too.

Defined results: null and empty texts, and items without a word, match nothing; repeated
documents give a row each; items of one text each give their rows; empty tables give no
rows; very long texts are searched whole, a row at a time. Extra columns of the documents are carried
only if named. Ids may have any type.

Scale: documents are read once per block of items, in the scan's partitions, without
a shuffle. Items are a query set. Equal texts are searched as one, and their ids joined to what is found.
A block has about ``BLOCK_CHARS`` characters, however often a text repeats; more items make more blocks. Blocks
are taken one after the other: the driver passes on one at a time, and what it gave is written before the next.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

#: Edits allowed per character of an item.
RATE = 0.1
#: Characters of items in one block: bounds the automaton that a task holds.
BLOCK_CHARS = 4_000_000


def normal(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def best_match(pattern: str, text: str) -> tuple[int, int]:
    """(least distance of ``pattern`` to any part of ``text``, end of the first such part).

    Myers 1999, the pattern's column in one long integer.
    """
    m = len(pattern)
    masks: dict[str, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = full, 0, m
    best, at = m, 0
    for j, c in enumerate(text, 1):
        eq = masks.get(c, 0)
        xv = eq | minus
        xh = (((eq & plus) + plus) ^ plus) | eq
        ph = minus | (full & ~(xh | plus))
        mh = plus & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph = (ph << 1) & full
        mh = (mh << 1) & full
        plus = mh | (full & ~(xv | ph))
        minus = ph & xv
        if score < best:
            best, at = score, j
    return best, at


def _one_edit(piece: str, text: str) -> bool:
    """Whether some beginning of ``text`` is within one edit of ``piece``."""
    i = next((i for i, (a, b) in enumerate(zip(piece, text)) if a != b), min(len(piece), len(text)))
    rest = piece[i + 1 :]
    return (
        i >= len(piece) - 1
        or text.startswith(rest, i + 1)
        or text.startswith(rest, i)
        or text.startswith(piece[i:], i + 1)
    )


class Matcher:
    """Finds items in normalised texts."""

    def __init__(self, items: list[tuple[object, str]], rate: float = RATE) -> None:
        self.items = [(i, t) for i, t in ((i, normal(t)) for i, t in items) if t]
        self.budgets = [int(rate * len(t)) for _, t in self.items]
        self.cuts = []
        pieces: dict[str, list[tuple[int, int]]] = {}
        for n, (_, text) in enumerate(self.items):
            k = self.budgets[n]
            cuts = [j * len(text) // (k + 1) for j in range(k + 2)]
            self.cuts.append(cuts)
            for j in range(k + 1):
                pieces.setdefault(text[cuts[j] : cuts[j + 1]], []).append((n, j))
        self.automaton = ahocorasick.Automaton()
        for piece, where in pieces.items():
            self.automaton.add_word(piece, (len(piece), where))
        if pieces:
            self.automaton.make_automaton()

    def _plausible(self, text: str, n: int, j: int, start: int) -> bool:
        """For a piece that hit alone at ``start``: whether its neighbour fits with one edit."""
        cuts, item = self.cuts[n], self.items[n][1]
        if len(cuts) == 2:
            return True
        if j + 2 < len(cuts):
            at = start + cuts[j + 1] - cuts[j]
            piece = item[cuts[j + 1] : cuts[j + 2]]
            return _one_edit(piece, text[at : at + len(piece) + 2])
        piece = item[cuts[j - 1] : cuts[j]]
        return _one_edit(piece[::-1], text[max(0, start - len(piece) - 2) : start][::-1])

    def find(self, text: str) -> list[tuple[object, int, int]]:
        """(item id, distance, end in the text) of each item within its budget; its best place."""
        if not self.items or not text:
            return []
        hits: dict[int, list[tuple[int, int, int]]] = {}
        for end, (size, where) in self.automaton.iter(text):
            start = end + 1 - size
            for n, j in where:
                hits.setdefault(n, []).append((start - self.cuts[n][j], j, start))
        found = []
        for n, places in hits.items():
            item, k = self.items[n][1], self.budgets[n]
            places.sort()
            best: tuple[int, int] | None = None
            i = 0
            while i < len(places):
                last = i + 1
                # neighbours in the list that agree within the budget: one candidate
                while last < len(places) and places[last][0] - places[last - 1][0] <= 2 * k:
                    last += 1
                group = places[i:last]
                i = last
                if len({j for _, j, _ in group}) < 2 and not any(self._plausible(text, n, j, s) for _, j, s in group):
                    continue
                low = max(0, group[0][0] - k)
                distance, at = best_match(item, text[low : group[-1][0] + len(item) + k])
                if distance <= k and (best is None or (distance, low + at) < best):
                    best = (distance, low + at)
            if best:
                found.append((self.items[n][0], *best))
        return found


def item_texts(items: DataFrame, text_col: str) -> DataFrame:
    """(_n, _text) of every distinct text of the items, written to the shared folder."""
    texts = items.select(F.col(text_col).alias("_text")).where("_text IS NOT NULL").distinct()
    return stored(texts.select(F.monotonically_increasing_id().alias("_n"), "_text"), "item-texts")


def block_count(items: DataFrame, text_col: str, block_chars: int) -> int:
    total = items.agg(F.sum(F.length(text_col))).first()[0] or 0
    return -(-total // block_chars)


def item_blocks(items: DataFrame, id_col: str, text_col: str, block_chars: int = BLOCK_CHARS) -> Iterator[list]:
    """The items in blocks of about ``block_chars`` characters, dealt by the hash of the text; one at a time."""
    blocks = block_count(items, text_col, block_chars)
    for b in range(blocks):
        part = items.where(F.pmod(F.xxhash64(text_col), F.lit(blocks)) == b).where(F.col(text_col).isNotNull())
        yield [(r[0], r[1]) for r in part.select(id_col, text_col).collect()]


def _match_batches(shared, rate: float) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(shared.value, rate)
        for batch in batches:
            carried = batch.num_columns - 1
            rows, hits = [], []
            for row, text in enumerate(batch.column(carried)):
                for hit in matcher.find(normal(text.as_py())):
                    rows.append(row)
                    hits.append(hit)
            keys = [batch.column(i).take(pa.array(rows, pa.int64())) for i in range(carried)]
            out = [pa.array([h[i] for h in hits], pa.int64()) for i in range(3)]
            names = [*batch.schema.names[:-1], "_n", "distance", "match_end"]
            yield pa.RecordBatch.from_arrays([*keys, *out], names=names)

    return run


def contaminated(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", rate: float = RATE,
    item_id: str = "item_id", item_text: str = "text", block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """(id, item_id, distance, match_end) of every document and item within the item's budget.

    ``match_end``: where the best passage ends, in the normalised text.
    """
    sc = docs.sparkSession.sparkContext
    plain = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    schema = f"_id {plain.schema[0].dataType.simpleString()}, _n bigint, distance bigint, match_end bigint"
    texts = item_texts(items, item_text)
    one = block_count(texts, "_text", block_chars) <= 1
    parts = []
    for block in item_blocks(texts, "_n", "_text", block_chars):
        shared = sc.broadcast(block)
        found = plain.mapInArrow(_match_batches(shared, rate), schema)
        if not one:
            found = stored(found, "item-matches")
            shared.destroy()
        parts.append(found)
    found = reduce(DataFrame.unionByName, parts) if parts else docs.sparkSession.createDataFrame([], schema)
    owners = items.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("_text")).join(texts, "_text")
    return found.join(owners.select("_n", "item_id"), "_n").select(
        F.col("_id").alias(id_col), "item_id", "distance", "match_end"
    )


def _clean_batches(shared, rate: float, text_at: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(shared.value, rate)
        for batch in batches:
            clean = [not matcher.find(normal(t.as_py())) for t in batch.column(text_at)]
            yield batch.filter(pa.array(clean, pa.bool_()))

    return run


def drop_contaminated(
    docs: DataFrame, items: DataFrame, text_col: str = "text", rate: float = RATE,
    item_text: str = "text", block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """``docs`` without the documents that hold an item; all columns as they are."""
    sc, at = docs.sparkSession.sparkContext, docs.columns.index(text_col)
    texts = item_texts(items, item_text)
    one = block_count(texts, "_text", block_chars) <= 1
    for block in item_blocks(texts, "_n", "_text", block_chars):
        shared = sc.broadcast(block)
        docs = docs.mapInArrow(_clean_batches(shared, rate, at), docs.schema)
        if not one:
            docs = stored(docs, "clean-documents")
            shared.destroy()
    return docs
