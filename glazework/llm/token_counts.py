"""Token counts by section through offsets (operator 10).

A whole text is encoded once. The byte span of each token follows from the lengths of the
tokens; the sections (lines, by default) are byte spans of the same text, each with
the separator that ends it. Tokens and sections are two sorted lists of intervals, joined by
binary search. A token that crosses a boundary goes to one section by the rule:

* ``first``: the section of its first byte;
* ``most``: the section with most of its bytes, the earlier one at a tie.

The counts of a text's sections always add up to its tokens.

Defined results: a null text has no section and no token; an empty text has one empty section;
sections that win no token count 0; repeated rows each get a row; an empty table gives
no rows. Extra columns are carried only if named.

Scale: one pass, no shuffle; a task holds one batch of texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .byte_bpe import byte_encoder

RULES = ("first", "most")


def section_ends(raw: bytes, separator: bytes) -> np.ndarray:
    """Byte ends of the sections; a section holds its closing separator."""
    ends, at = [], raw.find(separator)
    while at >= 0:
        ends.append(at + len(separator))
        at = raw.find(separator, at + len(separator))
    ends.append(len(raw))
    return np.array(ends, np.int64)


def attribute(token_ends: np.ndarray, ends: np.ndarray, rule: str) -> tuple[np.ndarray, int]:
    """(tokens of each section, tokens that cross a boundary)."""
    starts = np.r_[0, token_ends[:-1]] if len(token_ends) else token_ends
    # empty sections have no bytes: 'right' passes over them for starts, 'left' stops before them for ends
    first = np.searchsorted(ends, starts, side="right")
    last = np.searchsorted(ends, token_ends, side="left")
    home = first.copy()
    crossing = np.flatnonzero(last > first)
    if rule == "most":
        for t in crossing:
            cuts = np.clip(ends[first[t] : last[t]], starts[t], token_ends[t])
            home[t] = first[t] + int(np.argmax(np.diff(np.r_[starts[t], cuts, token_ends[t]])))
    return np.bincount(home, minlength=len(ends)), len(crossing)


def _count_batches(path: str, separator: bytes, rule: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = byte_encoder(path).encode
        for batch in batches:
            carried = batch.num_columns - 1
            sections, totals, crossings = [], [], []
            for value in batch.column(carried):
                text = value.as_py()
                if text is None:
                    counts, crossing = np.empty(0, np.int64), 0
                else:
                    _, token_ends = encode(text)
                    counts, crossing = attribute(token_ends, section_ends(text.encode(), separator), rule)
                sections.append(counts)
                totals.append(int(counts.sum()))
                crossings.append(crossing)
            arrays = [
                *(batch.column(i) for i in range(carried)),
                pa.array(totals, pa.int64()),
                pa.array([len(s) for s in sections], pa.int64()),
                pa.array(crossings, pa.int64()),
                pa.array(sections, pa.list_(pa.int64())),
            ]
            names = [*batch.schema.names[:-1], "n_tokens", "n_sections", "n_crossing", "section_tokens"]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return run


def count_tokens(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
    separator: str = "\n", rule: str = "most", keep: list[str] | None = None,
) -> DataFrame:
    """(id, carried columns, n_tokens, n_sections, n_crossing, section_tokens) of every row."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    own = {"n_tokens", "n_sections", "n_crossing", "section_tokens"}
    carry = [id_col, *[c for c in (keep or []) if c != id_col and c not in own]]
    plain = docs.select(*carry, F.col(text_col).alias("_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema.fields[:-1])
    return plain.mapInArrow(
        _count_batches(tokenizer_path, separator.encode(), rule),
        f"{schema}, n_tokens bigint, n_sections bigint, n_crossing bigint, section_tokens array<bigint>",
    )
