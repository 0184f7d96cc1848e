"""Chat formatting with offset-aligned loss masks (operator 9).

A conversation is rendered whole: ``<|turn|>role<|text|>text<|end|>`` for each turn,
in turn order. Inside roles and texts a backslash is doubled and ``<|`` becomes ``<\\|``,
so no text holds a control string, and the escape is undone exactly. The
rendering is encoded once, the three control strings as one token each, so no token
crosses into or out of a text. The byte spans of the turns' texts and those of the tokens are
sorted; binary search gives the tokens of each span. The loss mask is 1 on the tokens
of assistant texts.

Defined results: a null text or role is empty; turns are ordered by (turn, role, text), nulls
first, so ties and repeated rows (each a turn of its own) have one order; rows with a
null id are one conversation; an empty table gives no rows. Extra columns are ignored.

Scale: sizes of conversations are summed map-side first. Those of up to ``WHOLE_BYTES`` meet in one shuffle
by conversation and are rendered as one row (``segment`` 0, ``whole``). The rows of a longer one are dealt by ranges
of (conversation, turn, beginnings of role and text) over many tasks and sorted there; each task renders and encodes
its stretch as a stream, in segments of about ``SEGMENT_CHARS`` cut between turns. As no token crosses a control
string, the segments in the order of ``segment`` (rising, with gaps) are the rendering, the ids and the mask of the
whole; mask runs count from the segment's first token. Only turns that agree in all four range keys stay in one task,
as a sorted stream. The mask is returned as runs, in proportion to the turns.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glazework.session import broadcast_if_small

from .byte_bpe import byte_encoder
from .common import stored

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
CONTROLS = (TURN, TEXT, END)
LEARNT_ROLE = "assistant"
RESULT = (
    "n_turns bigint, formatted string, token_ids array<int>, mask_starts array<bigint>, mask_ends array<bigint>"
)
#: Conversations with up to so many bytes (``ROW_BYTES`` more for each turn) are one row.
WHOLE_BYTES = 4 << 20
ROW_BYTES = 32
#: A segment of a longer conversation ends with the turn that reaches this length.
SEGMENT_CHARS = 1 << 20
#: Characters of a role or text that tell the range of a turn.
KEY_CHARS = 64
_ESCAPED = re.compile(r"\\(.)", re.S)


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def render(turns: list[tuple[str | None, str | None]]) -> tuple[str, list[tuple[int, int]]]:
    """(the rendering, byte spans of the learnt texts in it)."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head = f"{TURN}{escape(role or '')}{TEXT}"
        body = escape(text or "")
        at += len(head.encode())
        size = len(body.encode())
        if role == LEARNT_ROLE:
            spans.append((at, at + size))
        at += size + len(END)
        parts += (head, body, END)
    return "".join(parts), spans


def mask_runs(token_ends: np.ndarray, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Runs [first, past the last) of the tokens that make up each span."""
    starts = np.r_[0, token_ends[:-1]] if len(token_ends) else token_ends
    if not spans:
        return []
    begin, end = np.array(spans, np.int64).T
    first = np.searchsorted(starts, begin, side="left")
    last = np.searchsorted(starts, end, side="left")
    return [(int(a), int(b)) for a, b in zip(first, last) if b > a]


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn, back from a rendering."""
    turns = []
    for part in formatted.split(TURN)[1:]:
        role, _, body = part.partition(TEXT)
        turns.append((unescape(role), unescape(body[: -len(END)])))
    return turns


def masked_texts(formatted: str, token_ends: np.ndarray, runs: list[tuple[int, int]]) -> list[str]:
    """The texts under the mask, back from rendering, offsets and mask."""
    raw = formatted.encode()
    starts = np.r_[0, token_ends[:-1]] if len(token_ends) else token_ends
    return [unescape(raw[int(starts[a]) : int(token_ends[b - 1])].decode()) for a, b in runs]


def _record_batch(path: str, ids: pa.Array, groups: list[list[tuple[str | None, str | None]]]) -> pa.RecordBatch:
    """Rendering, ids and mask of each group of turns."""
    encode = byte_encoder(path, CONTROLS).encode
    formatted, tokens, firsts, lasts = [], [], [], []
    for turns in groups:
        text, spans = render(turns)
        codes, ends = encode(text)
        runs = mask_runs(ends, spans)
        formatted.append(text)
        tokens.append(codes.astype(np.int32))
        firsts.append([a for a, _ in runs])
        lasts.append([b for _, b in runs])
    longs = pa.list_(pa.int64())
    arrays = [
        ids, pa.array([len(g) for g in groups], pa.int64()), pa.array(formatted, pa.string()),
        pa.array(tokens, pa.list_(pa.int32())), pa.array(firsts, longs), pa.array(lasts, longs),
    ]
    return pa.RecordBatch.from_arrays(
        arrays, names=["_id", "n_turns", "formatted", "token_ids", "mask_starts", "mask_ends"]
    )


def _format_batches(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            groups = [
                [(t["role"].as_py(), t["text"].as_py()) for t in turns.values] if turns.is_valid else []
                for turns in batch.column(1)
            ]
            yield _record_batch(path, batch.column(0), groups)

    return run


def _segment_batches(path: str, segment_chars: int):
    """Renders sorted turns, (id, role, text) a row, as segments of one conversation each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        turns: list[tuple[str | None, str | None]] = []
        conv, kind, chars = None, None, 0

        def taken() -> pa.RecordBatch:
            out = _record_batch(path, pa.array([conv], kind), [turns])
            return out.append_column("segment", pa.array([number], pa.int64()))

        for batch in batches:
            kind = batch.schema.field(0).type
            for key, role, text in zip(*batch.columns):
                key = key.as_py()
                if turns and (chars >= segment_chars or not (key == conv or key != key and conv != conv)):
                    yield taken()
                    number, turns, chars = number + 1, [], 0
                conv = key
                turns.append((role.as_py(), text.as_py()))
                chars += sum(len(part or "") for part in turns[-1])
        if turns:
            yield taken()

    return run


def format_conversations(
    rows: DataFrame, tokenizer_path: str, id_col: str = "conv_id", turn_col: str = "turn",
    role_col: str = "role", text_col: str = "text", whole_bytes: int = WHOLE_BYTES,
    segment_chars: int = SEGMENT_CHARS,
) -> DataFrame:
    """(id, n_turns, formatted, token_ids, mask_starts, mask_ends, segment, whole) of every conversation.

    One row each, ``whole``, but for conversations over ``whole_bytes``: those have a row for each segment.
    """
    turns = rows.select(
        F.col(id_col).alias("_id"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text")
    )
    kind = turns.schema[0].dataType.simpleString()
    size = F.lit(ROW_BYTES) + sum(F.coalesce(F.octet_length(c), F.lit(0)).cast("long") for c in ("role", "text"))
    sizes = turns.groupBy("_id").agg(F.sum(size).alias("_size")).where(F.col("_size") > whole_bytes)
    long_ones = stored(sizes.select(F.col("_id").alias("_long")), "long-conversations")
    some_long = not long_ones.isEmpty()

    def part(how: str) -> DataFrame:
        return turns.join(broadcast_if_small(long_ones), turns["_id"].eqNullSafe(long_ones["_long"]), how)

    short = part("left_anti") if some_long else turns
    listed = short.groupBy("_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("_turns"))
    out = listed.mapInArrow(_format_batches(tokenizer_path), f"_id {kind}, {RESULT}").withColumns(
        {"segment": F.lit(0).cast("long"), "whole": F.lit(True)}
    )
    if some_long:
        begins = [F.substring(c, 1, KEY_CHARS) for c in ("role", "text")]
        dealt = part("left_semi").repartitionByRange("_id", "turn", *begins)
        ordered = dealt.sortWithinPartitions("_id", "turn", "role", "text").select("_id", "role", "text")
        segments = ordered.mapInArrow(
            _segment_batches(tokenizer_path, segment_chars), f"_id {kind}, {RESULT}, segment bigint"
        )
        out = out.unionByName(segments.withColumn("whole", F.lit(False)))
    return out.withColumnRenamed("_id", id_col)
