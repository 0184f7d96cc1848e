"""Digests of formatted conversations, read back from the rendering, ids and mask (operator 9's query)."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .byte_bpe import byte_encoder
from .chat import CONTROLS, masked_texts, parse

RESULT = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
    "formatted_chars bigint, n_tokens bigint, n_loss_tokens bigint"
)


class _Digest:
    """Running figures of one conversation, segment by segment."""

    def __init__(self, conv: int | None) -> None:
        self.conv = conv
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = self.tokens = self.loss_tokens = 0

    def add(self, formatted: str, ends: np.ndarray, runs: list[tuple[int, int]]) -> None:
        for role, text in parse(formatted):
            self.turns.update(f"{role}\n{text}\n".encode())
            self.n_turns += 1
        for text in masked_texts(formatted, ends, runs):
            self.loss.update(text.encode())
            self.loss_chars += len(text)
        self.chars += len(formatted)
        self.tokens += len(ends)
        self.loss_tokens += sum(b - a for a, b in runs)

    def row(self) -> tuple:
        return (
            self.conv, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars,
            self.tokens, self.loss_tokens,
        )


def _record_batch(rows: list[tuple]) -> pa.RecordBatch:
    fields = [c.split() for c in RESULT.split(", ")]
    kinds = [pa.string() if kind == "string" else pa.int64() for _, kind in fields]
    columns = list(zip(*rows)) if rows else [[] for _ in fields]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=[n for n, _ in fields])


def _digest_batches(path: str):
    """Rows of one conversation follow each other, its segments in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = byte_encoder(path, CONTROLS).sizes
        now: _Digest | None = None
        for batch in batches:
            done = []
            for row in zip(*batch.columns):
                conv, formatted, ids, first, last = (v.as_py() for v in row)
                if now is None or now.conv != conv:
                    if now is not None:
                        done.append(now.row())
                    now = _Digest(conv)
                now.add(formatted, np.cumsum(sizes[np.array(ids, np.int64)]), list(zip(first, last)))
            yield _record_batch(done)
        if now is not None:
            yield _record_batch([now.row()])

    return run


def digests(formatted: DataFrame, tokenizer_path: str) -> DataFrame:
    """Figures of every conversation. Segments of a long one meet in one task, where a stream of them is
    digested in order (a SHA-256 has no other way); it holds a batch of segments at a time."""
    columns = ["conv_id", "formatted", "token_ids", "mask_starts", "mask_ends"]
    cut = formatted.where("NOT whole").repartition("conv_id").sortWithinPartitions("conv_id", "segment")
    run = _digest_batches(tokenizer_path)
    whole = formatted.where("whole").select(columns).mapInArrow(run, RESULT)
    return whole.unionByName(cut.select(columns).mapInArrow(run, RESULT))
