"""Cost-balanced packing of documents into token sequences (operator 2).

A piece of n tokens costs ``LINEAR * n + QUADRATIC * n * n``: attention inside a
sequence is kept to the piece, so a sequence costs the sum of its pieces. Documents
are taken in descending length; each goes to the sequence of lowest cost that has
room for all of it. What fits nowhere whole is cut over the sequences
of lowest cost with room. A document over the sequence length gives whole
sequences first and is packed by its rest.

Padding: a sequence is padded to ``SEQ_LEN``, except at a power of two. The capacities
of a block of T tokens are T // SEQ_LEN whole sequences and one sequence for each
binary digit of the rest. They add up to T, every sequence ends full, and there
is no padding at all.

Defined results: a null or empty text is the end id alone; a repeated row is a document of
its own; an empty table gives no rows. Input columns other than id and text are
left out unless asked for.

Scale: no shuffle. Each task encodes its documents in turn and packs blocks of up
to ``BLOCK_TOKENS`` tokens, so memory is bounded by a block and its longest text. Sequence ids
hold the partition's number, and a rerun of a lost task gives the same rows.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .word_bpe import encoder

SEQ_LEN = 2048
END_ID = 1
#: Cost per token and per squared token of a piece (a hidden size of 1024 balances the two at 2 * 1024).
LINEAR = 1.0
QUADRATIC = 1.0 / 2048
#: Tokens packed together: 512 sequences.
BLOCK_TOKENS = 512 * SEQ_LEN
RESULT = "start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"


def cost(n: int) -> float:
    return LINEAR * n + QUADRATIC * n * n


def capacities(tokens: int) -> list[int]:
    """Sequence lengths that add up to ``tokens``: whole ones, then powers of two."""
    rest = tokens % SEQ_LEN
    return [SEQ_LEN] * (tokens // SEQ_LEN) + [1 << b for b in range(rest.bit_length()) if rest >> b & 1][::-1]


def pack_block(lengths: list[int]) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of every piece of a block."""
    room = capacities(sum(lengths))
    used, costs = [0] * len(room), [0.0] * len(room)
    pieces: list[tuple[int, int, int, int, int]] = []

    def put(doc: int, start: int, n: int, seq: int) -> None:
        pieces.append((doc, start, n, seq, used[seq]))
        used[seq] += n
        room[seq] -= n
        costs[seq] += cost(n)

    whole = 0
    rests = []
    for doc, n in enumerate(lengths):
        for k in range(n // SEQ_LEN):
            put(doc, k * SEQ_LEN, SEQ_LEN, whole)
            whole += 1
        if n % SEQ_LEN:
            rests.append((n % SEQ_LEN, doc))
    # the lowest-cost sequence with enough room: a heap by cost; those too full are set aside
    # for the documents that are shorter, and come back when the length has fallen to their room
    rests.sort(key=lambda x: (-x[0], x[1]))
    ready = [(0.0, s) for s in range(whole, len(room))]
    heapq.heapify(ready)
    tight: list[tuple[int, float, int]] = []  # by room, the largest first
    over = []
    for n, doc in rests:
        while tight and -tight[0][0] >= n:
            _, c, s = heapq.heappop(tight)
            heapq.heappush(ready, (c, s))
        while ready and room[ready[0][1]] < n:
            c, s = heapq.heappop(ready)
            if room[s]:
                heapq.heappush(tight, (-room[s], c, s))
        if not ready:
            over.append((n, doc))
            continue
        _, s = heapq.heappop(ready)
        put(doc, lengths[doc] - n, n, s)
        heapq.heappush(ready, (costs[s], s))
    left = [(costs[s], s) for s in range(whole, len(room)) if room[s]]
    heapq.heapify(left)
    for n, doc in over:
        start = lengths[doc] - n
        while n:
            _, s = heapq.heappop(left)
            part = min(n, room[s])
            put(doc, start, part, s)
            start, n = start + part, n - part
            if room[s]:
                heapq.heappush(left, (costs[s], s))
    return pieces


def _pack_batches(path: str, carried: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).ids
        partition = TaskContext.get().partitionId()
        next_seq = partition << 40
        keys: list[list] = []
        docs: list[np.ndarray] = []
        tokens = 0
        fields: list[pa.Field] = []

        def flush() -> pa.RecordBatch:
            nonlocal next_seq, tokens
            lengths = [len(d) for d in docs]
            pieces = sorted(pack_block(lengths))
            who = [p[0] for p in pieces]
            crc = [zlib.crc32(docs[d][s : s + n].astype("<u4").tobytes()) for d, s, n, _, _ in pieces]
            longs = [
                [p[1] for p in pieces], [p[2] for p in pieces], crc, [lengths[d] for d in who],
                [next_seq + p[3] for p in pieces], [p[4] for p in pieces],
            ]
            arrays = [pa.array([keys[d][i] for d in who], type=f.type) for i, f in enumerate(fields)]
            arrays += [pa.array(x, type=pa.int64()) for x in longs]
            next_seq += len(capacities(tokens))
            keys.clear()
            docs.clear()
            tokens = 0
            names = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            return pa.RecordBatch.from_arrays(arrays, names=[*(f.name for f in fields), *names])

        for batch in batches:
            fields = [batch.schema.field(i) for i in range(carried)]
            carry = [batch.column(i) for i in range(carried)]
            for row, text in enumerate(batch.column(carried)):
                ids = np.append(encode(text.as_py() or ""), np.uint32(END_ID))
                keys.append([c[row].as_py() for c in carry])
                docs.append(ids)
                tokens += len(ids)
                if tokens >= BLOCK_TOKENS:
                    yield flush()
        if docs:
            yield flush()

    return run


def pack_documents(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """One row per piece: id, carried columns, ``start``, ``length``, ``ids_crc32``,
    ``doc_tokens``, ``sequence_id``, ``offset``."""
    names = {c.split()[0] for c in RESULT.split(", ")}
    carry = [id_col, *[c for c in (keep or []) if c != id_col and c not in names]]
    plain = docs.select(*carry, F.col(text_col).alias("_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema.fields[:-1])
    return plain.mapInArrow(_pack_batches(tokenizer_path, len(carry)), f"{schema}, {RESULT}")
