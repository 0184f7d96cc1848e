"""Consistent-hash ring with virtual nodes and bounded loads (operator 4). DataFrame functions only.

A row's key is hashed to one of ``POINTS`` points of the ring; every shard has
``VNODES`` virtual nodes on hashed points, and a key belongs to the first
virtual node clockwise. Loads are bounded: a shard takes rows up to its capacity,
and what finds it full continues clockwise to the next virtual node of a shard
with room. With the capacities floor and ceil of rows / shards, which add up to the
number of rows, every shard ends up full: the counts are at most one apart. A
change of the shard count moves the keys of the changed arcs and the overflow only.

Defined results: a null text has size 1 (no bytes, plus 1) and the checksum of
the empty string; a null key lies on one fixed point; repeated rows are rows like any
other, so the rows of a key with a third of all rows overflow clockwise; an
empty table gives no rows. Extra columns of the input are left out of the result
unless named in ``keep``.

Scale: the texts are read once, for size and checksum. What follows works on
narrow rows. Ranks inside a point come from windows over (point, piece), where the
piece spreads the rows of a hot key over ``PIECES`` windows; no window holds a
shard. Only the ``POINTS`` row counts reach the driver, a fixed number, and the
plan made from them (a few intervals per point) is broadcast.
"""

from __future__ import annotations

import hashlib
import json
from bisect import bisect_left

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import stored

POINT_BITS = 12
POINTS = 1 << POINT_BITS
VNODES = 128
PIECES = 64


def ring(shards: int, vnodes: int = VNODES) -> list[tuple[int, int]]:
    """The virtual nodes as (point, shard), in clockwise order."""
    nodes = []
    for shard in range(shards):
        for replica in range(vnodes):
            h = int.from_bytes(hashlib.blake2b(f"{shard}:{replica}".encode(), digest_size=8).digest(), "big")
            nodes.append((h, shard))
    return [(h >> (64 - POINT_BITS), shard) for h, shard in sorted(nodes)]


def capacities(rows: int, shards: int) -> list[int]:
    """Floor or ceil of rows / shards; they add up to ``rows``."""
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def plan_loads(counts: dict[int, int], shards: int, vnodes: int = VNODES) -> list[tuple[int, int, int, int, int]]:
    """(point, first rank, rank past the last, shard, first slot) for the rows at each point.

    In rounds: all waiting intervals, in ring order, ask the shard of the
    virtual node they have reached; what it can't take moves on clockwise to the
    next virtual node whose shard has room. Every round fills a shard or places
    everything, so there are at most ``shards`` + 1 rounds over ``POINTS`` counts.
    """
    nodes = ring(shards, vnodes)
    at_points = [p for p, _ in nodes]
    room = capacities(sum(counts.values()), shards)
    taken = [0] * shards
    waiting = [(p, 0, n, bisect_left(at_points, p) % len(nodes)) for p, n in sorted(counts.items()) if n]
    plan = []
    while waiting:
        left = []
        for point, lo, hi, k in waiting:
            shard = nodes[k][1]
            n = min(hi - lo, room[shard] - taken[shard])
            if n:
                plan.append((point, lo, lo + n, shard, taken[shard]))
                taken[shard] += n
            if lo + n < hi:
                left.append((point, lo + n, hi, k))
        waiting = []
        for point, lo, hi, k in left:
            while taken[nodes[k][1]] >= room[nodes[k][1]]:
                k = (k + 1) % len(nodes)
            waiting.append((point, lo, hi, k))
    return plan


def assign_shards(
    docs: DataFrame, shards: int = 16, key_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """(carried columns, size, text_crc32, shard, slot) for every row.

    ``keep``: input columns to carry; the key alone by default. The law is
    ``rows``: counts at most one apart; slots are gapless from 0 in each shard.
    """
    spark = docs.sparkSession
    carry = list(keep) if keep is not None else [key_col]
    text = F.coalesce(F.col(text_col), F.lit(""))
    slim = stored(
        docs.select(
            *carry,
            F.shiftrightunsigned(F.xxhash64(key_col), 64 - POINT_BITS).alias("_point"),
            (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.monotonically_increasing_id().alias("_rid"),
        ).withColumn("_piece", F.pmod(F.xxhash64("_rid"), F.lit(PIECES))),
        "shard-rows",
    )
    cells = stored(slim.groupBy("_point", "_piece").agg(F.count(F.lit(1)).alias("_n")), "shard-cells")
    before = W.partitionBy("_point").orderBy("_piece").rowsBetween(W.unboundedPreceding, -1)
    offsets = cells.select(
        "_point", "_piece", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    counts = {r["_point"]: r["n"] for r in cells.groupBy("_point").agg(F.sum("_n").alias("n")).collect()}
    plan = [dict(zip(("p", "lo", "hi", "shard", "slot"), row)) for row in plan_loads(counts, shards)]
    schema = "array<struct<p:bigint,lo:bigint,hi:bigint,shard:int,slot:bigint>>"
    intervals = spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(plan)), schema)))
    ranked = slim.withColumn(
        "_rn", F.row_number().over(W.partitionBy("_point", "_piece").orderBy("_rid")).cast("long") - 1
    ).join(offsets, ["_point", "_piece"])
    rank = F.col("_before") + F.col("_rn")
    # the plan has at most POINTS + shards * POINTS rows, whatever the input
    placed = ranked.withColumn("_rank", rank).join(
        F.broadcast(intervals),
        (F.col("_point") == F.col("p")) & (F.col("_rank") >= F.col("lo")) & (F.col("_rank") < F.col("hi")),
    )
    return placed.select(
        *carry, "size", "text_crc32", "shard", (F.col("slot") + F.col("_rank") - F.col("lo")).alias("slot")
    )
