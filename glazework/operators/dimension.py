"""R-06 / R-07 / R-09: dimension build and surrogate-key lookup joins."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glazework.functions.keys import surrogate_key, surrogate_text
from glazework.operators.dedupe import repeated_sieve, with_mark
from glazework.session import DEFAULT_BROADCAST_MAX_BYTES, broadcast_if_small


@dataclass(frozen=True)
class DimensionSpec:
    name: str
    key: str                 # surrogate key column
    key_columns: list[str]   # hashed into the key, in this order
    attributes: list[str]    # distinct attribute tuple (the dimension's rows)
    not_null: list[str]      # rows missing any of these are left out
    fact_on: list[tuple[str, str]]  # (fact column, dimension column) join pairs


def _all(conds: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conds)


def build_dimension(staging: DataFrame, spec: DimensionSpec) -> DataFrame:
    """One row per distinct attribute tuple (NULLs group together), keyed by md5.

    The key is computed after the distinct, once per dimension row. Rows that
    differ in an attribute outside ``key_columns`` keep separate rows with the
    same key, exactly as modelled.
    """
    rows = staging.where(_all([F.col(c).isNotNull() for c in spec.not_null])).select(*spec.attributes).distinct()
    return rows.select(surrogate_key(*spec.key_columns).alias(spec.key), *spec.attributes)


def key_collisions(dim: DataFrame, spec: DimensionSpec) -> DataFrame:
    """E-21: (dimension, surrogate_key, n_rows, n_key_tuples, n_key_texts) of keys that several rows share.

    ``n_key_tuples`` above 1 is a collision: different values in the key columns hash to one key. The join with a
    separator makes ``('a-b', 'c')`` and ``('a', 'b-c')`` one text, and NULL equals the text that stands for it;
    ``n_key_texts`` tells such tuples (1) from a true md5 collision (2 or more). With ``n_key_tuples`` 1 the rows differ only in
    attributes outside the key, as modelled. A hash aggregate of narrow rows: per tuple, then per key.
    """
    text = surrogate_text(*spec.key_columns)
    tuples = dim.groupBy(spec.key, *spec.key_columns).agg(F.count(F.lit(1)).alias("n"))
    return (
        tuples.groupBy(F.col(spec.key).alias("surrogate_key"))
        .agg(
            F.sum("n").alias("n_rows"),
            F.count(F.lit(1)).alias("n_key_tuples"),
            F.count_distinct(text).alias("n_key_texts"),
        )
        .where(F.col("n_rows") > 1)
        .select(F.lit(spec.name).alias("dimension"), "surrogate_key", "n_rows", "n_key_tuples", "n_key_texts")
    )


def lookup_key(
    fact: DataFrame, dim: DataFrame, on: list[tuple[str, str]], key: str,
    broadcast: bool | None = None, max_bytes: int = DEFAULT_BROADCAST_MAX_BYTES,
) -> DataFrame:
    """Left join ``dim`` on plain equality (a NULL never matches) and add ``key``.

    Only the join columns and the key leave the dimension. It is broadcast
    when ``broadcast`` is true, or, when that is None, when its size
    is within ``max_bytes``; otherwise both sides shuffle on the join columns
    (AQE splits a skewed fact partition). Several dimension rows for one fact
    row multiply it, as a SQL left join does.
    """
    right = dim.select(*[F.col(d).alias(f"_{key}_{d}") for _, d in on], F.col(key))
    if broadcast is None:
        right = broadcast_if_small(right, max_bytes)
    elif broadcast:
        right = F.broadcast(right)
    cond = _all([fact[f] == right[f"_{key}_{d}"] for f, d in on])
    # The helper columns are pruned by the caller's final projection.
    return fact.join(right, cond, "left")


def lookup_key_in_place(fact: DataFrame, dim: DataFrame, spec: DimensionSpec) -> DataFrame:
    """As :func:`lookup_key`, for a large dimension built from these very rows: most keys need no join.

    A row that belongs to the dimension and whose join key stands in one dimension row only can but meet
    the row made from itself, so its key is hashed from its own columns; a row with a NULL in its join key meets nothing.
    Both are settled in the scan stage. What is left is shuffled and joined: rows that the dimension leaves out, and
    keys of several dimension rows, which a bounded sieve tells (see ``repeated_sieve``; it may name too many keys, never too few).
    A hot key of one dimension row is thus never shuffled; one of several is split by AQE.
    """
    left, right = [f for f, _ in spec.fact_on], [d for _, d in spec.fact_on]
    has_key = _all([F.col(c).isNotNull() for c in left])
    several = repeated_sieve(dim.where(_all([F.col(c).isNotNull() for c in right])), right)
    mark = f"_several_{spec.key}"
    marked = with_mark(fact, several, left, mark)
    own = has_key & _all([F.col(c).isNotNull() for c in spec.not_null]) & ~F.col(mark)
    columns = fact.columns
    key = F.when(has_key, surrogate_key(*spec.key_columns)).alias(spec.key)
    settled = marked.where(~has_key | own).select(*columns, key)
    joined = lookup_key(marked.where(has_key & ~own).select(*columns), dim, spec.fact_on, spec.key, broadcast=False)
    return settled.union(joined.select(*columns, spec.key))
