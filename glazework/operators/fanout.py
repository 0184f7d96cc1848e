"""R-09: how many rows the fact's look-up joins will give, before they run."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glazework.session import DEFAULT_BROADCAST_MAX_BYTES, broadcast_if_small, materialize

#: What a key's parts are joined with in the report.
KEY_SEPARATOR = "|"

Lookup = tuple[str, DataFrame, list[tuple[str, str]]]


def repeated_lookup_keys(dim: DataFrame, columns: list[str]) -> DataFrame:
    """(columns, dim_rows) of keys that several dimension rows share; a NULL in a key never matches, so it is left out."""
    usable = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    counts = dim.where(usable).groupBy(*columns).agg(F.count(F.lit(1)).alias("dim_rows"))
    return counts.where(F.col("dim_rows") > 1)


def fanout_forecast(
    fact: DataFrame, lookups: list[Lookup], max_bytes: int = DEFAULT_BROADCAST_MAX_BYTES
) -> DataFrame:
    """(lookup, key, fact_rows, dim_rows, joined_rows): keys that multiply fact rows, and the exact total.

    ``lookups``: (name, dimension, pairs of fact and dimension columns) of left joins. A row of the result for
    each key that both has several dimension rows and occurs in the fact, and one (lookup ``total``, key and dim_rows NULL) with the
    number of rows before and after all joins. A fact row counts as often as the product of its keys' dimension rows.

    Only keys that several rows share are joined, with the fact's key columns; those tables are written and
    joined by their size. Keys of the fact are counted by hash aggregate, so a hot one merges before
    the shuffle. Sort by ``joined_rows`` for the heaviest.
    """
    counted, factor, per_key = fact, F.lit(1).cast("bigint"), []
    for number, (name, dim, on) in enumerate(lookups):
        keys = materialize(repeated_lookup_keys(dim, [d for _, d in on]), f"repeated-{name}")
        if keys.isEmpty():
            continue  # a dimension row at most for each fact row
        rows = f"_rows_{number}"
        right = keys.select(*[F.col(d).alias(f"_{number}_{d}") for _, d in on], F.col("dim_rows").alias(rows))
        right = broadcast_if_small(right, max_bytes)
        cond = reduce(lambda a, b: a & b, [counted[f] == right[f"_{number}_{d}"] for f, d in on])
        counted = counted.join(right, cond, "left")
        factor = factor * F.coalesce(F.col(rows), F.lit(1).cast("bigint"))
        text = F.concat_ws(KEY_SEPARATOR, *[F.col(f"_{number}_{d}").cast("string") for _, d in on])
        per_key.append((name, text, rows))
    total = counted.agg(F.count(F.lit(1)).alias("fact_rows"), F.sum(factor).alias("joined_rows")).select(
        F.lit("total").alias("lookup"), F.lit(None).cast("string").alias("key"), "fact_rows",
        F.lit(None).cast("bigint").alias("dim_rows"), F.coalesce("joined_rows", F.lit(0).cast("bigint")).alias("joined_rows"),
    )
    parts = [total]
    for name, text, rows in per_key:
        met = counted.where(F.col(rows).isNotNull()).groupBy(text.alias("key"), F.col(rows).alias("dim_rows"))
        parts.append(
            met.agg(F.count(F.lit(1)).alias("fact_rows")).select(
                F.lit(name).alias("lookup"), "key", "fact_rows", "dim_rows",
                (F.col("fact_rows") * F.col("dim_rows")).alias("joined_rows"),
            )
        )
    return reduce(DataFrame.unionByName, parts)
