"""R-01 … R-03: the region lookup, the region back-fill join and the code mappings."""

from __future__ import annotations

from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from glazework import constants as K
from glazework.functions.text import trim_ws
from glazework.session import DEFAULT_BROADCAST_MAX_BYTES, broadcast_if_small

#: Most rows of a seed that becomes a literal in the plan (its look-up goes through them one by one).
MAX_FUSED_ROWS = 64
#: Seeds that were read for a literal: (most rows asked for, the rows).
_READ: WeakKeyDictionary[DataFrame, tuple[int, list[Row]]] = WeakKeyDictionary()


def region_lookup(raw: DataFrame) -> DataFrame:
    """R-01: one region per ``lower(trim(city))``, from rows where both are usable.

    ``min`` stands in for "any value" so the result is deterministic; a city
    only ever sits in one region, up to case, which title-casing removes.
    Rows are merged by hash first, map-side, as they are spelled (a minimum of strings alone would
    sort every row), so a city holding a third of all rows still ships one
    row per task and spelling; only spellings are trimmed and tested.
    """
    city, region = trim_ws(F.col("city")), trim_ws(F.col("region"))
    usable = (
        region.isNotNull() & (region != K.NA_TOKEN) & (region != "")
        & city.isNotNull() & (city != K.NA_TOKEN) & (city != "")
    )
    # tested beside the count, so that the tests stay above the hash aggregate: once a spelling, not once a row
    spellings = raw.groupBy("city", "region").agg(F.count(F.lit(1)).alias("_rows"))
    named = F.when(usable & (F.col("_rows") > 0), region)
    by_city = spellings.select(F.lower(city).alias("city"), named.alias("region")).groupBy("city")
    return by_city.agg(F.min("region").alias("region")).where(F.col("region").isNotNull())


def with_region_lookup(
    raw: DataFrame, lookup: DataFrame, max_bytes: int = DEFAULT_BROADCAST_MAX_BYTES
) -> DataFrame:
    """R-02: left join the lookup on ``lower(trim(city))``; adds ``_lookup_region``
    (and the helper ``_lookup_city``, pruned by the staging projection).

    ``lookup`` should be materialised, so that its size is known: it is broadcast when
    it is within ``max_bytes``; a larger one is joined by shuffle (AQE splits
    skewed city partitions).
    """
    right = lookup.select(F.col("city").alias("_lookup_city"), F.col("region").alias("_lookup_region"))
    right = broadcast_if_small(right, max_bytes)
    return raw.join(right, F.lower(trim_ws(raw["city"])) == right["_lookup_city"], "left")


def mapped_name(column: str) -> str:
    return f"_mapped_{column}"


def code_map(seed: DataFrame, max_rows: int = MAX_FUSED_ROWS) -> dict[str, str | None] | None:
    """{key: clean value} of a seed that has at most ``max_rows`` rows and no key twice; else None.

    NULL keys, which match nothing, are left out. The rows of a DataFrame are read once.
    """
    rows = _READ.get(seed)
    if rows is None or len(rows[1]) > rows[0] != max_rows:
        rows = _READ[seed] = (max_rows, _keyed(seed).limit(max_rows + 1).collect())  # bounded
    if len(rows[1]) > max_rows:
        return None
    found = {r["key"]: r["value"] for r in rows[1] if r["key"] is not None}
    return found if len(found) == sum(r["key"] is not None for r in rows[1]) else None


def _keyed(seed: DataFrame) -> DataFrame:
    return seed.select(F.upper(trim_ws(F.col("raw_value"))).alias("key"), F.col("clean_value").alias("value"))


def _from_map(codes: dict[str, str | None], key: Column) -> Column:
    if not codes:
        return F.lit(None).cast("string")
    literal = F.create_map(*[F.lit(x).cast("string") for pair in codes.items() for x in pair])
    return F.try_element_at(literal, key)


def map_codes(
    df: DataFrame, seeds: dict[str, DataFrame], columns: list[str] | None = None,
    max_bytes: int = DEFAULT_BROADCAST_MAX_BYTES, max_fused_rows: int = MAX_FUSED_ROWS, distinct: bool = False,
) -> DataFrame:
    """R-03: for each column, its seed's value for ``UPPER(TRIM(..))`` as ``_mapped_<column>`` (NULL when unmatched).

    A seed without repeated keys and of at most ``max_fused_rows`` rows becomes a literal map, and all such
    columns are looked up in one projection, without a join. Any other is joined on the key
    (helper column ``_seed_key_<column>``, pruned by the next projection): broadcast when it is within
    ``max_bytes``, by shuffle beyond. Several seed rows with one key give a row each; with ``distinct``, equal ones
    give one, so that no two rows made from one are equal.
    """
    fused = {}
    for column in K.MAPPED_COLUMNS if columns is None else columns:
        codes = code_map(seeds[column], max_fused_rows)
        if codes is not None:
            fused[mapped_name(column)] = _from_map(codes, F.upper(trim_ws(F.col(column))))
            continue
        key = f"_seed_key_{column}"
        seed = _keyed(seeds[column]).select(F.col("key").alias(key), F.col("value").alias(mapped_name(column)))
        right = broadcast_if_small(seed.distinct() if distinct else seed, max_bytes)
        df = df.join(right, F.upper(trim_ws(df[column])) == right[key], "left")
    return df.withColumns(fused) if fused else df
