"""S-03: the eight raw → clean mapping seeds.

Seeds are data, not code: the CSV files next to this module can be replaced,
or a folder on shared storage can be given instead. They are matched on
``UPPER(TRIM(raw_value))``. A seed may be of any length and may hold a key
several times: the mapping join then gives a row for each, and the DISTINCT of
staging merges equal ones. A NULL key never matches.
"""

from __future__ import annotations

import csv
from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glazework.constants import MAPPED_COLUMNS, TRIM_WHITESPACE

SEED_DIR = Path(__file__).with_name("seeds")
SEED_SCHEMA = T.StructType([T.StructField("raw_value", T.StringType()), T.StructField("clean_value", T.StringType())])


def seed_name(column: str) -> str:
    return f"{column}_mapping"


def seed_rows(column: str) -> list[tuple[str, str]]:
    """Rows of one packaged seed, read on the driver (a short file of this package)."""
    with open(SEED_DIR / f"{seed_name(column)}.csv", newline="", encoding="utf-8") as fh:
        return [(r["raw_value"], r["clean_value"]) for r in csv.DictReader(fh)]


def inline_seed(spark: SparkSession, rows: list[tuple[str | None, str | None]]) -> DataFrame:
    """A seed as an inline table (a local relation, whose size the planner knows without a job)."""
    values = ", ".join(f"(:r{i}, :c{i})" for i in range(len(rows)))
    args = {}
    for i, (raw, clean) in enumerate(rows):
        args[f"r{i}"], args[f"c{i}"] = raw, clean
    inline = spark.sql(f"SELECT * FROM VALUES {values} AS t(raw_value, clean_value)", args=args)
    return inline.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in SEED_SCHEMA.fields])


def read_seed(spark: SparkSession, path: str) -> DataFrame:
    """A seed file on shared storage; the header is checked, quotes are doubled as in RFC 4180."""
    return (
        spark.read.option("header", True)
        .option("enforceSchema", False)
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "FAILFAST")
        .schema(SEED_SCHEMA)
        .csv(path)
    )


_PACKAGED: dict[int, tuple[SparkSession, dict[str, DataFrame]]] = {}


def load_seeds(spark: SparkSession, seed_dir: str | None = None) -> dict[str, DataFrame]:
    """All eight seeds as DataFrames (raw_value, clean_value).

    Default: the packaged CSVs, as inline tables. With ``seed_dir`` (shared
    storage), each ``<column>_mapping.csv`` is read by Spark.
    """
    if seed_dir is not None:
        return {c: read_seed(spark, f"{seed_dir}/{seed_name(c)}.csv") for c in MAPPED_COLUMNS}
    cached = _PACKAGED.get(id(spark))
    if cached is None or cached[0] is not spark:
        # the packaged seeds never change: keep this session's inline tables
        cached = _PACKAGED[id(spark)] = (spark, {c: inline_seed(spark, seed_rows(c)) for c in MAPPED_COLUMNS})
    return dict(cached[1])


def repeated_keys(seeds: dict[str, DataFrame]) -> DataFrame:
    """(column_name, key, n_values, n_rows) of keys that a seed holds more than once: a report, not an error."""
    parts = [
        seed.select(
            F.lit(column).alias("column_name"),
            F.upper(F.trim(F.col("raw_value"), F.lit(TRIM_WHITESPACE))).alias("key"),
            "clean_value",
        )
        for column, seed in seeds.items()
    ]
    keyed = reduce(DataFrame.unionByName, parts).where(F.col("key").isNotNull())
    counted = keyed.groupBy("column_name", "key").agg(
        F.count_distinct("clean_value").alias("n_values"), F.count(F.lit(1)).alias("n_rows")
    )
    return counted.where(F.col("n_rows") > 1)
