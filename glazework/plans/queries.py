"""Named queries, one per operator of the inventory.

Each query is first a function of the raw repairs table (``RAW_QUERIES``:
DataFrame → DataFrame), so it runs on any stored raw table. Per-expression queries project the raw rows (one scan, no shuffle); the
relational ones run the real staging / mart jobs.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glazework import constants as K
from glazework.functions.keys import surrogate_key
from glazework.operators.date_spine import dim_date
from glazework.operators.dedupe import (
    cleaned_duplicate_report,
    dedupe_cleaned,
    id_sieve,
    repeated_ids,
    repeated_sieve,
)
from glazework.operators.dimension import build_dimension, key_collisions
from glazework.operators.lookup import map_codes, mapped_name, region_lookup, with_region_lookup
from glazework.operators.quality import (
    boolean_violations,
    not_null_violations,
    quality_summary,
    unmapped_violations,
)
from glazework.plans.build import build_warehouse, quality_report
from glazework.plans.marts import DIMENSIONS, forecast_fact
from glazework.plans.staging import KEPT_COLUMNS, at_once, build_staging, clean_columns, cleaned_columns, row_cleaner
from glazework.session import materialize
from glazework.sources.seeds import load_seeds

RawQuery = Callable[[DataFrame], DataFrame]


def _staging(raw: DataFrame, seeds: dict[str, DataFrame] | None = None) -> DataFrame:
    return build_staging(raw, seeds or load_seeds(raw.sparkSession))


def _project(*names: str, raw_id: bool = True) -> RawQuery:
    """A per-expression query: the raw job_id plus the named cleaned columns."""

    def run(raw: DataFrame) -> DataFrame:
        exprs = cleaned_columns(raw)
        head = ["job_id"] if raw_id else []
        return raw.select(*head, *[exprs[n].alias(n) for n in names])

    run.__name__ = "project_" + "_".join(names)
    return run


def region_backfill(raw: DataFrame) -> DataFrame:
    lookup = materialize(region_lookup(raw), "region_lookup")
    joined = with_region_lookup(raw, lookup)
    exprs = cleaned_columns(joined, F.col("_lookup_region"))
    return joined.select("job_id", exprs["region"].alias("region"))


def _map_query(column: str) -> RawQuery:
    def run(raw: DataFrame) -> DataFrame:
        mapped = map_codes(raw, load_seeds(raw.sparkSession), [column])
        return mapped.select("job_id", F.col(mapped_name(column)).alias(column))

    run.__name__ = f"map_{column}"
    return run


def dedupe_repairs(raw: DataFrame) -> DataFrame:
    return cleaned_duplicate_report(raw, row_cleaner(raw, load_seeds(raw.sparkSession)), KEPT_COLUMNS)


def dq_unique_job(raw: DataFrame) -> DataFrame:
    """Q-02 on the staging rows, from ids and fingerprints alone."""
    return repeated_ids(raw, row_cleaner(raw, load_seeds(raw.sparkSession)), "job_id")


def _dim_query(name: str) -> RawQuery:
    def run(raw: DataFrame) -> DataFrame:
        spec = DIMENSIONS[name]
        return build_dimension(clean_columns(raw, load_seeds(raw.sparkSession), spec.attributes), spec)

    run.__name__ = name
    return run


def repair_dates(raw: DataFrame) -> DataFrame:
    """R-08 / R-09 (date): every staging row with its calendar attributes."""
    stg = _staging(raw).select("job_id", "repair_date")
    cal = F.broadcast(dim_date(raw.sparkSession))  # fixed 4,017 rows
    joined = stg.join(cal, stg["repair_date"] == cal["full_date"], "left")
    return joined.select("job_id", *cal.columns)


def fact_repairs(raw: DataFrame) -> DataFrame:
    return build_warehouse(raw).fact


def surrogate_keys(raw: DataFrame) -> DataFrame:
    """E-21: every dimension's key computed on each staging row."""
    stg = _staging(raw)
    keys = [surrogate_key(*spec.key_columns).alias(spec.key) for spec in DIMENSIONS.values()]
    return stg.select("job_id", *keys)


def dq_summary(
    raw: DataFrame, seeds: dict[str, DataFrame] | None = None, severities: dict[str, str] | None = None
) -> DataFrame:
    """J-04 without a built staging table: nothing is written.

    The row-level tests are counted where the rows are cleaned (only their fourteen columns are), and the unique test
    takes ids and fingerprints.
    """
    clean, copies, ids = at_once(
        lambda: row_cleaner(raw, seeds or load_seeds(raw.sparkSession)),
        lambda: repeated_sieve(raw, KEPT_COLUMNS),
        lambda: id_sieve(raw, "job_id"),
    )
    staging = dedupe_cleaned(raw, clean, KEPT_COLUMNS, sieve=copies)
    return quality_summary(staging, repeated=repeated_ids(raw, clean, "job_id", sieve=ids), severities=severities)


def dq_summary_build(raw: DataFrame) -> DataFrame:
    """J-04 after a build: the row-level tests were counted while staging was written."""
    return quality_report(build_warehouse(raw))


def fact_fanout_forecast(raw: DataFrame) -> DataFrame:
    wh = build_warehouse(raw)
    return forecast_fact(wh.staging, wh.dims)


def key_collision_report(raw: DataFrame) -> DataFrame:
    """E-21: keys that several rows of a dimension share, over the six dimensions."""
    dims = build_warehouse(raw).dims
    return reduce(DataFrame.unionByName, [key_collisions(dims[n], spec) for n, spec in DIMENSIONS.items()])


def raw_queries() -> dict[str, RawQuery]:
    """Every query that reads only the raw table, by name."""
    q: dict[str, RawQuery] = {
        "raw_repairs": lambda raw: raw,
        "region_lookup": region_lookup,
        "region_backfill": region_backfill,
    }
    for column in K.MAPPED_COLUMNS:
        q[f"map_{column}"] = _map_query(column)
    q["dedupe_repairs"] = dedupe_repairs
    q["stg_repairs"] = _staging
    for name in DIMENSIONS:
        q[name] = _dim_query(name)
    q["repair_dates"] = repair_dates
    q["fact_repairs"] = fact_repairs
    q["prefixed_ids"] = _project("job_id", "technician_id", "customer_id", raw_id=False)
    q["clean_city"] = _project("city")
    q["clean_vehicle"] = _project("vehicle_brand", "vehicle_model")
    q["clean_postcode"] = _project("customer_postcode")
    q["clean_email"] = _project("customer_email")
    q["clean_mobile"] = _project("customer_mobile", "technician_mobile")
    q["parse_names"] = _project(
        "customer_prefix", "customer_first_name", "customer_surname",
        "technician_prefix", "technician_first_name", "technician_surname",
    )
    q["parse_dates"] = _project("repair_date")
    q["clean_costs"] = _project("repair_cost", "glass_cost", "profit")
    q["clean_rating"] = _project("customer_rating")
    q["clean_insurance"] = _project("insurance_claimed")
    q["surrogate_keys"] = surrogate_keys
    q["dq_not_null"] = lambda raw: not_null_violations(_staging(raw))
    q["dq_unique_job"] = dq_unique_job
    q["dq_unmapped"] = lambda raw: unmapped_violations(_staging(raw))
    q["dq_valid_boolean"] = boolean_violations
    q["dq_summary"] = dq_summary
    q["dq_summary_build"] = dq_summary_build
    return q
