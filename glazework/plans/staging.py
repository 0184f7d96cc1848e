"""J-01 / R-05: raw repairs → cleaned, mapped, de-duplicated staging table (34 columns)."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glazework import constants as K
from glazework.functions import (
    clean_boolean,
    clean_city,
    clean_currency,
    clean_email,
    clean_postcode,
    clean_rating,
    clean_region,
    clean_vehicle_brand,
    clean_vehicle_model,
    money_difference,
    parse_full_name,
    parse_repair_date,
    prefixed_id,
    trim_ws,
    uk_mobile,
)
from glazework.operators.dedupe import Clean, dedupe_cleaned, repeated_sieve
from glazework.operators.lookup import map_codes, mapped_name, region_lookup, with_region_lookup
from glazework.session import DEFAULT_BROADCAST_MAX_BYTES, materialize, tune_for_wide_rows

STAGING_COLUMNS = [
    "job_id", "repair_date", "region", "city", "garage_name", "garage_type",
    "vehicle_brand", "vehicle_type", "vehicle_model", "glass_type", "window_position",
    "damage_type", "repair_type", "repair_cost", "glass_cost", "profit", "customer_rating",
    "customer_prefix", "customer_first_name", "customer_surname", "customer_email",
    "customer_mobile", "customer_postcode", "insurance_claimed", "technician_id",
    "technician_prefix", "technician_first_name", "technician_surname", "technician_mobile",
    "customer_id", "vehicle_age_in_years", "weather_condition", "traffic_level",
    "job_duration_in_hours",
]


def cleaned_columns(src: DataFrame, looked_up_region: Column | None = None) -> dict[str, Column]:
    """Every staging column as an expression over a (joined) raw row.

    Mapped columns read ``_mapped_<column>`` when the mapping joins are
    present; the region reads ``looked_up_region`` (NULL when absent).
    """
    tune_for_wide_rows(src.sparkSession)
    c = F.col
    lookup = looked_up_region if looked_up_region is not None else F.lit(None).cast("string")
    repair_cost, glass_cost = clean_currency(c("repair_cost")), clean_currency(c("glass_cost"))
    customer, technician = parse_full_name(c("customer_name")), parse_full_name(c("technician_name"))
    out = {
        "job_id": prefixed_id(K.JOB_ID_PREFIX, c("job_id")),
        "repair_date": parse_repair_date(c("repair_date")),
        "region": clean_region(c("region"), lookup),
        "city": clean_city(c("city")),
        "garage_name": trim_ws(c("garage_name")),
        "vehicle_brand": clean_vehicle_brand(c("vehicle_brand")),
        "vehicle_model": clean_vehicle_model(c("vehicle_model")),
        "repair_cost": repair_cost,
        "glass_cost": glass_cost,
        "profit": money_difference(repair_cost, glass_cost),
        "customer_rating": clean_rating(c("customer_rating")),
        "customer_prefix": customer["prefix"],
        "customer_first_name": customer["first_name"],
        "customer_surname": customer["surname"],
        "customer_email": clean_email(c("customer_email")),
        "customer_mobile": uk_mobile(c("customer_mobile")),
        "customer_postcode": clean_postcode(c("customer_postcode")),
        "insurance_claimed": clean_boolean(c("insurance_claimed")),
        "technician_id": prefixed_id(K.TECHNICIAN_ID_PREFIX, c("technician_id")),
        "technician_prefix": technician["prefix"],
        "technician_first_name": technician["first_name"],
        "technician_surname": technician["surname"],
        "technician_mobile": uk_mobile(c("technician_mobile")),
        "customer_id": prefixed_id(K.CUSTOMER_ID_PREFIX, c("customer_id")),
        "vehicle_age_in_years": c("vehicle_age_in_years"),
        "job_duration_in_hours": c("job_duration_in_hours"),
    }
    for column in K.MAPPED_COLUMNS:
        name = mapped_name(column)
        out[column] = c(name) if name in src.columns else F.lit(None).cast("string")
    return out


def clean_rows(joined: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The 34-column projection of a raw row joined to the lookup and the seeds, and the columns ``keep``."""
    region = F.col("_lookup_region") if "_lookup_region" in joined.columns else None
    exprs = cleaned_columns(joined, region)
    return joined.select(*[exprs[name].alias(name) for name in STAGING_COLUMNS], *(keep or []))


#: Raw columns that staging keeps as they are (ids with a prefix): rows that differ in one stay different.
KEPT_COLUMNS = ["job_id", "technician_id", "customer_id", "vehicle_age_in_years", "job_duration_in_hours"]


def at_once(*jobs: Callable[[], Any]) -> list[Any]:
    """Results of independent small jobs that are submitted side by side and share the executors."""
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        return [started.result() for started in [pool.submit(job) for job in jobs]]


def row_cleaner(
    raw: DataFrame,
    seeds: dict[str, DataFrame],
    lookup: DataFrame | None = None,
    max_broadcast_bytes: int = DEFAULT_BROADCAST_MAX_BYTES,
) -> Clean:
    """R-01 … R-03, R-05 as a function of raw rows: the look-up made from all of ``raw``, the mappings, the projection.

    The region lookup is a small aggregate of the raw table; it is written out first so its
    size is known before choosing how to join it. No two rows made from one raw row are equal.
    """
    regions = lookup if lookup is not None else materialize(region_lookup(raw), "region_lookup")

    def clean(rows: DataFrame, keep: list[str]) -> DataFrame:
        joined = with_region_lookup(rows, regions, max_broadcast_bytes)
        return clean_rows(map_codes(joined, seeds, max_bytes=max_broadcast_bytes, distinct=True), keep)

    return clean


def build_staging(
    raw: DataFrame,
    seeds: dict[str, DataFrame],
    lookup: DataFrame | None = None,
    max_broadcast_bytes: int = DEFAULT_BROADCAST_MAX_BYTES,
) -> DataFrame:
    """R-01 … R-05: lookup → back-fill join → 8 mappings → clean → DISTINCT of what may be repeated.

    A narrow pass over ``KEPT_COLUMNS`` finds which rows may have a copy; only these (about as many as there are
    copies) are shuffled, for an exact DISTINCT. All others go from the scan to the result in one stage.
    """
    clean, sieve = at_once(
        lambda: row_cleaner(raw, seeds, lookup, max_broadcast_bytes), lambda: repeated_sieve(raw, KEPT_COLUMNS)
    )
    return dedupe_cleaned(raw, clean, KEPT_COLUMNS, sieve=sieve)


def clean_columns(raw: DataFrame, seeds: dict[str, DataFrame], columns: list[str]) -> DataFrame:
    """Some staging columns of every raw row, with only the joins that these need.

    Not de-duplicated: for callers that take distinct values of the columns (a
    dimension), which no join or DISTINCT over other columns can change.
    """
    src = raw
    if "region" in columns:
        src = with_region_lookup(raw, materialize(region_lookup(raw), "region_lookup"))
    src = map_codes(src, seeds, [c for c in K.MAPPED_COLUMNS if c in columns])
    exprs = cleaned_columns(src, F.col("_lookup_region") if "region" in columns else None)
    return src.select(*[exprs[c].alias(c) for c in columns])
