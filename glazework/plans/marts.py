"""J-02 / J-03: the six attribute dimensions, the calendar and the fact table."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glazework.operators.dimension import DimensionSpec, build_dimension, lookup_key, lookup_key_in_place
from glazework.operators.fanout import fanout_forecast
from glazework.session import DEFAULT_BROADCAST_MAX_BYTES, materialize, planned_bytes


def _same(cols: list[str]) -> list[tuple[str, str]]:
    return [(c, c) for c in cols]


_GARAGE = ["garage_name", "city", "region", "garage_type"]
_CUSTOMER = [
    "customer_id", "customer_prefix", "customer_first_name", "customer_surname",
    "customer_email", "customer_mobile", "customer_postcode",
]
_TECHNICIAN = ["technician_id", "technician_prefix", "technician_first_name", "technician_surname", "technician_mobile"]
_VEHICLE = ["vehicle_brand", "vehicle_model", "vehicle_type", "vehicle_age_in_years"]
_REPAIR = ["damage_type", "repair_type", "glass_type", "window_position"]
_CONTEXT = ["insurance_claimed", "weather_condition", "traffic_level"]

DIMENSIONS: dict[str, DimensionSpec] = {
    "dim_garage": DimensionSpec(
        "dim_garage", "garage_key", _GARAGE, _GARAGE, ["garage_name", "city", "region"], _same(_GARAGE)
    ),
    "dim_customer": DimensionSpec(
        "dim_customer", "customer_key", _CUSTOMER, _CUSTOMER,
        ["customer_id", "customer_email", "customer_mobile", "customer_postcode"], _same(["customer_id"]),
    ),
    "dim_technician": DimensionSpec(
        "dim_technician", "technician_key", ["technician_id"], _TECHNICIAN, ["technician_id"], _same(["technician_id"])
    ),
    "dim_vehicle": DimensionSpec("dim_vehicle", "vehicle_key", _VEHICLE, _VEHICLE, _VEHICLE, _same(_VEHICLE)),
    "dim_repair_details": DimensionSpec(
        "dim_repair_details", "repair_details_key", _REPAIR, _REPAIR, _REPAIR, _same(_REPAIR)
    ),
    "dim_job_context": DimensionSpec(
        "dim_job_context", "job_context_key", _CONTEXT, _CONTEXT, _CONTEXT, _same(_CONTEXT)
    ),
}

FACT_COLUMNS = [
    "garage_key", "customer_key", "technician_key", "vehicle_key", "date_key",
    "repair_details_key", "job_context_key", "job_id",
    "repair_cost", "glass_cost", "profit", "job_duration_in_hours", "customer_rating",
]

# Fact join order (left joins, so order does not change the result).
_FACT_JOINS = ["dim_garage", "dim_customer", "dim_technician", "dim_vehicle", "dim_date", "dim_repair_details", "dim_job_context"]


def build_dimensions(
    staging: DataFrame, write: Callable[[str, Callable[[], DataFrame]], DataFrame] | None = None, parallel: int = 6
) -> dict[str, DataFrame]:
    """J-02: the six attribute dimensions, each written out (so its size is known).

    They are independent jobs over the same staging table, so they are
    submitted from a few driver threads at once and share the executors
    (the same way independent models are built side by side). ``write`` takes a name and what makes the
    table, and returns the written table; by default it goes to the work folder.
    """
    write = write or (lambda name, make: materialize(make(), name))

    def one(name: str) -> tuple[str, DataFrame]:
        return name, write(name, lambda: build_dimension(staging, DIMENSIONS[name]))

    with ThreadPoolExecutor(max_workers=parallel) as pool:
        return dict(pool.map(one, DIMENSIONS))


def fact_lookups() -> dict[str, tuple[list[tuple[str, str]], str]]:
    """For each dimension of the fact: (pairs of fact and dimension columns, key column)."""
    found = {name: (spec.fact_on, spec.key) for name, spec in DIMENSIONS.items()}
    found["dim_date"] = ([("repair_date", "full_date")], "date_key")
    return {name: found[name] for name in _FACT_JOINS}


def forecast_fact(staging: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """R-09: the fact's row count and the keys that multiply rows, without building it."""
    columns = list(dict.fromkeys(f for on, _ in fact_lookups().values() for f, _ in on))
    lookups = [(name, dims[name], on) for name, (on, _) in fact_lookups().items()]
    return fanout_forecast(staging.select(*columns), lookups)


def build_fact(
    staging: DataFrame, dims: dict[str, DataFrame], max_broadcast_bytes: int = DEFAULT_BROADCAST_MAX_BYTES
) -> DataFrame:
    """J-03 / R-09 / R-10: look up the seven surrogate keys for every staging row.

    Each dimension's size is known from its files: small ones are broadcast and applied
    map-side, no shuffle. The largest of the rest (in practice the customer dimension, which
    grows with the fact) is looked up in place first: only rows that can't tell their key from their own
    columns are shuffled. Any other large one joins afterwards by shuffle on its key, with only
    the columns still needed travelling.

    ``dims`` must be built from ``staging``.
    """
    spec_on = fact_lookups()

    size = {n: planned_bytes(dims[n]) for n in _FACT_JOINS}
    small = {n: size[n] <= max_broadcast_bytes for n in _FACT_JOINS}
    in_place = max((n for n in DIMENSIONS if not small[n]), key=size.get, default=None)
    fact = lookup_key_in_place(staging, dims[in_place], DIMENSIONS[in_place]) if in_place else staging
    for name in sorted((n for n in _FACT_JOINS if n != in_place), key=lambda n: not small[n]):
        on, key = spec_on[name]
        fact = lookup_key(fact, dims[name], on, key, broadcast=small[name])
    return fact.select(*[F.col(c) for c in FACT_COLUMNS])
