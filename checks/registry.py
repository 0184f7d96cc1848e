"""The driver's (spark, sf_dir) → DataFrame form of every query.

The queries of ``glazework.plans.queries`` take a raw table; here it is derived from the
driver tables (``checks.fixture``), so each query's work grows with them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from checks.fixture import dirty_repairs
from glazework.operators.quality import boolean_violations
from glazework.plans.queries import RawQuery, fact_fanout_forecast, fact_repairs, key_collision_report, raw_queries
from glazework.plans.staging import build_staging
from glazework.sources.seeds import inline_seed, load_seeds, seed_rows

Query = Callable[[SparkSession, str], DataFrame]

#: Rows added to a seed: a repeated row, a second value for a key, keys that match nothing.
EXTRA_SEED_ROWS = {
    "garage_type": [("Mobile", "Mobile"), ("chain", "Chain"), ("Franchise", "Chain"), (None, "Nothing"),
                    (None, "Nobody"), ("", "Blank"), (" ", "Blank")],
}


def stg_repairs_seed_fanout(raw: DataFrame) -> DataFrame:
    """Staging with a seed that holds some keys several times."""
    spark = raw.sparkSession
    seeds = load_seeds(spark)
    for column, extra in EXTRA_SEED_ROWS.items():
        seeds[column] = inline_seed(spark, [*seed_rows(column), *extra])
    return build_staging(raw, seeds)


def on_fixture(fn: RawQuery, **variant: bool) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(dirty_repairs(spark, sf_dir, **variant))

    run.__name__ = getattr(fn, "__name__", "query")
    return run


def registry() -> dict[str, Query]:
    queries = raw_queries()
    q = {name: on_fixture(fn) for name, fn in queries.items()}
    # Fan-out fixtures: one customer id with several customer rows; one
    # technician key naming two technician rows; a seed with repeated keys.
    q["fact_repairs_fanout"] = on_fixture(fact_repairs, repeat_customers=True)
    q["fact_repairs_tech_fanout"] = on_fixture(fact_repairs, vary_technicians=True)
    q["dim_technician_shared_keys"] = on_fixture(queries["dim_technician"], vary_technicians=True)
    q["fact_fanout_forecast"] = on_fixture(fact_fanout_forecast, repeat_customers=True)
    q["fact_tech_fanout_forecast"] = on_fixture(fact_fanout_forecast, vary_technicians=True)
    q["key_collisions"] = on_fixture(key_collision_report, vary_technicians=True, clashing_garages=True)
    q["stg_repairs_seed_fanout"] = on_fixture(stg_repairs_seed_fanout)
    q["dq_valid_boolean_staging"] = on_fixture(lambda raw: boolean_violations(queries["stg_repairs"](raw)))
    return q
