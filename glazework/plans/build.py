"""J-05 / S-04 / S-05: the whole build in dependency order, and publishing."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from glazework.operators.date_spine import dim_date
from glazework.operators.quality import observe_row_tests, quality_summary
from glazework.plans.marts import build_dimensions, build_fact
from glazework.plans.runs import Ledger, create_views, current_run, input_fingerprint, new_run, switch_to, table_path
from glazework.plans.staging import build_staging
from glazework.session import DEFAULT_BROADCAST_MAX_BYTES, materialize
from glazework.sources.seeds import load_seeds
from glazework.storage import Store

@dataclass
class Warehouse:
    staging: DataFrame
    dims: dict[str, DataFrame] = field(default_factory=dict)
    fact: DataFrame | None = None
    published_dir: str | None = None  # the warehouse folder, and
    run: str | None = None  # the run in it that staging and the dimensions already belong to
    row_tests: dict[str, int] | None = None  # failures of the row-level tests, counted while staging was written

    def tables(self) -> dict[str, DataFrame]:
        out = {"stg_repairs": self.staging, **self.dims}
        if self.fact is not None:
            out["fact_repairs"] = self.fact
        return out


def build_warehouse(
    raw: DataFrame,
    seeds: dict[str, DataFrame] | None = None,
    max_broadcast_bytes: int = DEFAULT_BROADCAST_MAX_BYTES,
    publish_dir: str | None = None,
    resume: bool = False,
) -> Warehouse:
    """staging → dimensions → fact, each step written before the next reads it.

    Staging is written once and read by the six dimension jobs and the fact
    job (each reads only its columns). Written steps also mean a lost
    executor costs a re-read of files, not a replay of the build. The row-level data tests are counted
    while staging is written.

    With ``publish_dir`` the staging table and the dimensions are written
    straight to a new run in it (no second copy), beside what is published
    there; ``publish`` writes the fact and the calendar, and then switches to the run.

    With ``resume`` as well, finished steps are entered in the folder's ledger under a fingerprint of the inputs. A
    build that was broken off is taken up by the next one of the same inputs: steps in the ledger are read, not made again.
    """
    spark = raw.sparkSession
    seeds = seeds if seeds is not None else load_seeds(spark)
    if resume and publish_dir is None:
        raise ValueError("resume needs publish_dir")
    ledger = Ledger.open(spark, publish_dir, input_fingerprint(raw, seeds)) if resume else None
    run = (ledger.run if ledger else new_run()) if publish_dir else None

    def written(name: str, make: Callable[[], DataFrame], detail: Callable[[], dict] = dict) -> DataFrame:
        path = table_path(publish_dir, run, name) if run else None
        if ledger and name in ledger.steps:
            return spark.read.parquet(path)
        table = materialize(make(), name, path=path)
        if ledger:
            ledger.enter(name, detail())
        return table

    seen = Observation("row_tests")
    staging = written(
        "stg_repairs",
        lambda: observe_row_tests(build_staging(raw, seeds, max_broadcast_bytes=max_broadcast_bytes), seen),
        lambda: seen.get,
    )
    dims = build_dimensions(staging, written)
    dims["dim_date"] = dim_date(spark)
    fact = build_fact(staging, dims, max_broadcast_bytes)
    row_tests = ledger.steps["stg_repairs"] if ledger else seen.get
    return Warehouse(staging, dims, fact, publish_dir.rstrip("/") if publish_dir else None, run, row_tests)


def quality_report(wh: Warehouse, severities: dict[str, str] | None = None) -> DataFrame:
    """J-04: the data tests of a built warehouse.

    The row-level tests were counted while staging was written; only the ids are read, for the unique test.
    """
    return quality_summary(wh.staging, observed=wh.row_tests, severities=severities)


class FailedTests(Exception):
    """Data tests of severity ``error`` that keep a run from being published."""


def publish(
    wh: Warehouse, out_dir: str, partition_fact_by_year: bool = False, schema: str | None = None,
    gate: bool = False, severities: dict[str, str] | None = None,
) -> dict[str, str]:
    """S-05: every table as Parquet in a run under ``out_dir``, then the switch; returns paths.

    Nothing that is published gets overwritten: a run that fails half-way leaves the former tables
    as they were. The switch is one file of the log, which :func:`published` and the views
    of ``schema`` read, so all tables move at once. The views are made once and let models and tools
    read the tables by name in any session of that catalog.

    With ``gate``, the data tests decide: if one of severity ``error`` fails (``severities`` sets them by test
    name), nothing is switched and :class:`FailedTests` names them; ``warn`` never holds a run back.

    Tables that the build already wrote are not written again. With
    ``partition_fact_by_year`` the fact is written in ``repair_year=`` folders
    (from ``date_key``; NULL dates in the default partition), so readers
    filtering on a year only list and read those folders. A warehouse folder keeps to one of the two layouts.
    """
    out, spark = out_dir.rstrip("/"), wh.staging.sparkSession
    if gate:
        report = quality_report(wh, severities).where("status = 'fail'").collect()  # 15 rows at most
        if report:
            raise FailedTests(", ".join(sorted(f"{r['test_name']} ({r['failures']})" for r in report)))
    store = Store(spark, out)
    by_year = bool(store.matches("fact_repairs/run=*/repair_year=*"))
    if by_year != partition_fact_by_year and store.matches("fact_repairs/run=*/*.parquet" if not by_year else "fact_repairs/run=*"):
        raise ValueError(f"the fact in {out} is {'' if by_year else 'not '}kept by year")
    built_here = wh.published_dir == out and wh.run is not None
    run = wh.run if built_here else new_run()
    paths, columns = {}, {}
    for name, df in wh.tables().items():
        paths[name], columns[name] = table_path(out, run, name), list(df.columns)
        if built_here and name not in ("fact_repairs", "dim_date"):
            continue
        writer = df.write
        if name == "fact_repairs" and partition_fact_by_year:
            writer = df.withColumn("repair_year", (F.col("date_key") / 10000).cast("int")).write
            writer = writer.partitionBy("repair_year")
            columns[name].append("repair_year")
        writer.mode("overwrite").parquet(paths[name])
    switch_to(spark, out, run)
    if schema:
        create_views(spark, out, schema, columns)
    return paths


def published(spark: SparkSession, out_dir: str, name: str) -> DataFrame:
    """A published table by name."""
    return spark.read.parquet(table_path(out_dir, current_run(spark, out_dir), name))


def register_views(spark: SparkSession, wh: Warehouse) -> None:
    """S-04 / S-05: every table as a temporary view, for SQL consumers in this session."""
    for name, df in wh.tables().items():
        df.createOrReplaceTempView(name)
