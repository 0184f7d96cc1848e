"""Structural checks of the test input, the staging job, the marts and the build."""

import pytest
from pyspark.sql import functions as F

from checks.fixture import CODE_DIRT, DUCKDB, code_pool, dirty_repairs, recipe_sql
from glazework import constants as K
from glazework.plans import STAGING_COLUMNS, build_staging, build_warehouse, current_run, publish, published, register_views
from glazework.plans.marts import DIMENSIONS, FACT_COLUMNS
from glazework.session import materialize, work_dir
from glazework.sources.seeds import load_seeds
from tests.conftest import SF_MID, SF_SMALL

RAW, STAGED = 1530, 1515  # 1500 orders; 15 sent twice alike, 15 twice with another duration


@pytest.fixture(scope="module")
def raw(spark):
    return materialize(dirty_repairs(spark, SF_SMALL), "raw")


@pytest.fixture(scope="module")
def warehouse(spark, raw):
    return build_warehouse(raw)


def test_fixture_shape(raw):
    assert raw.count() == RAW
    assert raw.distinct().count() == STAGED


def test_every_value_meets_every_kind_of_dirt(spark):
    raw = materialize(dirty_repairs(spark, SF_MID), "raw_mid")
    for column in [*K.MAPPED_COLUMNS, "vehicle_brand", "vehicle_model"]:
        seen = {r[0] for r in raw.select(column).distinct().collect()}
        assert K.NA_TOKEN in seen and None in seen, column
        for value in code_pool(column):
            wanted = {value, value.lower(), value.upper(), f"  {value} ", f"\t{value}\t"}
            assert wanted <= seen, (column, wanted - seen)
    assert len(CODE_DIRT) == 6
    brands = {r[0] for r in raw.select("vehicle_brand").distinct().collect()}
    models = {r[0] for r in raw.select("vehicle_model").distinct().collect()}
    assert "bmw" in brands and "r 1250 gs" in models
    dates = [r[0] for r in raw.select("repair_date").distinct().collect()]
    assert any(d and d != d.strip() for d in dates) and "31/02/2022" in dates and None in dates
    mobiles = raw.where(F.col("customer_mobile").rlike(r"^07\d{3} \d{6}$"))
    assert mobiles.count() > 0
    assert raw.where(F.length("repair_cost") > 300).count() > 0


def test_recipe_is_the_same_text_in_both_engines():
    assert DUCKDB.lit("Lion's") == "'Lion''s'" and "unnest" in recipe_sql()


def test_staging_shape_and_types(spark, raw):
    stg = build_staging(raw, load_seeds(spark))
    assert stg.columns == STAGING_COLUMNS
    types = dict(stg.dtypes)
    assert types["repair_date"] == "date" and types["repair_cost"] == "double"
    assert types["customer_rating"] == "bigint" and types["insurance_claimed"] == "boolean"
    assert stg.count() == STAGED
    assert stg.where(F.isnan("profit") | (F.abs("repair_cost") == float("inf"))).count() == 0


def test_build_marts(warehouse):
    dims = warehouse.dims
    assert dims["dim_date"].count() == 4017
    for name, df in dims.items():
        attrs = [c for c in df.columns if not c.endswith("_key") or name == "dim_date"]
        assert df.count() == df.select(*attrs).distinct().count(), name
        for c in DIMENSIONS[name].not_null if name in DIMENSIONS else []:
            assert df.where(F.col(c).isNull()).count() == 0, (name, c)
    fact = warehouse.fact
    assert fact.columns == FACT_COLUMNS
    assert fact.count() == STAGED
    staged = warehouse.staging
    bad_dates = staged.where(F.col("repair_date").isNull() | (F.year("repair_date") > 2030)).count()
    assert 0 < bad_dates == fact.where(F.col("date_key").isNull()).count()


def test_lean_dimension_equals_the_one_over_staging(spark, raw, warehouse):
    from glazework.plans.queries import raw_queries

    for name in DIMENSIONS:
        lean = raw_queries()[name](raw)
        assert lean.exceptAll(warehouse.dims[name]).count() == 0 == warehouse.dims[name].exceptAll(lean).count(), name


def test_fact_fans_out_on_repeated_customers(spark):
    wh = build_warehouse(dirty_repairs(spark, SF_SMALL, repeat_customers=True))
    assert wh.fact.count() > wh.staging.count()  # join on customer_id alone multiplies rows
    jobs = wh.staging.select("job_id").distinct().count()
    assert wh.fact.select("job_id").distinct().count() == jobs


def test_technician_key_repeats_and_fact_fans_out(spark):
    wh = build_warehouse(dirty_repairs(spark, SF_SMALL, vary_technicians=True))
    dim = wh.dims["dim_technician"]
    assert dim.count() > dim.select("technician_key").distinct().count()  # one key, two rows
    assert wh.fact.count() > wh.staging.count()


def test_publish_and_views(spark, warehouse, tmp_path):
    paths = publish(warehouse, str(tmp_path))
    assert set(paths) == {"stg_repairs", "fact_repairs", "dim_garage", "dim_customer", "dim_technician",
                          "dim_vehicle", "dim_repair_details", "dim_job_context", "dim_date"}
    assert spark.read.parquet(paths["fact_repairs"]).count() == STAGED
    register_views(spark, warehouse)
    n = spark.sql("SELECT count(*) FROM fact_repairs f JOIN dim_date d ON f.date_key = d.date_key").first()[0]
    assert 0 < n < STAGED


def test_run_folder_is_written_once_and_switched_to(spark, raw, tmp_path):
    out = str(tmp_path / "wh")
    first = publish(build_warehouse(raw, publish_dir=out), out)
    assert published(spark, out, "fact_repairs").count() == STAGED
    second = publish(build_warehouse(raw, publish_dir=out), out)
    run_of = lambda path: path.split("/run=")[1]
    assert current_run(spark, out) == run_of(second["fact_repairs"]) != run_of(first["fact_repairs"])
    assert published(spark, out, "stg_repairs").inputFiles()[0].split("/run=")[1][:33] in second["stg_repairs"]
    assert spark.read.parquet(first["fact_repairs"]).count() == STAGED  # a reader of the former run goes on


def test_failure_half_way_leaves_the_former_tables(spark, raw, tmp_path, monkeypatch):
    from glazework.plans import build as module

    out = str(tmp_path / "wh")
    publish(build_warehouse(raw, publish_dir=out), out)
    run = current_run(spark, out)

    def fails(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(module, "build_fact", fails)
    with pytest.raises(RuntimeError):
        build_warehouse(raw.limit(10), publish_dir=out)
    assert current_run(spark, out) == run
    assert published(spark, out, "stg_repairs").count() == published(spark, out, "fact_repairs").count() == STAGED


def test_publish_fact_by_year(spark, warehouse, tmp_path):
    paths = publish(warehouse, str(tmp_path), partition_fact_by_year=True)
    fact = spark.read.parquet(paths["fact_repairs"])
    assert fact.count() == STAGED
    years = {r[0] for r in fact.select("repair_year").distinct().collect()}
    assert years == {None, *range(2020, 2026)}
    one = fact.where("repair_year = 2021")
    assert "PartitionFilters: [isnotnull(repair_year" in one._jdf.queryExecution().executedPlan().toString()


def test_materialize_uses_the_work_folder_and_cleans_up(spark):
    from urllib.parse import urlparse

    df = materialize(spark.range(10), "probe")
    assert df.count() == 10
    base = urlparse(work_dir(spark)).path.rstrip("/")
    assert urlparse(df.inputFiles()[0]).path.startswith(base + "/glazework/probe-")
    target = spark._jvm.org.apache.hadoop.fs.Path(df.inputFiles()[0].rsplit("/", 1)[0])
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    assert files.cancelDeleteOnExit(target)  # it was registered for the end of the session
    files.deleteOnExit(target)


def test_broadcast_goes_by_bytes(spark):
    from glazework.session import broadcast_if_small, planned_bytes

    table = materialize(spark.range(100_000), "sized")
    assert 0 < planned_bytes(table) < 10_000_000
    hint = lambda df: "ResolvedHint (strategy=broadcast)" in df._jdf.queryExecution().analyzed().toString()
    assert hint(broadcast_if_small(table)) and not hint(broadcast_if_small(table, 10))
