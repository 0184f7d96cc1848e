"""Data tests counted while staging is written, the fan-out forecast and the key collision report."""

import os
import re
import subprocess
import sys

import pytest

from checks.fixture import dirty_repairs
from glazework.operators import fanout_forecast, key_collisions, quality_summary
from glazework.operators.dimension import DimensionSpec, build_dimension
from glazework.plans import build_warehouse
from glazework.plans.build import quality_report
from glazework.plans.marts import forecast_fact
from tests.conftest import ROOT, SF_SMALL


@pytest.fixture(scope="module")
def warehouse(spark):
    return build_warehouse(dirty_repairs(spark, SF_SMALL, repeat_customers=True))


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_report_equals_the_one_over_staging_and_reads_ids_only(spark, warehouse):
    report = quality_report(warehouse)
    assert rows(report) == rows(quality_summary(warehouse.staging))
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert set(re.findall(r"ReadSchema: (struct<[^>]*>)", plan)) == {"struct<job_id:string>"}


def test_severity_by_the_caller(spark, warehouse):
    set_by = {"not_null_customer_email": "error", "unique_job_id": "warn"}
    status = {r["test_name"]: r["status"] for r in quality_report(warehouse, set_by).collect()}
    assert status["not_null_customer_email"] == "fail" and status["unique_job_id"] == "warn"
    for wrong in ({"no_such_test": "warn"}, {"unique_job_id": "maybe"}):
        with pytest.raises(ValueError):
            quality_report(warehouse, wrong)


RETRIED = """
import os, sys
from pyspark import TaskContext
from pyspark.sql import Observation
from glazework.operators import observe_row_tests
from glazework.plans.staging import STAGING_COLUMNS
from glazework.session import local_session

spark = local_session("local[2,4]")
path, flag = sys.argv[1], sys.argv[1] + "-failed"

def lose_one(batches):
    for batch in batches:
        yield batch
    if TaskContext.get().partitionId() == 1 and not os.path.exists(flag):
        open(flag, "w").close()
        raise RuntimeError("lost after its rows were counted")

types = {"repair_date": "date", "insurance_claimed": "boolean"}
df = spark.range(0, 4000, 1, 4).mapInArrow(lose_one, "id bigint")
df = df.selectExpr(*[f"CAST(NULL AS {types.get(c, 'string')}) AS {c}" for c in STAGING_COLUMNS])
seen = Observation("tests")
observe_row_tests(df, seen).write.parquet(path)
assert os.path.exists(flag)
print("COUNT", seen.get["not_null_job_id"], seen.get["unmapped_values_garage_type"])
"""


def test_a_task_tried_again_counts_once(tmp_path):
    run = subprocess.run(
        [sys.executable, "-c", RETRIED, str(tmp_path / "t")], cwd=ROOT, capture_output=True, text=True,
        env=os.environ | {"PYTHONPATH": ROOT}, timeout=300,
    )
    assert "COUNT 4000 0" in run.stdout, run.stderr[-2000:]


def test_forecast_equals_the_fact(spark, warehouse):
    found = forecast_fact(warehouse.staging, warehouse.dims).collect()
    total = [r for r in found if r["lookup"] == "total"]
    assert [(r["fact_rows"], r["joined_rows"]) for r in total] == [(warehouse.staging.count(), warehouse.fact.count())]
    assert total[0]["joined_rows"] > total[0]["fact_rows"]
    one = max((r for r in found if r["lookup"] == "dim_customer"), key=lambda r: r["joined_rows"])
    assert warehouse.staging.where(f"customer_id = '{one['key']}'").count() == one["fact_rows"]


@pytest.mark.parametrize("max_bytes", [1 << 20, 0])
def test_forecast_multiplies_over_lookups_and_keeps_hot_and_null_keys(spark, max_bytes):
    fact = spark.range(3000).selectExpr("IF(id % 3 = 0, 'hot', string(id)) AS a", "IF(id % 10 = 0, NULL, id % 2) AS b")
    one = spark.createDataFrame([("hot",)] * 3 + [("1",), (None,), (None,)], "x string")
    two = spark.createDataFrame([(0,), (0,), (None,)], "y int")
    lookups = [("one", one, [("a", "x")]), ("two", two, [("b", "y")])]
    joined = fact.join(one, fact.a == one.x, "left").join(two, fact.b == two.y, "left").count()
    out = {(r["lookup"], r["key"]): tuple(r)[2:] for r in fanout_forecast(fact, lookups, max_bytes).collect()}
    zeros = fact.where("b = 0").count()
    assert out == {("total", None): (3000, None, joined), ("one", "hot"): (1000, 3, 3000), ("two", "0"): (zeros, 2, 2 * zeros)}
    assert [tuple(r) for r in fanout_forecast(fact.where("false"), lookups, max_bytes).collect()] == [("total", None, 0, None, 0)]


def test_collisions_are_told_from_shared_keys(spark):
    spec = DimensionSpec("d", "k", ["a", "b"], ["a", "b", "c"], ["a"], [])
    data = [("a-b", "c", 1), ("a", "b-c", 1), ("x", "y", 1), ("x", "y", 2), ("z", None, 1), ("q", "q", 1)]
    dim = build_dimension(spark.createDataFrame(data, "a string, b string, c int"), spec)
    from glazework.functions.keys import surrogate_text
    from glazework import constants as K

    null_text = K.SURROGATE_KEY_NULL
    dim = dim.unionByName(build_dimension(spark.createDataFrame([("n", None, 1), ("n", null_text, 1)], "a string, b string, c int"), spec))
    keys = {r["k"]: r["t"] for r in dim.select("k", surrogate_text("a", "b").alias("t")).distinct().collect()}
    out = {keys[r["surrogate_key"]]: tuple(r)[2:] for r in key_collisions(dim, spec).collect()}
    assert out["a-b-c"] == (2, 2, 1) and out["x-y"] == (2, 1, 1) and out[f"n-{null_text}"] == (2, 2, 1)
    assert "q-q" not in out
