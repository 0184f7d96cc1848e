"""Physical-plan checks: broadcasts where bounded, pruned scans, no Python in the hot path."""

import pytest

from checks.fixture import dirty_repairs
from checks.registry import registry
from glazework.plans.queries import raw_queries
from glazework.session import materialize
from tests.conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_staging_plan(spark):
    plan = _plan(registry()["stg_repairs"](spark, SF_SMALL))
    assert plan.count("BroadcastHashJoin") >= 4          # region lookup and sieve, for lone rows and suspects
    assert "_seed_key_" not in plan                       # the eight codes are looked up in the projection
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert "SortMergeJoin" in plan                        # orders ⋈ customer by shuffle


@pytest.fixture(scope="module")
def stored_raw(spark):
    return materialize(dirty_repairs(spark, SF_SMALL), "raw")


def test_expression_query_prunes_columns(spark, stored_raw):
    plan = _plan(raw_queries()["clean_email"](stored_raw))
    assert "ReadSchema: struct<job_id:bigint,customer_email:string>" in plan
    assert "BatchEvalPython" not in plan


@pytest.mark.parametrize("name, joins", [
    ("dim_customer", 0), ("dim_technician", 0), ("dim_garage", 1), ("dim_vehicle", 0),
    ("dim_repair_details", 0), ("dim_job_context", 0),
])
def test_dimensions_join_only_what_they_read(spark, stored_raw, name, joins):
    """The region lookup for the garage alone; codes need no join."""
    plan = _plan(raw_queries()[name](stored_raw))
    assert plan.count("BroadcastHashJoin") + plan.count("SortMergeJoin") == joins, plan


def test_dq_summary_cleans_the_columns_of_tests_only(spark, stored_raw):
    plan = raw_queries()["dq_summary"](stored_raw)._jdf.queryExecution().optimizedPlan().toString()
    union = plan.split("Union")[2].splitlines()  # of lone rows and suspects, below the counts
    depth = union[1].index(":-")
    alone = "\n".join(line for line in union[1:] if line[depth : depth + 1] == ":" and "Relation" not in line)
    assert "customer_email#" in alone and "insurance_claimed#" in alone
    assert "customer_mobile#" not in alone and "repair_cost#" not in alone and "Aggregate" not in alone


def test_every_query_stays_in_the_jvm_and_pairs_nothing(spark):
    """No Python evaluation, no cartesian or nested-loop joins in any registered query."""
    for name, query in registry().items():
        plan = _plan(query(spark, SF_SMALL))
        for bad in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
                    "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert bad not in plan, (name, bad)


def test_scans_read_only_needed_columns(spark):
    plan = _plan(registry()["clean_email"](spark, SF_SMALL))
    # the fixture needs orders' key, customer key and price only
    assert "o_orderdate" not in plan and "o_orderstatus" not in plan and "c_acctbal" not in plan
