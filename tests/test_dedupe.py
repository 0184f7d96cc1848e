"""Rows that may be repeated are found by a narrow pass; only these are shuffled and compared."""

import re

import pytest
from pyspark.sql import functions as F

from checks.fixture import dirty_repairs
from glazework.operators import dedupe as D
from glazework.operators.lookup import MAX_FUSED_ROWS, code_map, map_codes, mapped_name
from glazework.plans.queries import raw_queries
from glazework.plans.staging import KEPT_COLUMNS
from glazework.session import materialize
from glazework.sources.seeds import inline_seed
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def stored_raw(spark):
    return materialize(dirty_repairs(spark, SF_SMALL), "raw")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def same(a, b):
    return a.exceptAll(b).count() == 0 == b.exceptAll(a).count()


def keep_all(rows, keep):
    return rows.select("a", "b", "c", *keep)


@pytest.mark.parametrize("words", [1, 16, D.SIEVE_WORDS])
def test_equals_distinct_with_nulls_zeros_and_false_alarms(spark, words):
    nan = float("nan")
    rows = [(None, 1, 0.0), (1, None, 0.0), (None, 1, -0.0), (2, 2, nan), (2, 2, nan), (2, 2, None), (None, None, None)]
    rows += [(None, None, None), *[(i, i % 7, 1.0) for i in range(200)], *[(3, 3, 3.0)] * 150]
    df = spark.createDataFrame(rows, "a int, b int, c double").repartition(4)
    for kept in (["a", "b", "c"], ["a"], ["b", "c"]):
        assert same(D.dedupe_cleaned(df, keep_all, kept, words), df.distinct()), kept
    report = D.cleaned_duplicate_report(df, keep_all, ["a", "b"], "a", words)
    assert same(report, D.duplicate_report(df, "a"))
    assert same(D.repeated_ids(df, keep_all, "a", "a", words), df.distinct().where("a IS NOT NULL").groupBy("a").agg(F.count("*").alias("n_records")).where("n_records > 1"))
    assert D.dedupe_cleaned(df.where("false"), keep_all, ["a"], words).collect() == []


def test_fingerprint_tells_where_a_null_stands(spark):
    df = spark.createDataFrame([(None, 1), (1, None), (1, 1), (None, None)], "a int, b int")
    assert df.select(*D.row_fingerprint("a", "b")).distinct().count() == 4


def test_sieve_is_bounded_and_holds_every_repeated_row(spark):
    df = spark.range(20_000).selectExpr("id % 9000 AS v")  # 2,000 values stand three times, 7,000 twice
    sieve = D.repeated_sieve(df, ["v"], words=64)
    assert 0 < sieve.count() <= 64
    lone = df.unionByName(spark.range(50_000, 50_100).selectExpr("id AS v"))
    wide = D.with_mark(lone, D.repeated_sieve(lone, ["v"]), ["v"])
    assert wide.where(f"NOT {D.MARK}").count() >= 95 and wide.where(f"{D.MARK} AND v < 9000").count() == 20_000


def test_lone_wide_rows_enter_no_exchange(spark, stored_raw):
    plan = _plan(raw_queries()["stg_repairs"](stored_raw))
    union = plan[plan.index("Union"):].splitlines()
    depth = union[1].index(":-")
    alone = [line for line in union[1:] if line[depth : depth + 1] == ":"]
    other = [line for line in union[1:] if line[depth : depth + 1] != ":"]
    assert not any("hashpartitioning" in line for line in alone) and any("hashpartitioning" in line for line in other)
    marked = D.with_mark(stored_raw, D.repeated_sieve(stored_raw, KEPT_COLUMNS), KEPT_COLUMNS)
    assert marked.where(D.MARK).count() == 30  # 15 jobs sent twice alike, of 1,530 rows


def test_split_keeps_every_row_once_and_copies_none(spark):
    made = spark.range(3_000).selectExpr("id % 2900 AS a", "IF(id % 5 = 0, NULL, id % 2900) AS b")
    sieve = D.repeated_sieve(made, ["a"])
    alone, suspects = D.split_by_sieve(made, sieve, ["a"])
    assert same(alone.union(suspects), made) and suspects.where("a < 100").count() == 200
    assert same(suspects, D.with_mark(made, sieve, ["a"]).where(D.MARK).drop(D.MARK))
    for part, kind in ((alone, "LeftAnti"), (suspects, "LeftSemi")):
        assert part._jdf.queryExecution().optimizedPlan().toString().startswith(f"Join {kind}")


def test_staging_copies_no_row_beside_a_mark(stored_raw):
    assert D.MARK not in raw_queries()["stg_repairs"](stored_raw)._jdf.queryExecution().optimizedPlan().toString()


def test_unique_test_ships_ids_and_fingerprints_only(spark, stored_raw):
    plan = _plan(raw_queries()["dq_unique_job"](stored_raw))
    shipped = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    columns = {re.sub(r"#\d+L?", "", c.strip()) for s in shipped for c in s.split(",")} - {"8", "ENSURE_REQUIREMENTS"}
    assert shipped and columns <= {"job_id", "_high", "_low", "high", "low", "word"}, columns
    assert "isnotnull(job_id" in plan


def test_sieve_reads_the_kept_columns_only(spark, stored_raw):
    counted = stored_raw.select(*D.row_fingerprint(*KEPT_COLUMNS))
    plan = _plan(counted)
    assert all(f"{c}#" in plan for c in KEPT_COLUMNS)
    assert not any(f"{c}#" in plan for c in stored_raw.columns if c not in KEPT_COLUMNS)


def test_hot_copies_are_merged_before_the_shuffle(spark):
    df = spark.range(30_000, numPartitions=8).selectExpr("IF(id % 3 = 0, -1, id) AS a", "1 AS b", "2 AS c")
    out = D.dedupe_cleaned(df, keep_all, ["a"])
    assert out.count() == 20_001 and out.where("a = -1").count() == 1


def test_codes_are_fused_unless_a_key_repeats_or_the_seed_is_long(spark):
    fine = inline_seed(spark, [(" Chain ", "C"), ("x", None), (None, "n"), (None, "m")])
    assert code_map(fine) == {"CHAIN": "C", "X": None}
    assert code_map(inline_seed(spark, [("a", "1"), (" A", "1")])) is None
    long = inline_seed(spark, [(f"k{i}", str(i)) for i in range(MAX_FUSED_ROWS + 1)])
    assert code_map(long) is None and len(code_map(long, 1000)) == MAX_FUSED_ROWS + 1
    raw = spark.createDataFrame([(1, "k7 "), (2, None), (3, "?")], "job_id int, garage_type string")
    for seed in (long, inline_seed(spark, [("K7", "7")])):
        out = map_codes(raw, {"garage_type": seed}, ["garage_type"]).orderBy("job_id")
        assert [r[mapped_name("garage_type")] for r in out.collect()] == ["7", None, None]
    none = map_codes(raw, {"garage_type": fine.where("false")}, ["garage_type"])
    assert none.where(F.col(mapped_name("garage_type")).isNotNull()).count() == 0


def test_one_seed_join_is_left(spark, stored_raw):
    from checks.registry import stg_repairs_seed_fanout

    text = stg_repairs_seed_fanout(stored_raw)._jdf.queryExecution().optimizedPlan().toString()
    assert set(re.findall(r"_seed_key_(\w+?)#", text)) == {"garage_type"}
    text = raw_queries()["stg_repairs"](stored_raw)._jdf.queryExecution().optimizedPlan().toString()
    assert "_seed_key_" not in text
