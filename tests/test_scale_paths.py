"""The non-broadcast paths and hot keys give the same answers as the broadcast paths."""

import pytest
from pyspark.sql import functions as F

from glazework.operators import lookup_key, region_lookup
from glazework.plans.marts import build_dimensions, build_fact
from glazework.plans.staging import build_staging
from glazework.session import materialize
from checks.fixture import dirty_repairs
from glazework.sources.raw import RAW_COLUMNS
from glazework.sources.seeds import load_seeds
from glazework.operators.date_spine import dim_date
from tests.conftest import SF_SMALL


def _rows(df):
    return sorted(tuple("" if v is None else str(v) for v in r) for r in df.collect())


def test_region_lookup_shuffle_path_matches(spark):
    raw = dirty_repairs(spark, SF_SMALL)
    seeds = load_seeds(spark)
    lk = materialize(region_lookup(raw), "region_lookup")
    small = _rows(build_staging(raw, seeds, lookup=lk))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        big = build_staging(raw, seeds, lookup=lk, max_broadcast_bytes=0)
        plan = big._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan
        assert small == _rows(big)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_fact_shuffle_path_matches(spark):
    stg = materialize(build_staging(dirty_repairs(spark, SF_SMALL), load_seeds(spark)), "stg")
    dims = build_dimensions(stg)
    dims["dim_date"] = dim_date(spark)
    broadcast = _rows(build_fact(stg, dims))
    # above the bound no hint is given; switch off the planner's own size-based
    # broadcast too, so every join really goes by shuffle
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    for k in keys:
        spark.conf.set(k, "-1")
    try:
        shuffled = build_fact(stg, dims, max_broadcast_bytes=0)
        plan = shuffled._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin") >= 6
        assert "_sieve_bits" in shuffled._jdf.queryExecution().optimizedPlan().toString()  # the largest is looked up in place
        assert broadcast == _rows(shuffled)
    finally:
        for k in keys:
            spark.conf.unset(k)


def test_hot_customer_key_by_shuffle(spark):
    """A third of the fact rows on one key: AQE splits that partition, the result stays whole."""
    n = 60_000
    fact = spark.range(n, numPartitions=8).select(
        F.col("id").alias("job"),
        F.when(F.col("id") % 3 == 0, F.lit("CUST_HOT")).otherwise(F.concat(F.lit("C"), F.col("id").cast("string"))).alias("customer_id"),
    )
    dim = spark.range(n).select(
        F.concat(F.lit("C"), F.col("id").cast("string")).alias("customer_id"),
        F.md5(F.col("id").cast("string")).alias("customer_key"),
    ).unionByName(spark.range(2).select(F.lit("CUST_HOT").alias("customer_id"), F.md5(F.col("id").cast("string")).alias("customer_key")))
    settings = {
        "spark.sql.shuffle.partitions": "32",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        out = lookup_key(fact, dim, [("customer_id", "customer_id")], "customer_key", broadcast=False)
        rows = out.collect()
        final_plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in final_plan        # the hot partition was split
        hot = n // 3
        # every hot row meets both dimension rows of the hot id (fan-out kept), the rest meet one
        assert len(rows) == 2 * hot + (n - hot)
        assert all(r["customer_key"] is not None for r in rows)
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_hot_copy_group_in_dedupe(spark):
    """A third of the rows are exact copies of one row: collapsed to one, nothing else lost."""
    from glazework.operators import dedupe_rows

    n = 30_000
    df = spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("v"))
    assert dedupe_rows(df).count() == 1 + (n - n // 3)


LARGE_JOIN = {
    "spark.sql.shuffle.partitions": "32",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}


@pytest.fixture
def by_shuffle(spark):
    old = {k: spark.conf.get(k, None) for k in LARGE_JOIN}
    for k, v in LARGE_JOIN.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_large_lookup_in_place_ships_only_rows_it_must(by_shuffle):
    """A third of the rows on one customer, a third without one: neither leaves the scan stage."""
    from glazework.operators.dimension import DimensionSpec, build_dimension, lookup_key_in_place

    spec = DimensionSpec("d", "k", ["id", "mail"], ["id", "mail"], ["id", "mail"], [("id", "id")])
    n = 60_000
    fact = by_shuffle.range(n, numPartitions=8).selectExpr(
        "id AS job",
        "CASE id % 3 WHEN 0 THEN 'hot' WHEN 1 THEN NULL ELSE string(id % 5000) END AS id",
        # some rows of a customer have no mail, and every tenth customer has two
        "CASE WHEN id % 3 = 0 THEN 'h' WHEN id % 7 = 0 THEN NULL ELSE concat('m', IF(id % 10 = 0, floor(id / 5000) % 2, 0)) END AS mail",
    )
    fact = materialize(fact, "fact")
    dim = materialize(build_dimension(fact, spec), "dim")
    out = lookup_key_in_place(fact, dim, spec)
    want = lookup_key(fact, dim, spec.fact_on, spec.key, broadcast=False).select(out.columns)
    assert _rows(out) == _rows(want) and out.count() > n
    text = out._jdf.queryExecution().executedPlan().toString()
    union = text[text.index("Union"):].splitlines()
    depth = union[1].index(":-")
    assert not any("hashpartitioning" in line for line in union[1:] if line[depth : depth + 1] == ":")
    out.write.format("noop").mode("overwrite").save()
    several = dim.groupBy("id").count().where("count > 1").select("id")
    must = fact.where("id IS NOT NULL").join(several, "id", "left_semi").count() + fact.where("id IS NOT NULL AND mail IS NULL").count()
    assert must < n / 3


def test_hot_customer_of_several_rows_is_split(by_shuffle):
    from glazework.operators.dimension import DimensionSpec, build_dimension, lookup_key_in_place

    spec = DimensionSpec("d", "k", ["id", "mail"], ["id", "mail"], ["id", "mail"], [("id", "id")])
    fact = materialize(by_shuffle.range(60_000, numPartitions=8).selectExpr(
        "id AS job", "md5(string(id)) AS load", "IF(id % 3 = 0, 'hot', string(id)) AS id", "IF(id % 3 = 0, string(id % 2), IF(id % 2 = 0, NULL, 'x')) AS mail"), "fact")
    dim = materialize(build_dimension(fact, spec), "dim")
    out = lookup_key_in_place(fact, dim, spec)
    rows = out.collect()
    assert len(rows) == 2 * 20_000 + 40_000
    assert "SortMergeJoin(skew=true)" in out._jdf.queryExecution().executedPlan().toString()


TUNED = ["spark.sql.codegen.hugeMethodLimit", "spark.sql.adaptive.coalescePartitions.minPartitionNum"]


@pytest.fixture
def untuned(spark):
    """The session without the settings of the build, which come back afterwards."""
    found = {k: spark.conf.get(k, None) for k in TUNED}
    for k in TUNED:
        spark.conf.unset(k)
    yield spark
    for k, v in found.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _raw_rows(spark):
    row = [
        "job_id bigint", *[f"{c} {'bigint' if c in ('technician_id', 'customer_id') else 'int' if c == 'vehicle_age_in_years' else 'double' if c == 'job_duration_in_hours' else 'string'}"
                           for c in RAW_COLUMNS if c != "job_id"],
    ]
    order = [r.split()[0] for r in row]
    values = {"job_id": 1, "technician_id": 2, "customer_id": 3, "vehicle_age_in_years": 4, "job_duration_in_hours": 1.5,
              "city": " leeds", "region": "N/A", "repair_cost": "£1,200.50", "customer_name": "Mr Al Ba"}
    one = tuple(values.get(c, "x") for c in order)
    other = tuple({**values, "job_id": 5, "region": "north", "city": "LEEDS"}.get(c) for c in order)
    return spark.createDataFrame([one, one, other], ", ".join(row)).select(*RAW_COLUMNS)


def test_cleaning_is_not_interpreted(untuned):
    """The wide projection is over the JVM's bound for compiled methods, so the session must not fuse it into one."""
    raw = materialize(_raw_rows(untuned), "raw")
    staging = build_staging(raw, load_seeds(untuned))
    assert int(untuned.conf.get(TUNED[0])) == 8000
    assert int(untuned.conf.get(TUNED[1])) >= 2 * untuned.sparkContext.defaultParallelism
    apart = _rows(staging)
    assert len(apart) == 2 and {r[2] for r in apart} == {"North"}
    untuned.conf.set(TUNED[0], "65535")
    assert _rows(build_staging(raw, load_seeds(untuned))) == apart  # fused: the same rows


def test_settings_of_the_session_stay(untuned):
    for k, v in zip(TUNED, ("20000", "3")):
        untuned.conf.set(k, v)
    build_staging(materialize(_raw_rows(untuned), "raw"), load_seeds(untuned))
    assert [untuned.conf.get(k) for k in TUNED] == ["20000", "3"]
