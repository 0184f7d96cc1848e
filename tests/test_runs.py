"""The switch, the views over it, retention, the gate and resumed builds."""

import pytest

from checks.fixture import dirty_repairs
from glazework.plans import build as module
from glazework.plans import build_warehouse, current_run, publish, published
from glazework.plans import runs as R
from glazework.plans.build import FailedTests
from glazework.session import materialize
from glazework.sources.seeds import inline_seed, load_seeds
from glazework.storage import Store
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def raw(spark):
    return materialize(dirty_repairs(spark, SF_SMALL), "raw")


@pytest.fixture(scope="module")
def warehouse(spark, raw):
    return build_warehouse(raw)


@pytest.fixture
def schema(spark):
    spark.sql("CREATE SCHEMA IF NOT EXISTS runs_test")
    yield "runs_test"
    spark.sql("DROP SCHEMA runs_test CASCADE")


def two_tables(spark, out, run, n):
    for name in ("a", "b"):
        spark.range(n).write.parquet(R.table_path(out, run, name))


def test_all_names_move_by_one_switch(spark, tmp_path, schema):
    out, read = str(tmp_path / "wh"), lambda: [spark.table(f"runs_test.{t}").count() for t in ("a", "b")]
    two_tables(spark, out, "r1", 10)
    R.switch_to(spark, out, "r1")
    R.create_views(spark, out, schema, {"a": ["id"], "b": ["id"]})
    assert read() == [10, 10]
    spark.range(20).write.parquet(R.table_path(out, "r2", "a"))  # a run that fails before its second table
    assert read() == [10, 10]
    spark.range(20).write.parquet(R.table_path(out, "r2", "b"))
    assert read() == [10, 10]
    R.switch_to(spark, out, "r2")
    assert read() == [20, 20]  # no view was touched
    joined = spark.sql("SELECT count(*) FROM runs_test.a JOIN runs_test.b USING (id)")
    assert joined.first()[0] == 20
    plan = spark.table("runs_test.a")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run" in plan and "ubquery" in plan
    R.create_views(spark, out, schema, {"a": ["id"], "b": ["id"]})
    assert read() == [20, 20]


def test_failure_between_two_views_shows_one_run(spark, raw, warehouse, tmp_path, schema, monkeypatch):
    out = str(tmp_path / "wh")
    publish(warehouse, out, schema=schema)
    first = spark.table("runs_test.fact_repairs").count()

    def fails(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(module, "create_views", fails)
    small = build_warehouse(raw.where("job_id < 100500"), publish_dir=out)
    with pytest.raises(RuntimeError):
        publish(small, out, schema=schema)
    counts = {t: spark.table(f"runs_test.{t}").count() for t in ("stg_repairs", "fact_repairs", "dim_customer")}
    assert counts["fact_repairs"] == counts["stg_repairs"] < first
    assert counts["dim_customer"] == small.dims["dim_customer"].count()


def test_numbers_are_taken_once_and_clocks_do_not_matter(spark, tmp_path, monkeypatch):
    out = str(tmp_path)
    times = iter([1000, 5])  # the second publisher's clock is behind
    monkeypatch.setattr(R.time, "time", lambda: next(times))
    assert [R.switch_to(spark, out, "r1"), R.switch_to(spark, out, "r2")] == [1, 2]
    assert current_run(spark, out) == "r2"
    store = Store(spark, out)
    assert not store.create(f"{R.SWITCH}/{2:012d}.json", {"seq": 2, "run": "other"})
    (tmp_path / R.SWITCH / f"{3:012d}.json").touch()  # a publisher that died after taking its number
    assert current_run(spark, out) == "r2"
    monkeypatch.setattr(R.time, "time", lambda: 2000)
    assert R.switch_to(spark, out, "r4") == 4 and current_run(spark, out) == "r4"
    with pytest.raises(ValueError):
        current_run(spark, str(tmp_path / "none"))


def test_retention(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "wh")
    for at, run in ((1000, "r1"), (2000, "r2"), (3000, "r3")):
        two_tables(spark, out, run, 3)
        monkeypatch.setattr(R.time, "time", lambda at=at: at)
        R.switch_to(spark, out, run)
    monkeypatch.undo()
    two_tables(spark, out, "lost", 3)
    assert R.remove_old_runs(spark, out, grace_seconds=1500, now=3600) == ["r1"]  # superseded at 2000; r2 at 3000
    left = {p.split("=")[1] for p, _ in Store(spark, out).matches("a/run=*")}
    assert left == {"r2", "r3", "lost"}
    assert R.remove_old_runs(spark, out, grace_seconds=60, now=1 << 40) == ["lost", "r2"]
    assert published(spark, out, "a").count() == 3 and len(R.published_runs(spark, out)) == 3


def test_gate_holds_back_failing_runs(spark, warehouse, tmp_path):
    out = str(tmp_path / "wh")
    with pytest.raises(FailedTests, match="unique_job_id"):
        publish(warehouse, out, gate=True)
    assert R.published_runs(spark, out) == []
    failing = [r["test_name"] for r in module.quality_report(warehouse).collect() if r["status"] != "pass"]
    publish(warehouse, out, gate=True, severities=dict.fromkeys(failing, "warn"))
    assert published(spark, out, "fact_repairs").count() == 1515


def test_one_layout_of_the_fact(spark, warehouse, tmp_path):
    out = str(tmp_path / "wh")
    publish(warehouse, out, partition_fact_by_year=True)
    with pytest.raises(ValueError, match="by year"):
        publish(warehouse, out)
    publish(warehouse, out, partition_fact_by_year=True)
    assert len(R.published_runs(spark, out)) == 2


def test_a_broken_build_is_taken_up(spark, raw, tmp_path, monkeypatch):
    out, real, made = str(tmp_path / "wh"), module.materialize, []

    def dies_at_the_vehicles(df, name, **kw):
        made.append(name)
        if name == "dim_vehicle":
            raise RuntimeError("driver lost")
        return real(df, name, **kw)

    monkeypatch.setattr(module, "materialize", dies_at_the_vehicles)
    with pytest.raises(RuntimeError):
        build_warehouse(raw, publish_dir=out, resume=True)
    staged = Store(spark, out).matches("stg_repairs/run=*/*.parquet")
    assert made[0] == "stg_repairs" and staged

    again = []
    monkeypatch.setattr(module, "materialize", lambda df, name, **kw: (again.append(name), real(df, name, **kw))[1])
    wh = build_warehouse(raw, publish_dir=out, resume=True)
    assert "dim_vehicle" in again and "stg_repairs" not in again
    assert Store(spark, out).matches("stg_repairs/run=*/*.parquet") == staged  # neither files nor times changed
    paths = publish(wh, out)
    assert wh.run in paths["stg_repairs"] and published(spark, out, "fact_repairs").count() == 1515
    report = {r["test_name"]: r["failures"] for r in module.quality_report(wh).collect()}
    assert report == {r["test_name"]: r["failures"] for r in module.quality_summary(wh.staging).collect()}

    again.clear()  # a published run is finished: the next build is a new one
    assert build_warehouse(raw, publish_dir=out, resume=True).run != wh.run and "stg_repairs" in again


def test_fingerprint_of_inputs(spark, raw):
    seeds = load_seeds(spark)
    one = R.input_fingerprint(raw, seeds)
    assert one == R.input_fingerprint(spark.read.parquet(raw.inputFiles()[0].rsplit("/", 1)[0]), seeds)
    assert one != R.input_fingerprint(raw.where("job_id > 5"), seeds)
    assert one != R.input_fingerprint(materialize(raw, "copy"), seeds)
    assert one != R.input_fingerprint(raw, seeds | {"garage_type": inline_seed(spark, [("a", "b")])})
    with pytest.raises(ValueError):
        R.input_fingerprint(spark.range(3), seeds)
    with pytest.raises(ValueError):
        build_warehouse(raw, resume=True)
