"""S-01 … S-03: raw table readers and seeds."""

import csv

import pytest
from pyspark.sql import functions as F

from checks.fixture import dirty_repairs
from glazework.constants import MAPPED_COLUMNS
from glazework.operators import map_codes
from glazework.sources import (
    RAW_COLUMNS,
    RAW_SCHEMA,
    land_raw_csv,
    load_seeds,
    read_raw_csv,
    read_raw_parquet,
    read_raw_table,
    repeated_keys,
    seed_rows,
    write_raw_csv,
)
from glazework.sources.seeds import inline_seed
from tests.conftest import SF_SMALL


def _record(job_id, **values):
    return [str(job_id) if c == "job_id" else values.get(c, "") for c in RAW_COLUMNS]


def _write(path, records, header=None):
    with open(path, "w", newline="", encoding="utf-8") as fh:
        writer = csv.writer(fh)
        writer.writerow(header or RAW_COLUMNS)
        writer.writerows(records)
    return str(path)


def test_csv_round_trip(spark, tmp_path):
    raw = dirty_repairs(spark, SF_SMALL)
    path = str(tmp_path / "raw_csv")
    write_raw_csv(raw, path)
    back, rejects = land_raw_csv(spark, path)
    assert back.columns == RAW_COLUMNS and rejects.count() == 0
    # padding survives; an empty field reads as NULL (the source cannot tell '' from NULL)
    want = raw.selectExpr(*[f"nullif({c}, '') AS {c}" if t == "string" else c for c, t in raw.dtypes])
    assert want.exceptAll(back).count() == 0 and back.exceptAll(want).count() == 0


def test_csv_as_the_csv_module_writes_it(spark, tmp_path):
    names = ['Acme "Best", Ltd Autoworks', "Back\\slash, Ltd\\", '"', "a,b", "it's", " padded ", "tab\there"]
    path = _write(tmp_path / "raw.csv", [_record(i, garage_name=n, city="X") for i, n in enumerate(names)])
    good, rejects = land_raw_csv(spark, path)
    got = {r["job_id"]: (r["garage_name"], r["city"], r["garage_type"]) for r in good.collect()}
    assert got == {i: (n, "X", None) for i, n in enumerate(names)}
    assert rejects.count() == 0


def test_csv_rejects_are_kept_and_counted(spark, tmp_path):
    records = [
        _record(1, city="good"),
        _record(2, technician_id="12a"),
        _record(3) + ["surplus"],
        _record(4)[:-1],
        _record(5, city="good"),
    ]
    good, rejects = land_raw_csv(spark, _write(tmp_path / "raw.csv", records))
    assert sorted(r["job_id"] for r in good.collect()) == [1, 5]
    texts = sorted(r[0] for r in rejects.collect())
    assert [t.split(",")[0] for t in texts] == ["2", "3", "4"] and "12a" in texts[0]


def test_csv_line_end_in_a_field(spark, tmp_path):
    path = _write(tmp_path / "raw.csv", [_record(1, garage_name="two\nlines"), _record(2, garage_name="one")])
    good, rejects = land_raw_csv(spark, path, multi_line=True)
    assert {r["garage_name"] for r in good.collect()} == {"two\nlines", "one"} and rejects.count() == 0
    good, rejects = land_raw_csv(spark, path)  # a splittable file: the record is rejected, not shifted
    assert [r["garage_name"] for r in good.collect()] == ["one"] and rejects.count() == 2


def test_csv_is_parsed_once(spark, tmp_path):
    good, _ = land_raw_csv(spark, _write(tmp_path / "raw.csv", [_record(1)]), landed=str(tmp_path / "landed"))
    plan = good._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan and "FileScan csv" not in plan


def test_csv_headers_any_case(spark, tmp_path):
    header = [c.title() if i % 2 else c.upper() for i, c in enumerate(RAW_COLUMNS)]
    df = read_raw_csv(spark, _write(tmp_path / "upper.csv", [_record(1)], header))
    assert df.first()["job_id"] == 1


def test_csv_header_order_is_checked(spark, tmp_path):
    cols = list(RAW_COLUMNS)
    cols[0], cols[1] = cols[1], cols[0]
    with pytest.raises(Exception):
        read_raw_csv(spark, _write(tmp_path / "swapped.csv", [_record(1)], cols)).collect()


def test_parquet_and_table_sources(spark, tmp_path):
    raw = dirty_repairs(spark, SF_SMALL)
    path = str(tmp_path / "raw")
    raw.write.parquet(path)
    stored = read_raw_parquet(spark, path)
    assert stored.count() == raw.count() and stored.schema == RAW_SCHEMA
    assert "ReadSchema: struct<job_id:bigint>" in stored.select("job_id")._jdf.queryExecution().executedPlan().toString()
    # a table with its columns in another order and one more
    stored.select(F.lit(1).alias("loaded"), *reversed(RAW_COLUMNS)).createOrReplaceTempView("raw_reordered")
    named = read_raw_table(spark, "raw_reordered")
    assert named.columns == RAW_COLUMNS and named.exceptAll(stored).count() == 0


def _seed_dir(tmp_path, **extra):
    for column in MAPPED_COLUMNS:
        with open(tmp_path / f"{column}_mapping.csv", "w", newline="", encoding="utf-8") as fh:
            writer = csv.writer(fh)
            writer.writerow(["raw_value", "clean_value"])
            writer.writerows([*seed_rows(column), *extra.get(column, [])])
    return str(tmp_path)


def test_seed_folder_of_any_length_with_repeated_keys(spark, tmp_path):
    long = [(f"code {i}", f"clean {i}") for i in range(20_000)]
    extra = {"garage_type": [("", "Blank"), ("", "Blank"), ('Say "hi", Ltd', "Quoted"), ("Chain", "Chain")],
             "glass_type": long}
    seeds = load_seeds(spark, _seed_dir(tmp_path, **extra))
    assert seeds["glass_type"].count() == len(seed_rows("glass_type")) + 20_000
    rows = [("code 19999", "chain"), ("nothing", 'say "hi", ltd'), (None, None)]
    df = spark.createDataFrame(rows, "glass_type string, garage_type string")
    got = map_codes(df, seeds, ["glass_type", "garage_type"]).select("_mapped_glass_type", "_mapped_garage_type")
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(
        map(str, [("clean 19999", "Chain"), ("clean 19999", "Chain"), (None, "Quoted"), (None, None)])
    )
    report = {(r["column_name"], r["key"]): (r["n_values"], r["n_rows"]) for r in repeated_keys(seeds).collect()}
    assert report[("garage_type", "CHAIN")] == (1, 2)


def test_large_seed_is_joined_by_shuffle(spark):
    seed = {"damage_type": inline_seed(spark, [("chip", "Chip"), ("chip", "Chipped"), (None, "x")])}
    df = spark.createDataFrame([("Chip ",), ("dent",), (None,)], "damage_type string")
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    for k in keys:
        spark.conf.set(k, "-1")
    try:
        out = map_codes(df, seed, ["damage_type"], max_bytes=0)
        assert "SortMergeJoin" in out._jdf.queryExecution().executedPlan().toString()
        assert sorted(str(r["_mapped_damage_type"]) for r in out.collect()) == ["Chip", "Chipped", "None", "None"]
    finally:
        for k in keys:
            spark.conf.unset(k)
