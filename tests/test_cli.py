"""The command line: run publishes every table; test fails on error-severity failures only."""

import pytest

from checks.fixture import dirty_repairs
from glazework.__main__ import main
from glazework.plans import published
from glazework.sources import write_raw_csv
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def raw_csv(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("cli") / "raw")
    write_raw_csv(dirty_repairs(spark, SF_SMALL), path)
    return path


def test_cli_test_reports_and_fails(spark, raw_csv, capsys):
    code = main(["test", "--raw-csv", raw_csv])
    out = capsys.readouterr().out
    assert code == 1
    assert "warn" in out and "not_null_customer_email" in out
    assert len([line for line in out.splitlines() if line.strip()]) == 15


def test_cli_run_publishes_and_test_reads_it(spark, raw_csv, tmp_path, capsys):
    out = str(tmp_path)
    assert main(["run", "--raw-csv", raw_csv, "--out", out]) == 0
    names = {line.split("\t")[0] for line in capsys.readouterr().out.splitlines()}
    assert "fact_repairs" in names and "dim_date" in names and len(names) == 9
    assert published(spark, out, "fact_repairs").count() == 1515
    assert main(["test", "--out", out]) == 1
    from_published = capsys.readouterr().out
    main(["test", "--raw-csv", raw_csv])
    assert from_published == capsys.readouterr().out


def test_cli_run_by_table_name_into_a_schema(spark, tmp_path):
    dirty_repairs(spark, SF_SMALL).createOrReplaceTempView("raw_by_name")
    spark.sql("CREATE SCHEMA IF NOT EXISTS marts_test")
    assert main(["run", "--raw-table", "raw_by_name", "--out", str(tmp_path), "--schema", "marts_test"]) == 0
    assert spark.table("marts_test.fact_repairs").count() == 1515
    spark.sql("DROP SCHEMA marts_test CASCADE")
