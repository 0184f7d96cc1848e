"""Every registered query against its DuckDB SQL on the same driver tables (sf0.001)."""

import pytest

import __spark_entry__ as entry
from checks.compare import compare, duck
from checks.duckdb_sql import oracle_queries
from checks.registry import registry
from tests.conftest import SF_SMALL

QUERIES = registry()
SQL = oracle_queries()
# rows that are there on both sides: an empty result would prove nothing
EMPTY = {"dq_valid_boolean_staging"}


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, SF_SMALL, name, QUERIES[name], SQL[name])
    assert r["rows"][0] == r["rows"][1], r
    assert (r["rows"][0] == 0) == (name in EMPTY), r
    assert r["columns_match"], r
    assert r["types_match"], r
    assert r["values_match"], r["detail"]


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "garage_key"


def test_every_data_test_fires(spark):
    rows = QUERIES["dq_summary"](spark, SF_SMALL).collect()
    failing = {r["test_name"] for r in rows if r["failures"] > 0}
    assert {f"not_null_{c}" for c in ("job_id", "customer_id", "technician_id", "repair_date", "customer_email")} <= failing
    assert "unique_job_id" in failing


def test_entry_without_the_optional_subpackage():
    """The other queries import and run where the optional subpackage and its pipeline are gone."""
    import subprocess
    import sys

    code = (
        "import sys\n"
        "class Gone:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name == 'corpus_pipeline' or name.startswith('glazework.llm'):\n"
        "            raise ModuleNotFoundError(name, name=name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "assert e.queries() and set(e.queries()) == set(e.oracle_sql()), 'queries'\n"
    )
    root = __import__("os").path.dirname(entry.__file__)
    subprocess.run([sys.executable, "-c", code], check=True, cwd=root)
