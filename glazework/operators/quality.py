"""Q-01 … Q-05: data tests on staging. Each violation query returns the offending rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from glazework import constants as K


def _rows_of(candidates: list[Column]) -> Column:
    """Explode the non-NULL entries of an array built per row (one pass, no shuffle)."""
    return F.explode(F.filter(F.array(*candidates), lambda x: x.isNotNull()))


def _unmapped(column: str) -> Column:
    c = F.col(column)
    return ~c.isin(K.ALLOWED_VALUES[column]) & c.isNotNull()


def _not_boolean(column: str) -> Column:
    """Neither TRUE nor FALSE nor NULL; on a text column, any text but these two words."""
    c = F.lower(F.col(column).cast("string"))
    return ~c.isin("true", "false") & c.isNotNull()


def not_null_violations(staging: DataFrame) -> DataFrame:
    """Q-01: one row per (test, job) where a not-null column is NULL."""
    candidates = [
        F.when(F.col(c).isNull(), F.struct(F.lit(f"not_null_{c}").alias("test_name"), F.lit(sev).alias("severity")))
        for c, sev in K.NOT_NULL_TESTS
    ]
    return staging.select("job_id", _rows_of(candidates).alias("t")).select("t.test_name", "t.severity", "job_id")


def unique_violations(staging: DataFrame, column: str = "job_id") -> DataFrame:
    """Q-02: non-NULL values seen more than once, with their count."""
    return (
        staging.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_records"))
        .where(F.col("n_records") > 1)
    )


def unmapped_violations(staging: DataFrame) -> DataFrame:
    """Q-03: one row per mapped value outside its allowed list (NULL is allowed)."""
    candidates = [
        F.when(_unmapped(c), F.struct(F.lit(c).alias("column_name"), F.col(c).alias("unmapped_value")))
        for c in K.ALLOWED_VALUES
    ]
    return staging.select(_rows_of(candidates).alias("t")).select("t.column_name", "t.unmapped_value")


def boolean_violations(staging: DataFrame, column: str = "insurance_claimed") -> DataFrame:
    """Q-04: the rows whose ``column`` is neither TRUE nor FALSE nor NULL, all columns.

    None on a column that is boolean already; useful on the raw text column.
    """
    return staging.where(_not_boolean(column))


def _test_catalogue() -> list[tuple[str, str, str, Column]]:
    """(test_name, column, severity, violation condition) for the row-level tests."""
    tests = [(f"not_null_{c}", c, sev, F.col(c).isNull()) for c, sev in K.NOT_NULL_TESTS]
    tests += [(f"unmapped_values_{c}", c, "error", _unmapped(c)) for c in K.ALLOWED_VALUES]
    tests.append(("valid_boolean_insurance_claimed", "insurance_claimed", "error", _not_boolean("insurance_claimed")))
    return tests


def _as_rows(one_row: DataFrame, tests: list[tuple[str, str, str]]) -> DataFrame:
    structs = [
        F.struct(
            F.lit(name).alias("test_name"),
            F.lit(column).alias("column_name"),
            F.lit(sev).alias("severity"),
            F.col(name).cast("bigint").alias("failures"),
        )
        for name, column, sev in tests
    ]
    return one_row.select(F.inline(F.array(*structs)))


def row_test_counts() -> list[Column]:
    """The failure count of each of the fourteen row-level tests, as aggregates over staging rows."""
    return [F.count_if(cond).alias(name) for name, _, _, cond in _test_catalogue()]


def observe_row_tests(staging: DataFrame, seen: Observation) -> DataFrame:
    """``staging`` with the row-level tests counted in passing, when it is written.

    The counts come with the finished tasks of the writing stage, so a task that is tried again counts once.
    The counting must be the last step before the write: a stage that only shuffles may count a lost task twice.
    """
    return staging.observe(seen, *row_test_counts())


def quality_summary(
    staging: DataFrame,
    observed: dict[str, int] | None = None,
    repeated: DataFrame | None = None,
    severities: dict[str, str] | None = None,
) -> DataFrame:
    """Q-05: all 15 tests with their failure counts and a pass / warn / fail status.

    Fourteen row-level tests are conditional counts in one global aggregate
    (map-side partial counts, no shuffle of rows), or taken from ``observed``, the counts made while the table was
    written, which reads no row. The uniqueness test is one group-by on the id alone, or the rows
    of ``repeated`` (see ``repeated_ids``). Severity ``warn`` reports without failing; ``severities`` sets it by test name.
    """
    severity = severities or {}
    unknown = set(severity) - {"unique_job_id", *(t[0] for t in _test_catalogue())}
    if unknown or set(severity.values()) - {"warn", "error"}:
        raise ValueError(f"no such tests or severities: {sorted(unknown) or severity}")
    tests = [(n, c, severity.get(n, s)) for n, c, s, _ in _test_catalogue()]
    if observed is None:
        counts = staging.agg(*row_test_counts())
    else:
        counts = staging.sparkSession.range(1).select(*[F.lit(observed[n]).alias(n) for n, _, _ in tests])
    row_level = _as_rows(counts, tests)
    again = repeated if repeated is not None else unique_violations(staging)
    dupes = again.agg(F.count(F.lit(1)).alias("unique_job_id"))
    unique = _as_rows(dupes, [("unique_job_id", "job_id", severity.get("unique_job_id", "error"))])
    summary = row_level.unionByName(unique)
    status = (
        F.when(F.col("failures") == 0, F.lit("pass"))
        .when(F.col("severity") == "warn", F.lit("warn"))
        .otherwise(F.lit("fail"))
    )
    return summary.withColumn("status", status)
