"""S-01 / S-02: the raw repairs table (30 columns) and its readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glazework.session import materialize

_S, _L, _I, _D = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()

# Column order of the source file.
RAW_SCHEMA = T.StructType(
    [
        T.StructField("job_id", _L),
        T.StructField("repair_date", _S),
        T.StructField("region", _S),
        T.StructField("city", _S),
        T.StructField("garage_name", _S),
        T.StructField("garage_type", _S),
        T.StructField("vehicle_brand", _S),
        T.StructField("vehicle_type", _S),
        T.StructField("vehicle_model", _S),
        T.StructField("glass_type", _S),
        T.StructField("window_position", _S),
        T.StructField("damage_type", _S),
        T.StructField("repair_type", _S),
        T.StructField("repair_cost", _S),
        T.StructField("glass_cost", _S),
        T.StructField("profit", _S),
        T.StructField("customer_rating", _S),
        T.StructField("customer_name", _S),
        T.StructField("customer_email", _S),
        T.StructField("customer_mobile", _S),
        T.StructField("customer_postcode", _S),
        T.StructField("insurance_claimed", _S),
        T.StructField("technician_id", _L),
        T.StructField("technician_name", _S),
        T.StructField("technician_mobile", _S),
        T.StructField("customer_id", _L),
        T.StructField("vehicle_age_in_years", _I),
        T.StructField("weather_condition", _S),
        T.StructField("traffic_level", _S),
        T.StructField("job_duration_in_hours", _D),
    ]
)
RAW_COLUMNS = [f.name for f in RAW_SCHEMA.fields]


#: Holds the text of a CSV record that doesn't fit the schema; NULL for a good one.
REJECT_COLUMN = "_corrupt_record"


def read_raw_csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """S-02: header CSV, UTF-8, explicit schema (no inference pass); empty → NULL.

    Quoted fields follow RFC 4180: a doubled quote is a quote, a backslash is a
    backslash. ``multi_line`` lets a quoted field hold line ends; it is off by default, as
    such files can't be split over tasks (a record with a line end is then rejected).

    A record with a field too many or too few, or with text where a number
    belongs, is kept: its text is in the column ``_corrupt_record``, which is NULL
    for good records. :func:`land_raw_csv` takes the two apart.

    The header is checked against the schema, position by position and
    ignoring case (``Job_ID`` / ``Repair_Date`` load into the lower-case
    schema); a file whose columns are in another order fails instead of
    loading shifted values.
    """
    return (
        spark.read.option("header", True)
        .option("encoding", "UTF-8")
        .option("mode", "PERMISSIVE")
        .option("enforceSchema", False)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("columnNameOfCorruptRecord", REJECT_COLUMN)
        .schema(T.StructType([*RAW_SCHEMA.fields, T.StructField(REJECT_COLUMN, _S)]))
        .csv(path)
    )


def land_raw_csv(
    spark: SparkSession, path: str, landed: str | None = None, multi_line: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(raw rows, rejected records) of a CSV, which is parsed once.

    Everything is written to ``landed`` (by default a folder of the session's work folder) as
    Parquet, good rows and rejects side by side; both results, and all later scans, read that.
    """
    table = materialize(read_raw_csv(spark, path, multi_line), "landed", path=landed)
    good = table.where(F.col(REJECT_COLUMN).isNull()).select(*RAW_COLUMNS)
    return good, table.where(F.col(REJECT_COLUMN).isNotNull()).select(REJECT_COLUMN)


def read_raw_table(spark: SparkSession, name: str) -> DataFrame:
    """S-01: the raw table by its catalog name; column order and extra columns don't matter."""
    table = spark.table(name)
    return table.select(*[table[f.name].cast(f.dataType).alias(f.name) for f in RAW_SCHEMA.fields])


def read_raw_parquet(spark: SparkSession, path: str) -> DataFrame:
    """S-01: the raw table stored as Parquet (scan prunes to the columns used)."""
    return spark.read.schema(RAW_SCHEMA).parquet(path)


def write_raw_csv(df: DataFrame, path: str) -> None:
    """Write a raw table the way the source system ships it (header, NULL → empty).

    Padding is part of the dirt, so the writer must not trim (Spark's CSV
    writer trims by default); an empty string is written
    as ``""`` (the reader, like the source's loader, takes empty as NULL).
    """
    (
        df.select(*RAW_COLUMNS)
        .write.mode("overwrite")
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("escape", '"')
        .csv(path)
    )
