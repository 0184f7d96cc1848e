"""R-08 / E-12 … E-15: the daily date spine and the calendar dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glazework import constants as K
from glazework.functions.dates import date_key, day_name, day_of_week, is_weekend, month_name


def date_spine(
    spark: SparkSession, start: str = K.DATE_SPINE_START, end_exclusive: str = K.DATE_SPINE_END_EXCLUSIVE
) -> DataFrame:
    """One row per day from ``start`` up to, not including, ``end_exclusive``."""
    first = F.to_date(F.lit(start))
    last = F.date_sub(F.to_date(F.lit(end_exclusive)), 1)
    return spark.range(1).select(F.explode(F.sequence(first, last, F.expr("INTERVAL 1 DAY"))).alias("date_day"))


def dim_date(spark: SparkSession) -> DataFrame:
    """Calendar dimension keyed by the yyyymmdd integer."""
    d = F.col("date_day")
    return date_spine(spark).select(
        date_key(d).alias("date_key"),
        d.alias("full_date"),
        F.year(d).cast("bigint").alias("year"),
        F.quarter(d).cast("bigint").alias("quarter"),
        F.month(d).cast("bigint").alias("month"),
        month_name(d).alias("month_name"),
        day_of_week(d).alias("day_of_week"),
        day_name(d).alias("day_name"),
        is_weekend(d).alias("is_weekend"),
    )
