"""Shared pieces of the training-data operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glazework.session import _delete_at_exit, materialize, work_dir

#: Java regex of the white space between words; a word is ``[^\x20\x09-\x0D]+``.
SPACE = "[\\x20\\x09-\\x0D]"
SPACE_CHARS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table by name; only Spark's reader opens it, so any store works."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared work folder and read back (cuts the lineage)."""
    return materialize(df, f"llm-{name}")


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder in the shared work folder, removed when the session ends."""
    path = f"{work_dir(spark)}/glazework/llm-{name}-{uuid.uuid4().hex}"
    _delete_at_exit(spark, path)
    return path


def word_array(text: Column) -> Column:
    """The words of a text as an array; empty for null and for white space only."""
    trimmed = F.btrim(text, F.lit(SPACE_CHARS))
    return F.when(F.length(trimmed) > 0, F.split(trimmed, f"{SPACE}+")).otherwise(
        F.array().cast("array<string>")
    )
