"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again.

Toxic documents go first, then what the quality rules reject, then all but one
document of each group of near copies, then documents that hold a benchmark
passage; what is left is packed into training sequences.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from glazework.llm import stages
from glazework.llm.common import stored, table

#: (name, function) in running order; a function takes (spark, docs, sf_dir).
STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", stages.drop_toxic),
    ("quality_rules", stages.drop_low_quality),
    ("simhash_near_dedup", stages.keep_one_of_each_group),
    ("decontamination", stages.drop_contaminated),
    ("packing", stages.pack),
]

#: Nearest-neighbour scores, edit distances and subword ids are beyond SQL; the
#: pipeline is tested against a brute-force version instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to the ``documents`` table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
