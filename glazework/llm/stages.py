"""The stages of the corpus pipeline: each takes (spark, docs, sf_dir).

Every stage works on all its predecessor kept. All but the last return the columns of their
input, a subset of its rows; repeated rows stay repeated but for the near-duplicate
stage, which keeps one row of each group.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, packing, quality_rules, simhash, toxicity
from .common import stored, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that operator 8 predicts toxic."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that operator 1 rejects, by the base rules or by their host.

    The rows travel whole in a struct, so columns named like the operator's results stay as they are.
    """
    whole = docs.select(F.struct(*docs.columns).alias("_whole"), "source", "text")
    return quality_rules.quality_rules(whole, keep=["_whole"]).where("kept").select("_whole.*")


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash group (operator 6), the row with the smallest id, then the smallest text hash.

    A null id is chosen only where all ids of the group are null. One row stays for each group, whatever ids
    the groups share. They are found on ids, text hashes and fingerprints; the texts move once, to
    meet the chosen rows. Rows that repeat both id and text are merged map-side, and apart from the others: of
    rows that differ in other columns only, the one that stays is smallest as JSON text (null fields left out).
    """
    named = docs.select("doc_id", "text", F.xxhash64("text").alias("_hash"))
    prints = simhash.with_fingerprints(named, ["doc_id", "_hash"])
    rows = prints.groupBy("_fp", "doc_id", "_hash").agg(F.count(F.lit(1)).alias("_rows"))
    first = F.struct(F.isnull("doc_id").alias("_null"), F.col("doc_id").alias("_doc"), "_hash", "_rows")
    nodes = stored(rows.groupBy("_fp").agg(F.min(first).alias("_first")), "nodes")
    roots = simhash.with_roots(nodes)
    chosen = stored(roots.groupBy("_root").agg(F.min("_first").alias("_first")).select("_first.*"), "kept-rows")

    def rows_of(picked: DataFrame) -> DataFrame:
        same = docs["doc_id"].eqNullSafe(picked["_doc"]) & (F.xxhash64(docs["text"]) == picked["_hash"])
        return docs.join(picked, same, "left_semi")

    kept = rows_of(chosen.where("_rows = 1"))
    repeated = chosen.where("_rows > 1")
    if repeated.isEmpty():
        return kept
    whole = F.struct(*docs.columns)
    others = F.struct(*[c for c in docs.columns if c != "text"])
    one = rows_of(repeated).groupBy("doc_id", F.xxhash64("text")).agg(F.min_by(whole, F.to_json(others)).alias("_one"))
    return kept.unionByName(one.select("_one.*"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents in which operator 7 finds a benchmark item."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of operator 2's sequences."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))
