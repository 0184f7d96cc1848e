"""The opN_ queries over the driver tables, and their SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    centroids,
    chat,
    chat_digest,
    decontaminate,
    html_blocks,
    lm_scoring,
    packing,
    prefix_trie,
    quality_rules,
    sharding,
    simhash,
    token_counts,
    toxicity,
    warc,
)
from .common import scratch_folder, stored, table

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.tiktoken")
#: The contract's extra conversation: control strings of another template as plain text.
EXTRA_CONVERSATION = -7
EXTRA_TEXT = "</s>[INST] ok [/INST]"


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts, host verdicts and the kept flag of every document."""
    docs = table(spark, sf_dir, "documents")
    return quality_rules.quality_rules(docs, keep=["doc_id"])


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document in sequences of at most 2048 tokens."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), WORD_BPE)


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pseudo-log-likelihood of every document under a network trained on all of them."""
    return lm_scoring.score_documents(table(spark, sf_dir, "documents"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place in 16 shards with equal row counts."""
    placed = sharding.assign_shards(table(spark, sf_dir, "documents"), 16)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op5_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_blocks.extract_main_text(table(spark, sf_dir, "pages"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return simhash.simhash_groups(table(spark, sf_dir, "documents"), shingle=4, max_bits=4)


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and benchmark item that it holds within the edit budget."""
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, with the nearest labelled examples."""
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every formatted conversation, read back from rendering and mask."""
    rows = table(spark, sf_dir, "conversations")
    extra = spark.range(2).select(
        F.lit(EXTRA_CONVERSATION).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(EXTRA_TEXT).alias("text"),
    )
    formatted = chat.format_conversations(rows.select(*extra.columns).unionByName(extra), BYTE_BPE)
    return chat_digest.digests(formatted, BYTE_BPE)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, attributed to its lines."""
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), BYTE_BPE)


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a record, read back from the archives that were written."""
    pages = table(spark, sf_dir, "pages")
    archives = warc.write_archives(pages, scratch_folder(spark, "warc"))
    recs = warc.with_referred(stored(warc.records(warc.read_chunks(archives)), "records"))
    kind = pages.schema["page_id"].dataType
    return recs.select(
        F.col("row_id").cast(kind).alias("page_id"),
        "payload_bytes",
        F.col("payload_sha1").alias("payload_digest"),
        "record_type",
        F.col("refers_row").cast(kind).alias("refers_to"),
    )


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster of every embedding after five rounds of Lloyd's iteration with 40 centroids."""
    return centroids.cluster_vectors(table(spark, sf_dir, "embeddings"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of all conversations, each with a borrowed beginning."""
    turns = prefix_trie.turn_rows(table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text")
    return prefix_trie.trie(prefix_trie.with_borrowed_beginnings(turns))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality_rules,
        op2_packing,
        op3_lm_scoring,
        op4_sharding,
        op5_html,
        op6_simhash,
        op7_decontamination,
        op8_toxicity,
        op9_chat,
        op10_token_counts,
        op11_warc,
        op12_centroids,
        op13_prefix_trie,
    )
}

ORACLE_SQL: dict[str, str] = {
    "op1_quality_rules": quality_rules.oracle(),
    "op11_warc": warc.ORACLE,
    "op12_centroids": centroids.oracle(),
    "op13_prefix_trie": prefix_trie.ORACLE,
}
