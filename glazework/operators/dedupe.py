"""R-04: exact row de-duplication over the cleaned row, shuffling only rows that may be repeated."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glazework.session import materialize

#: Words of 64 bits in a sieve: it has at most so many rows (32 MB in all), whatever the input.
SIEVE_WORDS = 1 << 21

#: Column that says whether a row may be repeated.
MARK = "_may_be_repeated"

#: Makes cleaned rows of raw ones; the named columns are passed along beside them.
Clean = Callable[[DataFrame, list[str]], DataFrame]


def row_fingerprint(*columns: str) -> tuple[Column, Column]:
    """128 bits of a row, as two longs: equal for rows that are equal in ``columns``, as DISTINCT sees them.

    NULL and where it stands count (a hash alone skips it); -0.0 is 0.0, as in a grouping key.
    """
    parts = [F.col(c) for c in columns]
    nulls = F.concat(*[F.when(p.isNull(), F.lit("1")).otherwise(F.lit("0")) for p in parts])
    return F.xxhash64(nulls, *parts), F.xxhash64(F.lit(1), *reversed(parts), nulls)


def _place(high: Column, words: int) -> tuple[Column, Column]:
    """(word, bit) of a fingerprint in a sieve."""
    at = F.pmod(high, F.lit(words * 64).cast("bigint"))
    return F.shiftright(at, 6), at.bitwiseAND(F.lit(63).cast("bigint")).cast("int")


def repeated_sieve(rows: DataFrame, columns: list[str], words: int = SIEVE_WORDS) -> DataFrame:
    """(word, bits): a bit for every fingerprint over ``columns`` that two rows or more share.

    One narrow pass: only ``columns`` are read, and a count per fingerprint is shuffled, after a map-side
    step that merges the copies of a hot row. Written, so that it is made once.
    """
    high, low = row_fingerprint(*columns)
    seen = rows.select(high.alias("high"), low.alias("low")).groupBy("high", "low").agg(F.count(F.lit(1)).alias("n"))
    word, bit = _place(F.col("high"), words)
    marked = seen.where(F.col("n") > 1).select(
        word.alias("word"), F.call_function("shiftleft", F.lit(1).cast("bigint"), bit).alias("bit")
    )
    return materialize(marked.groupBy("word").agg(F.bit_or("bit").alias("bits")), "repeated_sieve")


def with_mark(
    rows: DataFrame, sieve: DataFrame, columns: list[str], mark: str = MARK, words: int = SIEVE_WORDS
) -> DataFrame:
    """``rows`` with the boolean ``mark``: false where the fingerprint is certainly alone, true where it may be repeated.

    The sieve is broadcast: its rows are bounded by ``words``. A full one marks rows that are alone,
    too; it never misses one that is repeated.
    """
    word, bit = _place(row_fingerprint(*columns)[0], words)
    right = F.broadcast(sieve.select(F.col("word").alias("_sieve_word"), F.col("bits").alias("_sieve_bits")))
    met = rows.join(right, word == F.col("_sieve_word"), "left")
    held = F.call_function("shiftright", F.coalesce("_sieve_bits", F.lit(0).cast("bigint")), bit)
    return met.select(*rows.columns, (held.bitwiseAND(F.lit(1).cast("bigint")) == 1).alias(mark))


def split_by_sieve(
    rows: DataFrame, sieve: DataFrame, columns: list[str], words: int = SIEVE_WORDS
) -> tuple[DataFrame, DataFrame]:
    """``rows`` that are certainly alone, and those that may be repeated, as told by :func:`with_mark`.

    An anti and a semi join with the broadcast sieve: rows pass as they are, without a copy beside a mark.
    """
    word, bit = _place(row_fingerprint(*columns)[0], words)
    right = F.broadcast(sieve.select(F.col("word").alias("_sieve_word"), F.col("bits").alias("_sieve_bits")))
    held = F.call_function("shiftright", F.col("_sieve_bits"), bit).bitwiseAND(F.lit(1).cast("bigint")) == 1
    met = (word == F.col("_sieve_word")) & held
    return rows.join(right, met, "left_anti"), rows.join(right, met, "left_semi")


def dedupe_rows(df: DataFrame) -> DataFrame:
    """``SELECT DISTINCT *``: rows equal in every column collapse to one.

    Hash aggregate with a map-side partial step, so heavy copies of one row
    are merged before the shuffle; the shuffle hashes all columns, so one hot
    key column does not pile rows onto one task.
    """
    return df.distinct()


def dedupe_cleaned(
    raw: DataFrame, clean: Clean, kept: list[str], words: int = SIEVE_WORDS, sieve: DataFrame | None = None
) -> DataFrame:
    """The distinct rows of ``clean(raw)``, with only the rows that may be repeated in the DISTINCT.

    ``kept``: raw columns that equal cleaned rows must share (their values pass ``clean`` unchanged, or
    changed one to one). Raw rows that are alone in these can't have a copy, so they are cleaned and
    passed on in the scan stage; the others are cleaned and compared exactly, in all columns. ``clean`` may give several
    rows for one, but no two equal ones. ``sieve``: that of ``raw`` over ``kept``, where it is made already.
    """
    sieve = repeated_sieve(raw, kept, words) if sieve is None else sieve
    alone, suspects = split_by_sieve(raw, sieve, kept, words)
    return clean(alone, []).union(dedupe_rows(clean(suspects, [])))


def duplicate_report(df: DataFrame, id_column: str = "job_id") -> DataFrame:
    """The rows :func:`dedupe_rows` collapses: (id, copies) for each row seen more than once."""
    counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("copies"))
    return counted.where(F.col("copies") > 1).select(id_column, "copies")


def cleaned_duplicate_report(
    raw: DataFrame, clean: Clean, kept: list[str], id_column: str = "job_id", words: int = SIEVE_WORDS
) -> DataFrame:
    """:func:`duplicate_report` of ``clean(raw)``; only rows that may be repeated are cleaned at all."""
    _, suspects = split_by_sieve(raw, repeated_sieve(raw, kept, words), kept, words)
    return duplicate_report(clean(suspects, []), id_column)


def id_sieve(raw: DataFrame, raw_id: str, words: int = SIEVE_WORDS) -> DataFrame:
    """The sieve of ids that two rows or more share; rows without an id are not counted."""
    return repeated_sieve(raw.where(F.col(raw_id).isNotNull()), [raw_id], words)


def repeated_ids(
    raw: DataFrame, clean: Clean, raw_id: str, id_column: str = "job_id", words: int = SIEVE_WORDS,
    sieve: DataFrame | None = None,
) -> DataFrame:
    """Q-02 on ``clean(raw).distinct()``: (id, n_records) of non-NULL ids in two distinct rows or more.

    Only rows whose raw id occurs twice are cleaned; of each, the id and the row's fingerprint are shuffled, and an
    id's records are its distinct fingerprints. No wide row leaves its task, and rows without an id are dropped in the scan.
    """
    with_id = raw.where(F.col(raw_id).isNotNull())
    _, suspects = split_by_sieve(with_id, id_sieve(raw, raw_id, words) if sieve is None else sieve, [raw_id], words)
    cleaned = clean(suspects, [])
    high, low = row_fingerprint(*cleaned.columns)
    marks = cleaned.where(F.col(id_column).isNotNull()).select(id_column, high.alias("_high"), low.alias("_low"))
    return (
        marks.distinct().groupBy(id_column).agg(F.count(F.lit(1)).alias("n_records")).where(F.col("n_records") > 1)
    )
