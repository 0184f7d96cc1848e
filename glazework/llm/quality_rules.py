"""Host-level quality rules (operator 1). DataFrame functions only.

Each document gets four base counts from its whole text. A document fails a rule
when the rule's condition holds; failures are summed by host, each host's
failure rate is shrunk towards the corpus by a beta prior fitted to the hosts
(method of moments), and a host whose shrunk rate of any rule passes the limit
is rejected. Host verdicts are joined back to the documents.

Defined results: a null or blank text has no words (all counts 0) and fails
the base rules; repeated rows each count; a null host is one host of its own;
an empty table gives no rows. Other columns of the input stay as they are; an
input column that has the name of a result column is replaced by it.

Scale: the texts are read once. The counts are a narrow projection, written to
the shared folder; the host sums combine map-side, so a host with a third of
all rows ships one row per task. The join back leaves the strategy to the
planner, which knows the size of the written host table: a small one is broadcast,
a large one is shuffled, where AQE splits the partition of a hot host.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, SPACE_CHARS, stored, word_array

#: Characters counted as symbols (fixed by the contract).
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PCT = 50
#: Host-level rules beside the two base rules: symbols per 100 words, duplicate lines per 100 words.
MAX_SYMBOL_PCT = 10
MAX_DUP_LINE_PCT = 10
#: A host is rejected when its shrunk failure rate of any rule is over this.
HOST_LIMIT = 0.5
#: Bounds of the prior's weight, in documents.
PRIOR_WEIGHT = (10.0, 1000.0)
RULES = ("short", "repeats", "symbols", "dup_lines")
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _without(text: Column, chars: str) -> Column:
    return F.translate(text, chars, "")


def base_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the five counts (long) of each whole text.

    Every intermediate array is a column of its own projection that the next
    step refers to more than once, so none is evaluated twice. Linear in the
    text, but for the sort of window positions in texts with a repeated window.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.btrim(x, F.lit(SPACE_CHARS))) > 0)
    out = docs.withColumns({
        "_words": word_array(text),
        "_lines": lines,
        "word_chars": F.length(_without(text, SPACE_CHARS)).cast("long"),
        "n_symbols": (F.length(text) - F.length(_without(text, SYMBOLS))).cast("long"),
    })
    out = out.withColumns({
        "n_words": F.size("_words").cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        # the 3-word windows; words hold no space, so the joined text is exact
        "_tri": F.when(
            F.size("_words") >= 3,
            F.transform(
                F.slice("_words", F.lit(1), F.size("_words") - 2),
                lambda w, i: F.concat_ws(" ", w, F.get("_words", i + 1), F.get("_words", i + 2)),
            ),
        ),
    }).drop("_words", "_lines")
    # only texts with a repeated window sort (window, position)
    some = F.size(F.array_distinct("_tri")) < F.size("_tri")
    out = out.withColumn(
        "_sorted",
        F.when(some, F.sort_array(F.transform("_tri", lambda t, i: F.struct(t.alias("t"), i.alias("i"))))),
    ).drop("_tri")
    twice = F.filter(
        F.transform(
            "_sorted",
            lambda x, j: F.when(
                (x.t == F.get("_sorted", j + 1).t) | ((j > 0) & (x.t == F.get("_sorted", j - 1).t)), x.i
            ),
        ),
        lambda i: i.isNotNull(),
    )
    out = out.withColumn("_at", F.sort_array(twice)).drop("_sorted")
    # a window covers three words; overlap with the next repeated window counts once
    covered = F.aggregate(
        F.transform("_at", lambda p, j: F.least(F.lit(3), F.coalesce(F.get("_at", j + 1) - p, F.lit(3)))),
        F.lit(0).cast("long"),
        lambda s, x: s + x,
    )
    return out.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long"))).drop("_at")


def rule_failures() -> dict[str, Column]:
    """Boolean column of each rule, over the counts."""
    n = F.col("n_words")
    return {
        "short": n < MIN_WORDS,
        "repeats": 100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * n,
        "symbols": 100 * F.col("n_symbols") > MAX_SYMBOL_PCT * n,
        "dup_lines": 100 * F.col("n_dup_lines") > MAX_DUP_LINE_PCT * n,
    }


def host_verdicts(counted: DataFrame, host_col: str = "source", limit: float = HOST_LIMIT) -> DataFrame:
    """(host, n_docs, rate_<rule>, host_rejected) from documents with counts.

    Prior per rule: with m the failure rate of all documents and v the variance
    of the hosts' rates (weighted by documents), the weight m(1-m)/v - 1, held within
    ``PRIOR_WEIGHT``; a rate is (failures + m * weight) / (documents + weight).
    """
    sums = stored(
        counted.groupBy(F.col(host_col).alias("host")).agg(
            F.count(F.lit(1)).alias("n_docs"),
            *[F.sum(bad.cast("long")).alias(f"f_{rule}") for rule, bad in rule_failures().items()],
        ),
        "hosts",
    )
    long = sums.select(
        "host",
        "n_docs",
        F.explode(
            F.array(*[F.struct(F.lit(r).alias("rule"), F.col(f"f_{r}").alias("f")) for r in RULES])
        ).alias("x"),
    ).select("host", "n_docs", "x.rule", "x.f")
    # moments from sums of whole numbers and of f*f/n: one row per rule
    moments = long.groupBy("rule").agg(
        F.sum("n_docs").alias("n"),
        F.sum("f").alias("f_all"),
        F.sum(F.col("f") * F.col("f") / F.col("n_docs")).alias("ff"),
    )
    m = F.col("f_all") / F.col("n")
    v = F.col("ff") / F.col("n") - m * m
    weight = F.when(v > 1e-12, m * (1 - m) / v - 1).otherwise(F.lit(PRIOR_WEIGHT[1]))
    weight = F.greatest(F.lit(PRIOR_WEIGHT[0]), F.least(F.lit(PRIOR_WEIGHT[1]), weight))
    prior = moments.select("rule", m.alias("m"), weight.alias("w"))
    rate = (F.col("f") + F.col("m") * F.col("w")) / (F.col("n_docs") + F.col("w"))
    # one row per rule: four rows at most
    return (
        long.join(F.broadcast(prior), "rule")
        .groupBy("host", "n_docs")
        .agg(
            *[F.max(F.when(F.col("rule") == r, rate)).alias(f"rate_{r}") for r in RULES],
            F.max(rate > limit).alias("host_rejected"),
        )
    )


def quality_rules(
    docs: DataFrame, host_col: str = "source", text_col: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """Documents with the counts, ``base_failed``, ``host_rejected`` and ``kept``.

    ``keep``: the input columns to carry (all by default); leave the text out
    where only the verdict is wanted, as the counted rows are written once.
    """
    results = (*COUNTS, "base_failed", "host_rejected", "kept")
    carry = [c for c in (keep if keep is not None else docs.columns) if c not in results]
    # the carried columns travel in one struct, so no name of theirs meets a working column
    plain = docs.select(
        F.struct(*carry).alias("_row"), F.col(host_col).alias("_host"), F.col(text_col).alias("_text")
    )
    counted = stored(base_counts(plain, "_text").drop("_text"), "quality")
    rejected = stored(
        host_verdicts(counted, "_host").where("host_rejected").select(F.col("host").alias("_bad_host")),
        "rejected-hosts",
    )
    n, r = F.col("n_words"), F.col("n_repeat_words")
    out = counted.join(
        rejected.withColumn("_bad", F.lit(True)), counted["_host"].eqNullSafe(rejected["_bad_host"]), "left"
    )
    out = out.withColumns({
        "base_failed": (n < MIN_WORDS) | (100 * r > MAX_REPEAT_PCT * n),
        "host_rejected": F.coalesce(F.col("_bad"), F.lit(False)),
    }).withColumn("kept", ~F.col("base_failed") & ~F.col("host_rejected"))
    return out.select("_row.*", *results)


def oracle() -> str:
    """The query's rows in DuckDB SQL."""
    blank = f"'{SPACE}+'"
    return f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT rid, list_filter(string_split_regex(text, {blank}), lambda x: x <> '') AS ws FROM d
), pos AS (
  SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) >= 3
), tri AS (
  SELECT rid, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS t FROM pos
), rep AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, t) AS n FROM tri) WHERE n > 1
), cov AS (
  SELECT rid, count(DISTINCT j) AS n FROM (SELECT rid, i + unnest([0, 1, 2]) AS j FROM rep) GROUP BY rid
), ln AS (
  SELECT rid, unnest(string_split(text, chr(10))) AS l FROM d
), lines AS (
  SELECT rid, count(*) - count(DISTINCT l) AS n FROM ln
  WHERE length(regexp_replace(l, {blank}, '', 'g')) > 0 GROUP BY rid
), c AS (
  SELECT d.doc_id, d.source, len(w.ws)::BIGINT AS n_words,
         length(regexp_replace(d.text, {blank}, '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(d.text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         coalesce(lines.n, 0)::BIGINT AS n_dup_lines, coalesce(cov.n, 0)::BIGINT AS n_repeat_words
  FROM d JOIN w USING (rid) LEFT JOIN lines USING (rid) LEFT JOIN cov USING (rid)
), h AS (
  SELECT source, count(*) AS n,
         [sum((n_words < {MIN_WORDS})::INT), sum((100 * n_repeat_words > {MAX_REPEAT_PCT} * n_words)::INT),
          sum((100 * n_symbols > {MAX_SYMBOL_PCT} * n_words)::INT),
          sum((100 * n_dup_lines > {MAX_DUP_LINE_PCT} * n_words)::INT)] AS fs
  FROM c GROUP BY source
), hr AS (SELECT source, n, unnest([1, 2, 3, 4]) AS rule, unnest(fs)::DOUBLE AS f FROM h
), mo AS (
  SELECT rule, sum(f) / sum(n) AS m, sum(f * f / n) / sum(n) - (sum(f) / sum(n)) ** 2 AS v FROM hr GROUP BY rule
), pr AS (
  SELECT rule, m, greatest({PRIOR_WEIGHT[0]}, least({PRIOR_WEIGHT[1]},
         CASE WHEN v > 1e-12 THEN m * (1 - m) / v - 1 ELSE {PRIOR_WEIGHT[1]} END)) AS w FROM mo
), bad AS (
  SELECT source, max((f + m * w) / (n + w)) > {HOST_LIMIT} AS b FROM hr JOIN pr USING (rule) GROUP BY source
), v AS (
  SELECT c.*, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PCT} * n_words AS base_failed,
         bad.b AS host_rejected
  FROM c JOIN bad ON c.source IS NOT DISTINCT FROM bad.source
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       host_rejected, NOT base_failed AND NOT host_rejected AS kept
FROM v
"""
