"""Operator 1 against plain Python and DuckDB."""

import random
import re
from collections import Counter

import duckdb

from glazework.llm import quality_rules as Q
from glazework.llm.queries import ORACLE_SQL, QUERIES
from tests.conftest import SF_SMALL
from tests.llm.conftest import ODD


def counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    many = Counter(windows)
    covered = {j for i, w in enumerate(windows) if many[w] > 1 for j in (i, i + 1, i + 2)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def test_counts_by_brute_force(spark, documents):
    rng = random.Random(1)
    texts = ODD + [
        "".join(rng.choice(["a", "b", "c", " ", " ", "\n", "\t", "#", "<"]) for _ in range(rng.randrange(200)))
        for _ in range(150)
    ]
    out = Q.quality_rules(documents(texts)).collect()
    assert len(out) == len(texts)
    for r in out:
        assert tuple(r[c] for c in Q.COUNTS) == counts(texts[r["doc_id"]]), texts[r["doc_id"]]


def test_host_verdicts(spark, documents):
    good = " ".join(f"w{i}" for i in range(60))
    bad = " ".join(f"w{i} #*" for i in range(60))
    texts = [good] * 40 + [bad] * 30 + [good] * 10 + [bad]
    sources = {i: "bad" for i in range(40, 70)} | {i: "bad" for i in range(70, 75)} | {80: "one"} | {0: None}
    out = {r["doc_id"]: r for r in Q.quality_rules(documents(texts, sources)).collect()}
    assert all(out[i]["host_rejected"] and not out[i]["kept"] for i in range(40, 75))  # good pages of a bad host too
    assert all(out[i]["kept"] for i in [0, *range(1, 40), *range(75, 80)])
    # one failed page is not evidence enough against a host: the prior holds its rate back
    assert not out[80]["host_rejected"] and not out[80]["base_failed"]


def test_prior_shrinks_small_hosts(spark, documents):
    texts = ["short"] * 3 + [" ".join(f"w{i}" for i in range(60))] * 300
    sources = {i: "small" for i in range(3)} | {i: f"h{i % 10}" for i in range(3, 303)}
    rates = {r["host"]: r for r in Q.host_verdicts(Q.base_counts(documents(texts, sources))).collect()}
    assert 0 < rates["small"]["rate_short"] < 1 and 0 <= rates["h5"]["rate_short"] < 0.05


def test_empty_table_and_clashing_columns(spark, documents):
    assert Q.quality_rules(documents(["x"]).where("false")).collect() == []
    clashing = documents(["one two", None], extra=["'k' AS kept", "1 AS _words", "2 AS _host", "3 AS _row", "4 AS n_words"])
    out = Q.quality_rules(clashing)
    assert sorted(out.columns) == sorted([*documents([None]).columns, "_words", "_host", "_row", *Q.COUNTS,
                                          "base_failed", "host_rejected", "kept"])
    assert {(r["_words"], r["_host"], r["_row"], r["n_words"]) for r in out.collect()} == {(1, 2, 3, 2), (1, 2, 3, 0)}


def test_query_equals_its_sql(spark):
    got = QUERIES["op1_quality_rules"](spark, SF_SMALL)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF_SMALL}/documents.parquet'")
    want = con.sql(ORACLE_SQL["op1_quality_rules"])
    order = list(want.columns)
    assert sorted(tuple(r[c] for c in order) for r in got.collect()) == sorted(want.fetchall())


def test_main_path_is_native(spark, documents):
    plan = Q.quality_rules(documents(["x"]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
