"""The pipeline against a version that applies each method by brute force."""

import re

import pytest

import corpus_pipeline
from glazework.llm import decontaminate, stages, toxicity
from glazework.llm.common import stored, table
from tests.conftest import SF_SMALL
from tests.llm.conftest import DOCS
from tests.llm.test_quality_rules import counts
from tests.llm.test_simhash import by_definition, groups_by_definition


@pytest.fixture(scope="module")
def stage_rows(spark):
    docs = table(spark, SF_SMALL, "documents")
    rows = [docs]
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF_SMALL), "test-stage")
        rows.append(docs)
    return rows


def by_id(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_names_and_columns(stage_rows):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "quality_rules", "simhash_near_dedup", "decontamination", "packing"
    ]
    assert all(df.columns == stage_rows[0].columns for df in stage_rows[1:5])
    sizes = [df.count() for df in stage_rows[:5]]
    assert sizes == sorted(sizes, reverse=True) and sizes[4] > sizes[0] / 2


def test_toxicity_stage_drops_toxic_only(spark, stage_rows):
    labels = {r["doc_id"]: r["toxic"] for r in table(spark, SF_SMALL, "labels").collect()}
    gone = by_id(stage_rows[0]).keys() - by_id(stage_rows[1]).keys()
    scored = toxicity.score_documents(stage_rows[0], table(spark, SF_SMALL, "labels"))
    assert gone == {r["doc_id"] for r in scored.collect() if r["predicted"]}
    assert sum(labels.get(i) == 0 for i in gone) <= 0.02 * len(labels)


def test_quality_stage(stage_rows):
    before, after = by_id(stage_rows[1]), by_id(stage_rows[2])
    for i, text in before.items():
        n, _, _, _, repeated = counts(text)
        assert (i in after) == (n >= 50 and 100 * repeated <= 50 * n), i  # no host of this corpus is bad


def test_near_dedup_stage(stage_rows):
    before, after = by_id(stage_rows[2]), by_id(stage_rows[3])
    ids = sorted(before)
    roots = groups_by_definition([by_definition(before[i]) for i in ids])
    assert sorted(after) == sorted({ids[r] for r in roots})


def test_decontamination_stage(spark, stage_rows):
    before, after = by_id(stage_rows[3]), by_id(stage_rows[4])
    items = [decontaminate.normal(r["text"]) for r in table(spark, SF_SMALL, "benchmark").collect()]
    for i, text in before.items():
        if any(t in decontaminate.normal(text) for t in items):
            assert i not in after
        elif i not in after:  # an inexact copy: some long part of an item is there
            found = decontaminate.Matcher(list(enumerate(items))).find(decontaminate.normal(text))
            assert found


def test_packing_covers_what_is_left(stage_rows):
    pieces = {}
    for r in stage_rows[5].collect():
        pieces.setdefault(r["doc_id"], []).append((r["start"], r["length"], r["doc_tokens"]))
    assert pieces.keys() == by_id(stage_rows[4]).keys()
    assert all(sum(n for _, n, _ in p) == p[0][2] for p in pieces.values())


def test_run_equals_the_stages(spark, stage_rows):
    got = corpus_pipeline.run(spark, SF_SMALL)
    keys = ["doc_id", "start", "length", "ids_crc32"]
    assert got.columns == stage_rows[5].columns
    total = lambda df: sorted((r["doc_id"], r["doc_tokens"]) for r in df.select("doc_id", "doc_tokens").distinct().collect())
    assert total(got) == total(stage_rows[5]) and set(keys) <= set(got.columns)


def test_repeated_rows_and_null_ids_in_the_near_dedup_stage(spark, documents):
    words = lambda seed: " ".join(f"{seed}{i}" for i in range(80))
    texts = [words("a")] * 4 + [words("b"), words("c"), None, ""]
    docs = documents(texts, ids=[3, 3, 3, 8, 9, None, 1, 2], extra=["1 AS _doc", "2 AS _hash"])
    kept = stages.keep_one_of_each_group(spark, docs, SF_SMALL)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept.collect()) == [
        (False, 1), (False, 3), (False, 9), (True, 0)
    ]


def test_stages_leave_columns_named_like_their_own_as_they_are(spark):
    docs = table(spark, SF_SMALL, "documents").selectExpr(
        "*", "concat('mine', doc_id) AS n_words", "doc_id * 2 AS kept", "'h' AS host_rejected", "doc_id AS _row",
        "'s' AS score", "'p' AS _fp", "doc_id % 7 AS _root", "'b' AS _bad", "named_struct('a', doc_id) AS _whole",
    )
    before = {r["doc_id"]: r for r in docs.collect()}
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, SF_SMALL), "test-clash")
        rows = docs.collect()
        assert rows and all(r == before[r["doc_id"]] for r in rows)


def test_near_dedup_tie_between_rows_that_differ_elsewhere(spark, documents):
    text = " ".join(f"w{i}" for i in range(80))
    for sources in (["x", "y", "z"], ["z", "y", "x"]):
        rows = [(4, text, "en", s, 1, {"m": 1}) for s in sources] + [(9, "other words here", "en", "q", 1, {})]
        docs = spark.createDataFrame(rows, f"{DOCS}, m map<string,int>").repartition(2)
        kept = {r["doc_id"]: r for r in stages.keep_one_of_each_group(spark, docs, SF_SMALL).collect()}
        assert sorted(kept) == [4, 9] and kept[4]["source"] == "x" and kept[4]["m"] == {"m": 1}


def test_empty_documents(spark):
    docs = table(spark, SF_SMALL, "documents").where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF_SMALL), "test-empty")
    assert docs.count() == 0


def test_fixed_values_are_named_once():
    source = open(corpus_pipeline.__file__).read()
    assert not re.search(r"limit\(|sample\(", source)


def test_groups_of_null_and_shared_ids_each_keep_a_row(spark, documents):
    words = lambda seed: " ".join(f"{seed}{i}" for i in range(80))
    texts = [words("a"), words("a"), words("b"), words("c"), words("d"), words("e"), words("e"), words("f"), words("f")]
    docs = documents(texts, ids=[None, None, None, None, 5, 5, 7, None, 6])
    kept = stages.keep_one_of_each_group(spark, docs, SF_SMALL)
    assert sorted((r["text"], r["doc_id"] or 0) for r in kept.collect()) == sorted(
        [(words("a"), 0), (words("b"), 0), (words("c"), 0), (words("d"), 5), (words("e"), 5), (words("f"), 6)]
    )
