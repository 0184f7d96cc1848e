"""Operator 7 against a table-filling edit distance."""

import random

import pytest

from glazework.llm import decontaminate as D
from glazework.llm.queries import QUERIES
from tests.conftest import SF_SMALL
from tests.llm.conftest import ODD


def distance_to_part(pattern, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != t)))
        row = new
    return min(row)


def test_myers_distance():
    rng = random.Random(1)
    for _ in range(400):
        p = "".join(rng.choice("abc") for _ in range(rng.randrange(1, 90)))
        t = "".join(rng.choice("abc") for _ in range(rng.randrange(0, 120)))
        assert D.best_match(p, t)[0] == distance_to_part(p, t)


def test_find_by_brute_force():
    """Items planted with edits up to and over the budget, whatever the pieces."""
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 7))) for _ in range(60)]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(1, 14)))) for i in range(25)]
    matcher = D.Matcher(items)
    hits = 0
    for _ in range(150):
        _, text = rng.choice(items)
        letters = list(text)
        for _ in range(rng.randrange(0, int(D.RATE * len(text)) + 3)):
            at = rng.randrange(len(letters))
            edit = rng.randrange(3)
            if edit == 0:
                letters[at] = rng.choice("abcdefgh ")
            elif edit == 1:
                letters.insert(at, rng.choice("abcdefgh "))
            elif len(letters) > 1:
                del letters[at]
        around = [" ".join(rng.choice(words) for _ in range(rng.randrange(8))) for _ in range(2)]
        doc = D.normal(around[0] + " " + "".join(letters) + " " + around[1])
        want = {}
        for i, t in matcher.items:
            d = distance_to_part(t, doc)
            if d <= int(D.RATE * len(t)):
                want[i] = d
        got = {i: d for i, d, _ in matcher.find(doc)}
        assert got == want, (doc, got, want)
        hits += len(want)
    assert hits > 60


def test_one_edit_beginnings():
    rng = random.Random(3)
    for _ in range(2000):
        piece = "".join(rng.choice("ab") for _ in range(rng.randrange(1, 8)))
        text = "".join(rng.choice("ab") for _ in range(rng.randrange(0, 10)))
        near = min(distance(piece, text[:k]) for k in range(len(text) + 1)) <= 1
        assert D._one_edit(piece, text) or not near, (piece, text)  # never loses one


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        new = [i]
        for j, d in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
        row = new
    return row[-1]


@pytest.fixture()
def items(spark):
    rows = [(1, "The quick  brown fox\njumps over the lazy dog again"), (2, None), (3, " \n"), (4, ""),
            (5, "the quick brown fox jumps over the lazy dog again"), (6, "zq")]
    return spark.createDataFrame(rows, "item_id bigint, text string")


def test_documents_odd_texts_and_drop(spark, documents, items):
    texts = ODD + ["x THE QUICK brown fox jumps over the lazy dog again y", "the quick brawn fox jumps over the lzy dog again"]
    docs = documents(texts, extra=["1 AS item_id", "2 AS distance"])
    found = {(r["doc_id"], r["item_id"], r["distance"]) for r in D.contaminated(docs, items).collect()}
    n = len(ODD)
    assert found == {(n, 1, 0), (n, 5, 0), (n + 1, 1, 2), (n + 1, 5, 2)}
    kept = D.drop_contaminated(docs, items)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == list(range(n))
    assert D.contaminated(docs, items.where("false")).collect() == []
    assert D.drop_contaminated(docs, items.where("false")).count() == len(texts)
    assert D.contaminated(docs.where("false"), items).collect() == []


def test_items_in_several_blocks(spark, documents, items, monkeypatch):
    blocks = list(D.item_blocks(items, "item_id", "text", block_chars=30))
    assert len(blocks) > 2 and sorted(i for b in blocks for i, _ in b) == [1, 3, 4, 5, 6]


def test_equal_items_are_one_text_and_blocks_give_the_same(spark, documents):
    """A text held by most items is searched once and gives all their ids, of any type; several blocks lose nothing."""
    said = ["the quick brown fox jumps over the lazy dog again", "a stitch in time saves nine they say", "zzz unseen words of no text"]
    rows = [(f"i{n}", said[0] if n < 30 else said[n % 3]) for n in range(40)] + [(None, said[1]), ("i0", said[0]), ("x", None)]
    items = spark.createDataFrame(rows, "item_id string, text string")
    docs = documents([said[0] + " indeed", "so " + said[1].replace("nine", "nime"), "clean", None, said[0] + " " + said[1]])
    want = sorted([(d, i) for i, t in rows for d, hit in ((0, said[0]), (1, said[1]), (4, said[0]), (4, said[1])) if t == hit], key=str)
    for chars in (D.BLOCK_CHARS, 40):
        found = D.contaminated(docs, items, block_chars=chars)
        assert sorted(((r["doc_id"], r["item_id"]) for r in found.collect()), key=str) == want
        assert sorted(r["doc_id"] for r in D.drop_contaminated(docs, items, block_chars=chars).collect()) == [2, 3]
    blocks = list(D.item_blocks(D.item_texts(items, "text"), "_n", "_text", block_chars=40))
    assert sorted(t for b in blocks for _, t in b) == sorted(said)


def test_query_finds_the_passages_a_plain_search_finds(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    items = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()
    plain = {(d["doc_id"], i["item_id"]) for d in docs for i in items if D.normal(i["text"]) in D.normal(d["text"])}
    got = QUERIES["op7_decontamination"](spark, SF_SMALL).collect()
    assert plain and plain == {(r["doc_id"], r["item_id"]) for r in got if r["distance"] == 0}
