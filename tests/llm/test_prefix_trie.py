"""Operator 13: against a trie of Python dictionaries."""

import hashlib
import random
import re
import zlib

import pytest

from glazework.llm import prefix_trie as P
from glazework.llm.queries import ORACLE_SQL, QUERIES
from tests.conftest import SF_SMALL
from tests.llm.conftest import ODD

TURNS = "conv_id bigint, turn bigint, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def sequences(rows):
    """By conversation: its (role, text) in the operator's order."""
    by = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            what = P.digest(f"{len(role.encode())}:{role}{text}".encode())
            by.setdefault(conv, []).append(((turn is not None, turn or 0, what), (role, text)))
    return {c: [t for _, t in sorted(turns)] for c, turns in by.items()}


def rebuilt(seqs):
    out = {}
    for c, own in seqs.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = seqs.get(c - int(f"{c}"[-2:]) % 20 if c >= 0 else 0, [])[:h] + own[h:]
    return out


def brute(seqs):
    members = {}
    for c, turns in seqs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    kids = {}
    for node in members:
        if node:
            kids.setdefault(node[:-1], []).append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        below = kids.get(node, [])
        leaves[node] = sum(leaves[k] for k in below) or 1
        saved[node] = (len(members[node]) - 1) * words + sum(saved[k] for k in below)
    out = []
    for node, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if len(seqs[c]) == len(node))
        out.append((
            min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), len(kids.get(node, [])),
            leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def got(df):
    return sorted(map(tuple, df.select(*COLUMNS).collect()), key=str)


def test_query_against_sql_and_brute_force(spark):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF_SMALL}/conversations.parquet'")
    rows = con.sql("SELECT conv_id, turn, role, text FROM conversations").fetchall()
    out = got(QUERIES["op13_prefix_trie"](spark, SF_SMALL))
    assert out == brute(rebuilt(sequences(rows)))
    assert out == sorted(con.sql(ORACLE_SQL["op13_prefix_trie"]).project(", ".join(COLUMNS)).fetchall(), key=str)


def drawn(seed, convs, turns, texts):
    draw = random.Random(seed)
    rows = []
    for c in draw.sample(range(100, 160), convs):
        n = draw.choice(turns)
        rows += [(c, draw.choice([None, *range(n)]), draw.choice(["user", None]), draw.choice(texts)) for _ in range(n)]
    return rows


@pytest.mark.parametrize("seed", range(4))
def test_ties_nulls_repeats_and_clashing_columns(spark, seed):
    rows = drawn(seed, 40, range(1, 6), ["a b", "a b", " ", None, "c"]) + [(None, 0, "user", "x"), (120, None, None, None)] * 3
    df = spark.createDataFrame(rows, TURNS).repartition(5).selectExpr("*", "1 AS conv", "2 AS pos", "'x' AS what", "3 AS node")
    assert got(P.prefix_trie(df)) == brute(sequences(rows))
    turns = P.turn_rows(df, "conv_id", "turn", "role", "text")
    assert got(P.trie(P.with_borrowed_beginnings(turns))) == brute(rebuilt(sequences(rows)))


def test_conversations_of_many_bands(spark):
    draw = random.Random(5)
    long = [("user", f"turn {i} of many") for i in range(3 * P.BAND + 5)]
    seqs = {c: long[: draw.choice([1, 63, 64, 65, 127, 128, 190, 197])] + [("user", str(draw.randint(0, 2)))] * draw.randint(0, 70) for c in range(30)}
    seqs[30], seqs[31] = long, long
    rows = [(c, i, r, t) for c, turns in seqs.items() for i, (r, t) in enumerate(turns)]
    assert got(P.prefix_trie(spark.createDataFrame(rows, TURNS).repartition(7))) == brute(seqs)


def test_turnless_conversations_end_at_the_root(spark):
    # h of 101 and 109 is over one, and their base 100 is absent
    seqs = {c: [("user", "only")] for c in range(101, 120)}
    rows = [(c, 0, *t) for c, turns in seqs.items() for t in turns]
    turns = P.turn_rows(spark.createDataFrame(rows, TURNS), "conv_id", "turn", "role", "text")
    want = brute(rebuilt(seqs))
    assert any(not t for t in rebuilt(seqs).values())
    assert got(P.trie(P.with_borrowed_beginnings(turns))) == want


def test_odd_texts_and_empty_table(spark):
    rows = [(c, i, "user", t) for c in (1, 2, -7) for i, t in enumerate(ODD[c:])]
    df = spark.createDataFrame(rows, TURNS)
    assert got(P.prefix_trie(df)) == brute(sequences(rows))
    assert P.prefix_trie(df.where("false")).collect() == []


def test_a_third_of_all_in_one_place(spark):
    """One whole conversation shared by thousands, one long conversation of a third of all turns."""
    shared = spark.range(5000).selectExpr("id AS conv_id", "0L AS turn", "'user' AS role", "'same words' AS text")
    hot = spark.range(2500).selectExpr("9999L AS conv_id", "id AS turn", "'user' AS role", "IF(id = 0, 'same words', concat('w ', id)) AS text")
    out = {r["depth"]: r for r in P.prefix_trie(shared.unionByName(hot)).collect()}
    ends = hashlib.sha256(",".join(map(str, range(5000))).encode()).hexdigest()
    assert (out[1]["n_convs"], out[1]["ends_sha256"], out[1]["n_leaves"], out[1]["saved_tokens"]) == (5001, ends, 1, 10000)
    assert len(out) == 2501 and all(out[d]["n_convs"] == 1 and out[d]["n_children"] == (d < 2500) for d in range(2, 2501))


def test_one_shard():
    rows = [(5, 0, b"", [(b"", 0), (b"a", 1), (b"b", 2)], True), (3, 0, b"", [(b"", 0), (b"a", 1)], True), (4, 0, b"", [(b"", 0)], True)]
    found = {(depth, tuple(members)): (words, ends) for _, _, depth, words, members, ends in P.walk_shard(rows)}
    assert found == {(0, (5, 3, 4)): (0, [4]), (1, (5, 3)): (1, [3]), (2, (5,)): (2, [5])}
