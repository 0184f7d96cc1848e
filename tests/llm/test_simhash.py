"""Operator 6 against the definition and a union-find over all pairs."""

import random
import re

import numpy as np
import xxhash

from glazework.llm import simhash as S
from tests.llm.conftest import ODD


def by_definition(text, shingle=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))] if words else []
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def groups_by_definition(prints, bits=4):
    """Smallest index reachable over links of at most ``bits`` bits, by index."""
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= bits:
                a_root, b_root = find(i), find(j)
                parent[max(a_root, b_root)] = min(a_root, b_root)
    return [find(i) for i in range(len(prints))]


def test_documents_by_brute_force(spark, documents):
    rng = random.Random(5)
    base = [" ".join(rng.choice("abcdefghijklmnop") * rng.randrange(1, 4) for _ in range(rng.randrange(1, 120))) for _ in range(60)]
    near = []
    for text in base[:30]:
        words = text.split()
        words[rng.randrange(len(words))] = "changed"
        near += [" ".join(words), text.upper(), text.replace(" ", "\n ")]
    texts = ODD + base + near + base[:10]
    out = {r["doc_id"]: r for r in S.simhash_groups(documents(texts)).collect()}
    prints = [by_definition(t) for t in texts]
    assert [out[i]["fingerprint"] for i in range(len(texts))] == [f"{p:016x}" for p in prints]
    assert [out[i]["component_id"] for i in range(len(texts))] == groups_by_definition(prints)
    assert out[0]["fingerprint"] == "0" * 16 and out[1]["component_id"] == 0


def test_links_of_random_fingerprints(spark):
    """Chains and balls of fingerprints at distances around the limit, cells over the block size too."""
    rng = random.Random(6)
    prints = {0, (1 << 64) - 1}
    for _ in range(120):
        p = rng.getrandbits(64)
        prints.add(p)
        for _ in range(rng.randrange(6)):
            for b in rng.sample(range(64), rng.randrange(1, 7)):
                p ^= 1 << b
            prints.add(p)
    prints = sorted(prints)
    rows = [(int(np.uint64(p).astype(np.int64)),) for p in prints]
    nodes = spark.createDataFrame(rows, "_fp bigint").repartition(4)
    want = groups_by_definition(prints)
    for cell_rows in (S.CELL_ROWS, 2):  # 2: nearly every cell is cut into blocks
        old, S.CELL_ROWS = S.CELL_ROWS, cell_rows
        try:
            found = S.components(S.link_fingerprints(nodes)).collect()
        finally:
            S.CELL_ROWS = old
        root = {r["node"]: r["root"] for r in found}
        got = {}
        for (p,), w in zip(rows, want):
            got.setdefault(root.get(p, p), set()).add(w)
        assert all(len(v) == 1 for v in got.values()) and len(got) == len(set(want)), cell_rows


def test_manhattan_distance_is_a_lower_bound_and_close_pairs_share_a_cell():
    rng = random.Random(7)
    for _ in range(300):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), rng.randrange(5)):
            b ^= 1 << bit
        cells, index = S.grid_cells(np.array([a, b], np.uint64), 1)
        assert set(cells[index == 0].tolist()) & set(cells[index == 1].tolist())


def test_group_of_near_copies_gives_few_edges():
    rng = np.random.default_rng(8)
    bits = np.uint64(1) << rng.integers(0, 64, (3000, 2)).astype(np.uint64)
    ball = np.unique(np.uint64(12345) ^ bits[:, 0] ^ bits[:, 1])
    cells = np.zeros(len(ball), np.int64)
    a, _ = S.cell_links(cells, ball, 4)
    assert len(ball) > 1000 and len(a) == len(ball) - 1


def written(monkeypatch):
    """Names of the tables that ``components`` writes."""
    names, store = [], S.stored
    monkeypatch.setattr(S, "stored", lambda df, name: names.append(name) or store(df, name))
    return names


def test_components_of_a_long_rising_chain(spark, monkeypatch):
    names = written(monkeypatch)
    edges = spark.range(1, 10_000).selectExpr("id AS a", "id + 1 AS b")
    roots = {r["node"]: r["root"] for r in S.components(edges).collect()}
    assert set(roots.values()) == {1} and len(roots) == 10_000
    assert names.count("joins") == 1 and names.count("paths") <= 16
    assert S.components(edges.where("false")).collect() == []


def test_components_of_random_graphs_and_stars(spark, monkeypatch):
    rng = random.Random(5)
    label = list(range(-600, 600))
    rng.shuffle(label)
    pairs = [(label[i], label[i + 1]) for i in range(299)]  # a shuffled chain
    pairs += [(label[300], label[i]) for i in range(301, 500)]  # a star
    pairs += [(label[rng.randrange(500, 1200)], label[rng.randrange(500, 1200)]) for _ in range(380)]
    want = {n: n for p in pairs for n in p}

    def top(n):
        while want[n] != n:
            n = want[n]
        return n

    for a, b in pairs:
        lo, hi = sorted((top(a), top(b)))
        want[hi] = lo
    names = written(monkeypatch)
    got = {r["node"]: r["root"] for r in S.components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    assert got == {n: top(n) for n in want}
    assert names.count("joins") <= 10


def test_null_ids_repeats_and_empty_table(spark, documents):
    docs = documents(["a b c d", "a b c d", "z", None], ids=[None, 5, None, None])
    out = S.simhash_groups(docs).collect()
    assert sorted((r["doc_id"] or -1, r["component_id"] or -1) for r in out) == [(-1, -1), (-1, -1), (-1, 5), (5, 5)]
    assert S.simhash_groups(docs.where("false")).collect() == []
