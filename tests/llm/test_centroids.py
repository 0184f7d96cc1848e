"""Operator 12: exact against plain Lloyd's rounds in Python integers."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from glazework.llm import centroids as C
from glazework.llm.queries import ORACLE_SQL, QUERIES
from tests.conftest import SF_SMALL

ROWS = "vec_id bigint, embedding array<double>"


def brute(vectors, k, rounds, salt="2:"):
    """[(id, cluster, distance, cluster inertia, inertia, digest)] by definition; ``vectors``: (id, integers)."""
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    seeds = sorted(vectors, key=lambda r: (sha(salt + ("null" if r[0] is None else str(r[0]))), r[1]))
    cents = [list(v) for _, v in seeds[:k]]
    gap = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda v: min((gap(v, c), j) for j, c in enumerate(cents))
    for _ in range(rounds):
        at = [near(v)[1] for _, v in vectors]
        for j in range(len(cents)):
            own = [v for (_, v), a in zip(vectors, at) if a == j]
            if own:
                cents[j] = [sum(x) // len(own) for x in zip(*own)]
    found = [(i, *near(v)[::-1]) for i, v in vectors]
    per = {j: sum(d for _, a, d in found if a == j) for j in range(len(cents))}
    digest = [sha(",".join(map(str, c))) for c in cents]
    return [(i, a, d, per[a], sum(per.values()), digest[a]) for i, a, d in found]


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_query_against_sql(spark):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF_SMALL}/embeddings.parquet'")
    want = con.sql(ORACLE_SQL["op12_centroids"])
    assert got(QUERIES["op12_centroids"](spark, SF_SMALL).select(*want.columns)) == sorted(want.fetchall(), key=str)


@pytest.mark.parametrize("rounds,k,spread", [(5, 6, 3), (8, 12, 400), (0, 3, 50), (4, 1, 9), (3, 200, 2)])
def test_rounds_ties_repeats_and_clashing_columns(spark, rounds, k, spread):
    draw = random.Random(rounds)
    rows = [(draw.choice([None, *range(70)]), [draw.randint(-spread, spread) for _ in range(3)]) for _ in range(150)]
    rows += [(7, [1, 1, 1])] * 80  # a third of all rows alike
    df = spark.createDataFrame([(i, [x / 4 + 0.1 for x in v]) for i, v in rows], ROWS).repartition(4)
    df = df.selectExpr("*", "9 AS cluster", "'x' AS v", "1 AS h", "2 AS since")
    out = C.cluster_vectors(df, dims=3, k=k, rounds=rounds, scale=4.0)
    assert got(out) == sorted(brute(rows, min(k, len(rows)), rounds), key=str)


def test_rows_that_do_not_count(spark):
    nan, inf = float("nan"), float("inf")
    bad = [None, [], [1.0], [1.0, None], [nan, 1.0], [1.0, inf], [-inf, 0.0], [1.0, 2.0, 3.0]]
    good = [(100, [0.99, -0.01]), (101, [5.0, 5.0]), (None, [0.0, 0.0])]
    df = spark.createDataFrame([*enumerate(bad), *good], ROWS)
    out = C.cluster_vectors(df, dims=2, k=2, rounds=2, scale=1.0)
    assert got(out) == sorted(brute([(100, [0, -1]), (101, [5, 5]), (None, [0, 0])], 2, 2), key=str)
    assert C.cluster_vectors(df.where("vec_id < 8"), dims=2, k=2).collect() == []
    with pytest.raises(Exception, match="passes"):
        C.cluster_vectors(spark.createDataFrame([(1, [1e30, 0.0])], ROWS), dims=2).collect()


@pytest.mark.parametrize("size", [1 << 10, 1 << 21, 1 << 27])
def test_distances_are_exact_at_every_size(size):
    draw = np.random.default_rng(1)
    x, c = (draw.integers(-size + 1, size, (n, 64)) for n in (50, 7))
    want = [[sum((int(a) - int(b)) ** 2 for a, b in zip(u, w)) for w in c] for u in x]
    assert C.squared_distances(x, c).tolist() == want


def walk(rounds=6, n=900, k=12, dims=5, seed=2):
    """Vectors around wandering centroids."""
    draw = np.random.default_rng(seed)
    cents = draw.integers(-2000, 2000, (k, dims))
    x = cents[draw.integers(0, k, n)] + draw.integers(-500, 500, (n, dims))
    history = [cents]
    for _ in range(rounds - 1):
        history.append(history[-1] + draw.integers(-60, 60, (k, dims)))
    return x, np.array(history)


def test_bounds_hold_and_failures_are_rescanned():
    x, history = walk()
    bounds, measured = C.Bounds.none(len(x)), []
    for number in range(1, len(history) + 1):
        again = C.undecided(bounds, history[:number])
        measured.append(C.assign(x, bounds, history[:number]))
        assert measured[-1] == again.sum()
        nearest = C.squared_distances(x, history[number - 1]).argmin(1)
        assert (bounds.cluster == nearest).all()
        assert (bounds.since[again] == number - 1).all() and (bounds.since[~again] < number - 1).all()
    assert measured[0] == len(x) and sum(measured[1:]) < 0.5 * len(x) * (len(history) - 1)


def test_total_displacement_is_tighter_than_summed_drifts():
    _, history = walk()
    total = C.displacements(history)
    steps = np.sqrt((np.diff(history, axis=0).astype(float) ** 2).sum(2))
    summed = np.cumsum(steps[::-1], axis=0)[::-1]
    assert (total[:-1] <= summed + 1e-9).all() and (total[:-2] < 0.9 * summed[:-1]).mean() > 0.5
    assert (total[-1] == 0).all()


def test_a_round_writes_what_it_measured(spark):
    df = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    state, history = C.clustered(df, k=8, rounds=3)
    r = state.agg(F.sum("measured").alias("m"), F.count("id").alias("n"), F.min("since").alias("s")).first()
    assert history.shape == (4, 8, 64) and r["n"] == 500 and r["m"] <= 500
