"""Centroid clustering with ns-bounds (operator 12).

Lloyd's rounds over integer vectors, exact to the last bit. Each vector keeps its centroid, the distance
to it, the distance to the nearest other one, and the round in which these were
measured. All centroids of all rounds are retained. In a later round the stored distances are loosened by the norm
of the total displacement since that round, ``|c_now - c_then|``, which is never more than the
drifts of the rounds between summed up. Where the loosened bounds still tell the nearest centroid, nothing is
computed; else all distances are taken again, exactly, and the bounds are new.

Defined results: a vector counts when it has exactly ``dims`` components, none null or non-finite; others (null,
empty, longer) give no row. Components become ``floor(scale * x)`` and must lie within 2**27, else an error says so.
Of equally near centroids the one of the smaller number is taken; the bounds only decide strict cases. Repeated rows
and ids are vectors of their own; a null id hashes as the text ``null``; rows that tie in the seeds' hash are taken by
their components. Fewer vectors than ``k`` give as many centroids; an empty table gives no rows. Other columns, whatever
their names, are ignored.

Scale: a round is one pass over the written rows of the round before, without a shuffle, then an aggregate of
at most ``k`` partial rows a task. Centroids and their history, ``rounds * k * dims`` numbers, are all that reaches the
driver and the tasks. Hot vectors need no care, as no row is grouped by its vector. Each round is written, so a lost
executor costs its tasks of one round.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

#: Largest absolute component; squared distances of 64 such differences stay below 2**62.
LIMIT = 1 << 27
#: Components up to here have products that float64 sums exactly, whatever the order.
FLOAT_LIMIT = 1 << 22
#: The bounds are computed in float64: a strict case must be strict by this share.
SLACK = 1e-9
#: Vectors whose distances to all centroids are taken at once.
BLOCK = 4096


def integer_vectors(rows: DataFrame, id_col: str, vector_col: str, dims: int, scale: float) -> DataFrame:
    """(id, v): the rows that count, with integer components."""
    vector = F.col(vector_col)
    scaled = F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")))
    usable = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    small = F.forall(vector, lambda x: F.abs(F.lit(scale) * x.cast("double")) < float(LIMIT))
    too_large = F.raise_error(F.lit(f"a scaled component passes {LIMIT}"))
    return rows.where((F.size(vector) == dims) & usable).select(
        F.col(id_col).alias("id"),
        F.when(small, scaled).otherwise(too_large.cast("array<bigint>")).alias("v"),
    )


def first_centroids(vectors: DataFrame, k: int, salt: str) -> np.ndarray:
    """The vectors of the ``k`` smallest hashes of their ids, in that order."""
    text = F.concat(F.lit(salt), F.coalesce(F.col("id").cast("string"), F.lit("null")))
    least = vectors.withColumn("h", F.sha2(text, 256)).orderBy("h", "v").limit(k)  # k rows
    return np.array([r["v"] for r in least.select("v").collect()], np.int64)


def squared_distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances as integers, (vectors, centroids)."""
    most = max(np.abs(x).max(initial=0), np.abs(centroids).max(initial=0))
    if most <= FLOAT_LIMIT and x.shape[1] * 4 * int(most) ** 2 < 1 << 53:
        a, b = x.astype(np.float64), centroids.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)).astype(np.int64)
    out = np.empty((len(x), len(centroids)), np.int64)
    for j, c in enumerate(centroids):
        d = x - c
        out[:, j] = (d * d).sum(1)
    return out


def displacements(history: np.ndarray) -> np.ndarray:
    """(rounds, k): the norm of each centroid's total displacement from each round until the last."""
    moved = history - history[-1]
    return np.sqrt((moved.astype(np.float64) ** 2).sum(2))


class Bounds:
    """What is kept of each vector: centroid, two distances and the round they were measured in."""

    def __init__(self, cluster: np.ndarray, own: np.ndarray, other: np.ndarray, since: np.ndarray):
        self.cluster, self.own, self.other, self.since = cluster, own, other, since

    @classmethod
    def none(cls, n: int) -> Bounds:
        return cls(np.full(n, -1), np.zeros(n), np.zeros(n), np.full(n, -1))


def undecided(bounds: Bounds, history: np.ndarray) -> np.ndarray:
    """Which vectors must be measured again against the last of the centroids in ``history``."""
    moved = displacements(history)
    rounds, k = moved.shape
    # the furthest that a centroid other than the own one has gone
    ranked = np.argsort(moved, axis=1)
    first = ranked[:, -1]
    far = moved[np.arange(rounds), first]
    second = moved[np.arange(rounds), ranked[:, -2]] if k > 1 else np.zeros(rounds)
    known = bounds.since >= 0
    since = np.where(known, bounds.since, 0)
    cluster = np.where(known, bounds.cluster, 0)
    others = np.where(first[since] == cluster, second[since], far[since])
    at_most = (bounds.own + moved[since, cluster]) * (1 + SLACK)
    at_least = (bounds.other - others) * (1 - SLACK)
    return ~known | ~(at_most < at_least)


def assign(x: np.ndarray, bounds: Bounds, history: np.ndarray) -> int:
    """Brings ``bounds`` up to the last centroids; returns how many vectors were measured."""
    again = np.flatnonzero(undecided(bounds, history))
    for at in range(0, len(again), BLOCK):
        rows = again[at : at + BLOCK]
        d = squared_distances(x[rows], history[-1])
        nearest = d.argmin(1)  # the smaller number of equals
        own = d[np.arange(len(rows)), nearest]
        d[np.arange(len(rows)), nearest] = np.iinfo(np.int64).max
        bounds.cluster[rows], bounds.own[rows], bounds.since[rows] = nearest, np.sqrt(own), len(history) - 1
        bounds.other[rows] = np.sqrt(d.min(1).astype(np.float64)) if d.shape[1] > 1 else np.inf
    return len(again)


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims).astype(np.int64)


def _assign_batches(history: np.ndarray):
    """Task of one round: rows with bounds against the last centroids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column("v"), history.shape[2])
            parts = [batch.column(c).to_numpy(zero_copy_only=False).copy() for c in ("cluster", "own", "other", "since")]
            bounds = Bounds(*parts)
            n = assign(x, bounds, history)
            measured = np.zeros(len(x), np.int32)
            measured[0] = n
            values = [bounds.cluster, bounds.own, bounds.other, bounds.since, measured]
            kinds = [pa.int32(), pa.float64(), pa.float64(), pa.int32(), pa.int32()]
            arrays = [batch.column("id"), batch.column("v"), *(pa.array(a, t) for a, t in zip(values, kinds))]
            yield pa.RecordBatch.from_arrays(arrays, names=["id", "v", *STATE_NAMES, "measured"])

    return run


STATE_NAMES = ["cluster", "own", "other", "since"]
STATE = "cluster int, own double, other double, since int, measured int"


def next_centroids(rows: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Exact floor of each cluster's mean; an empty cluster keeps its centroid."""
    dims = centroids.shape[1]
    sums = rows.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("n"), F.array(*[F.sum(F.col("v")[i]) for i in range(dims)]).alias("sums")
    )
    out = centroids.copy()
    for r in sums.collect():  # k rows at most
        out[r["cluster"]] = [s // r["n"] for s in r["sums"]]
    return out


def clustered(
    rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", dims: int = 64, k: int = 40,
    rounds: int = 5, scale: float = 256.0, salt: str = "2:",
) -> tuple[DataFrame, np.ndarray]:
    """(id, v, cluster, own, other, since, measured) after the last assignment, and the centroids of all rounds.

    ``measured``: how many vectors of a batch were measured in the last assignment, on the batch's first row.
    """
    vectors = stored(integer_vectors(rows, id_col, vector_col, dims, scale), "vectors")
    centroids = first_centroids(vectors, k, salt)
    kind = vectors.schema["id"].dataType.simpleString()
    nothing = [F.lit(-1), F.lit(0.0), F.lit(0.0), F.lit(-1)]
    state = vectors.select("id", "v", *[c.alias(n) for c, n in zip(nothing, STATE_NAMES)])
    if not len(centroids):
        return state.withColumn("measured", F.lit(0)), np.zeros((1, 0, dims), np.int64)
    history = centroids[None]
    for number in range(rounds + 1):
        task = _assign_batches(history)
        state = state.select("id", "v", *STATE_NAMES).mapInArrow(task, f"id {kind}, v array<bigint>, {STATE}")
        state = stored(state, f"round-{number}")
        if number < rounds:
            history = np.concatenate([history, next_centroids(state, history[-1])[None]])
    return state, history


def centroid_digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def cluster_vectors(
    rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", dims: int = 64, k: int = 40,
    rounds: int = 5, scale: float = 256.0, salt: str = "2:",
) -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every vector that counts."""
    state, history = clustered(rows, id_col, vector_col, dims, k, rounds, scale, salt)
    spark, last = rows.sparkSession, history[-1]
    table = spark.createDataFrame(
        [(j, c.tolist(), centroid_digest(c)) for j, c in enumerate(last)],
        "cluster int, c array<bigint>, centroid_sha256 string",
    )
    gap = F.zip_with("v", "c", lambda a, b: (a - b) * (a - b))
    distance = F.aggregate(gap, F.lit(0).cast("bigint"), lambda s, x: s + x)
    near = state.join(F.broadcast(table), "cluster").select(
        F.col("id").alias(id_col), "cluster", distance.alias("distance"), "centroid_sha256"
    )
    sums = near.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()  # k rows at most
    totals = spark.createDataFrame(
        [(r["cluster"], r["s"], sum(x["s"] for x in sums)) for r in sums],
        "cluster int, cluster_inertia bigint, inertia bigint",
    )
    return near.join(F.broadcast(totals), "cluster").select(
        id_col, "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def oracle(dims: int = 64, k: int = 40, rounds: int = 5, scale: int = 256, salt: str = "2:") -> str:
    """DuckDB SQL of the contract's query: every distance of every round, without bounds."""
    steps = [
        f"""v AS MATERIALIZED (SELECT vec_id, [floor({scale} * x::DOUBLE)::BIGINT FOR x IN embedding] AS v FROM embeddings
  WHERE len(embedding) = {dims} AND len([1 FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = {dims})""",
        f"""c0 AS MATERIALIZED (SELECT (row_number() OVER (ORDER BY h, v) - 1)::INTEGER AS cluster, v AS c
  FROM (SELECT sha256('{salt}' || vec_id) AS h, v FROM v) ORDER BY h, v LIMIT {k})""",
    ]
    gap = "list_sum([(p[1] - p[2]) * (p[1] - p[2]) FOR p IN list_zip(v, c)])::BIGINT"
    for i in range(rounds + 1):
        steps.append(
            f"a{i} AS MATERIALIZED (SELECT vec_id, v, cluster, d FROM (SELECT vec_id, v, cluster, {gap} AS d FROM v, c{i})"
            " QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, cluster) = 1)"
        )
        if i < rounds:
            mean = "(s - ((s % n) + n) % n) // n"
            steps.append(
                f"s{i} AS (SELECT cluster, i, sum(x)::HUGEINT AS s, count(*) AS n FROM (SELECT cluster, unnest(v) AS x,"
                f" unnest(range(1, {dims + 1})) AS i FROM a{i}) GROUP BY cluster, i)"
            )
            steps.append(f"m{i} AS (SELECT cluster, list(({mean})::BIGINT ORDER BY i) AS m FROM s{i} GROUP BY cluster)")
            steps.append(
                f"c{i + 1} AS MATERIALIZED (SELECT cluster, coalesce(m, c) AS c FROM c{i} LEFT JOIN m{i} USING (cluster))"
            )
    return (
        "WITH " + ",\n".join(steps) + f"""
SELECT vec_id, cluster, d AS distance, (sum(d) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia,
  (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} USING (cluster)"""
    )
