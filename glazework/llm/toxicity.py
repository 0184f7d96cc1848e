"""Toxicity by nearest labelled examples under exact TF-IDF cosine (operator 8).

1. Examples: labelled rows that may be learnt from, at most ``max_examples`` of
   them by the hash of their id (the documented bound of the sample).
2. Vocabulary: words of the examples that go with label 1, in ``MIN_DF`` examples or more and
   so often that less than one word of all would be there by chance; at most ``max_terms``. Cosines are
   those of the texts over these words: over all words the nearest examples share the subject, not the label
   (README, with figures).
3. Every document's counts of those words, from its whole text; document frequencies
   are counted over all documents. Weights are (1 + ln tf) * idf, of length one.
4. Index: postings by word, examples in blocks with the largest weight of each word and
   block. A query scores the blocks with the highest bounds, and then only
   blocks whose bound reaches the k-th best score: the k nearest are exact (ties: the
   earlier example).
5. Votes: the neighbours' cosines summed by label; a logistic curve fitted to the
   examples, each voted on by the others, turns the two sums into a score of 0 to 1.

The neighbours (evidence) are returned with the score.

Defined results: a null, empty or blank text, and a text without a word of the
vocabulary, has no neighbours and the curve's score at no votes; repeated rows score
alike; a very long text is counted whole; an id with several texts gives one example, its smallest
text, and each of its rows is scored by its own; labels of one document: toxic if any says so, null labels are no labels; without
examples of both labels every score is the share of label 1 (0 without examples); an
empty table gives no rows. Extra columns are carried only if named.

Scale: two passes of the documents' texts at most, both without a shuffle; word counts of
the sample and document frequencies combine map-side. What is sent to the tasks
is bounded by ``max_examples`` and ``max_terms``.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

MAX_EXAMPLES = 8000
MAX_TERMS = 2048
MIN_DF = 3
#: Enough votes that their sum tells a text with many telling words from one with a chance hit.
NEIGHBOURS = 30
BLOCK = 64
#: Blocks scored before the bound is used.
FIRST_BLOCKS = 4
THRESHOLD = 0.7
find_words = re.compile(r"\w+").findall


def words(text: str | None) -> list[str]:
    return find_words((text or "").lower())


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that must not be learnt from: crc32 of the id as text, modulo 3, is 1."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 3 == 1


class BlockMaxIndex:
    """Inverted index of unit vectors with block maxima."""

    def __init__(self, vectors: list[dict[int, float]], n_terms: int, block: int = BLOCK) -> None:
        self.n, self.block = len(vectors), block
        self.blocks = -(-self.n // block)
        lists: list[list[tuple[int, float]]] = [[] for _ in range(n_terms)]
        for i, v in enumerate(vectors):
            for t, w in v.items():
                lists[t].append((i, w))
        self.rows = [np.array([i for i, _ in x], np.int64) for x in lists]
        self.weights = [np.array([w for _, w in x], np.float64) for x in lists]
        self.highest = np.zeros((n_terms, self.blocks))
        for t in range(n_terms):
            np.maximum.at(self.highest[t], self.rows[t] // block, self.weights[t])

    def nearest(self, query: dict[int, float], k: int, without: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """(rows, cosines) of the k nearest with a cosine over 0, best first."""
        terms = sorted(query)
        if not terms or not self.n:
            return np.empty(0, np.int64), np.empty(0)
        bound = np.array([query[t] for t in terms]) @ self.highest[terms]
        wanted = np.zeros(self.blocks, bool)
        wanted[np.argsort(-bound, kind="stable")[:FIRST_BLOCKS]] = True
        rows, cosines = self._score(query, terms, wanted & (bound > 0), k, without)
        # rounding of the bound must not lose an equal score
        least = cosines[-1] - 1e-9 if len(cosines) == k else 0.0
        more = (bound >= least) & (bound > 0)
        if (more & ~wanted).any():
            rows, cosines = self._score(query, terms, more, k, without)
        return rows, cosines

    def _score(self, query, terms, wanted, k, without):
        scores = np.zeros(self.n)
        for t in terms:
            rows = self.rows[t]
            inside = wanted[rows // self.block]
            scores[rows[inside]] += query[t] * self.weights[t][inside]
        if without >= 0:
            scores[without] = 0.0
        hit = np.flatnonzero(scores > 0)
        best = hit[np.lexsort((hit, -scores[hit]))[:k]]
        return best, scores[best]


def unit(counts: dict[int, int], idf: np.ndarray) -> dict[int, float]:
    weights = {t: (1.0 + math.log(c)) * float(idf[t]) for t, c in sorted(counts.items())}
    norm = math.sqrt(sum(w * w for w in weights.values()))
    return {t: w / norm for t, w in weights.items()} if norm else {}


def fit_curve(votes: np.ndarray, labels: np.ndarray, rounds: int = 50, ridge: float = 1e-2) -> np.ndarray:
    """Weights (constant, toxic votes, clean votes) of a ridge logistic regression, by Newton's method."""
    x = np.c_[np.ones(len(votes)), votes]
    w = np.zeros(3)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hess = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(3)
        step = np.linalg.solve(hess, x.T @ (labels - p) - ridge * w)
        w = w + step
        if np.abs(step).max() < 1e-10:
            break
    return w


@dataclass
class Model:
    """All that a task needs to score texts; bounded by the sample and the vocabulary."""

    terms: list[str]
    idf: np.ndarray
    ids: list
    labels: np.ndarray
    index: BlockMaxIndex
    curve: np.ndarray
    k: int

    def __post_init__(self) -> None:
        self.place = {t: i for i, t in enumerate(self.terms)}
        self.seen: dict[tuple, tuple] = {}

    def counts(self, text: str | None) -> dict[int, int]:
        place = self.place
        return Counter([place[w] for w in words(text) if w in place])

    def votes(self, counts: dict[int, int], without: int = -1) -> tuple[float, float, np.ndarray]:
        rows, cosines = self.index.nearest(unit(counts, self.idf), self.k, without)
        toxic = self.labels[rows] == 1
        return float(cosines[toxic].sum()), float(cosines[~toxic].sum()), rows

    def score(self, counts: dict[int, int]) -> tuple[float, list]:
        """(score, ids of the nearest three examples); equal vectors are looked up once."""
        key = tuple(sorted(counts.items()))
        if key not in self.seen:
            if len(self.seen) > 50_000:
                self.seen.clear()
            toxic, clean, rows = self.votes(counts)
            z = float(self.curve @ np.array([1.0, toxic, clean]))
            self.seen[key] = (1 / (1 + math.exp(-max(-30.0, min(30.0, z)))), [self.ids[r] for r in rows[:3]])
        return self.seen[key]


def _term_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(toxic, term) for each distinct word of each example."""
    for batch in batches:
        toxic, terms = [], []
        for y, text in zip(batch.column(0), batch.column(1)):
            found = sorted(set(words(text.as_py())))
            terms += found
            toxic += [y.as_py()] * len(found)
        yield pa.RecordBatch.from_arrays(
            [pa.array(toxic, pa.int32()), pa.array(terms, pa.string())], names=["toxic", "term"]
        )


def examples(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, max_examples: int) -> DataFrame:
    """(id, toxic, text) of the labelled documents that are learnt from."""
    chosen = (
        labels.where(F.col("toxic").isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
        .groupBy(F.col(id_col).alias("_ex_id"))
        .agg(F.max("toxic").cast("int").alias("toxic"))
        .orderBy(F.xxhash64("_ex_id"), "_ex_id")
        .limit(max_examples)
    )
    joined = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(
        F.broadcast(chosen), F.col("_id") == F.col("_ex_id")
    )  # at most max_examples rows of two numbers
    return joined.groupBy(F.col("_ex_id").alias("_id")).agg(
        F.max("toxic").alias("toxic"),
        F.min("_text").alias("_text"),
    )


def vocabulary(sample: DataFrame, max_terms: int) -> list[str]:
    """Words that go with label 1, most telling first."""
    n, toxic = sample.agg(F.count(F.lit(1)), F.sum("toxic")).first()
    rate = (toxic or 0) / n if n else 0.0
    if not 0 < rate < 1:
        return []
    counted = sample.select("toxic", "_text").mapInArrow(
        _term_batches, "toxic int, term string"
    ).groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("toxic").alias("hits"))
    counted = stored(counted, "example-terms")
    df, hits = F.col("df"), F.col("hits")
    misses = df - hits
    # Chernoff: so many hits or more have a chance of exp(-gain) at most
    gain = hits * F.log(hits / (df * rate)) + F.when(misses > 0, misses * F.log(misses / (df * (1 - rate)))).otherwise(0.0)
    over = (df >= MIN_DF) & (hits > df * rate)
    top = counted.where(over).withColumn("gain", gain).where(F.col("gain") >= math.log(max(counted.count(), 1)))
    return [r["term"] for r in top.orderBy(F.desc("gain"), "term").limit(max_terms).collect()]


def _count_batches(terms: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {t: i for i, t in enumerate(terms)}
        kind = pa.list_(pa.int32())
        for batch in batches:
            carried = batch.num_columns - 1
            counts = [sorted(Counter([place[w] for w in words(t.as_py()) if w in place]).items())
                      for t in batch.column(carried)]
            arrays = [
                *(batch.column(i) for i in range(carried)),
                pa.array([[t for t, _ in c] for c in counts], kind),
                pa.array([[n for _, n in c] for c in counts], kind),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names[:-1], "_terms", "_counts"])

    return run


def with_counts(docs: DataFrame, terms: list[str], columns: list[str], text_col: str) -> DataFrame:
    plain = docs.select(*columns, F.col(text_col).alias("_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema.fields[:-1])
    lists = "_terms array<int>, _counts array<int>"
    return plain.mapInArrow(_count_batches(terms), f"{schema}, {lists}" if schema else lists)


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    max_examples: int = MAX_EXAMPLES, max_terms: int = MAX_TERMS, k: int = NEIGHBOURS,
) -> tuple[Model, DataFrame]:
    """The model, and (id, _terms, _counts) of every document, written to the shared folder."""
    sample = stored(examples(docs, labels, id_col, text_col, max_examples), "examples")
    terms = vocabulary(sample, max_terms)
    counted = stored(with_counts(docs, terms, [id_col], text_col), "term-counts")
    n = counted.count()
    found = counted.select(F.explode("_terms").alias("t")).groupBy("t").count().collect()  # max_terms rows
    frequency = np.zeros(len(terms))
    for r in found:
        frequency[r["t"]] = r["count"]
    idf = np.log((1.0 + n) / (1.0 + frequency)) + 1.0
    rows = with_counts(sample, terms, ["_id", "toxic"], "_text").orderBy("_id").collect()  # max_examples rows
    vectors = [unit(dict(zip(r["_terms"], r["_counts"])), idf) for r in rows]
    labelled = np.array([r["toxic"] for r in rows], dtype=np.int64)
    inside = [i for i, v in enumerate(vectors) if v]
    model = Model(
        terms, idf, [rows[i]["_id"] for i in inside], labelled[inside],
        BlockMaxIndex([vectors[i] for i in inside], len(terms)), np.zeros(3), k,
    )
    votes = np.zeros((len(rows), 2))
    for at, i in enumerate(inside):
        votes[i] = model.votes(dict(zip(rows[i]["_terms"], rows[i]["_counts"])), without=at)[:2]
    share = labelled.mean() if len(rows) else 0.0
    if 0 < share < 1:
        model.curve = fit_curve(votes, labelled.astype(float))
    else:
        model.curve = np.array([30.0 if share else -30.0, 0.0, 0.0])
    return model, counted


def _score_batches(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        for batch in batches:
            carried = batch.num_columns - 2
            got = [model.score(dict(zip(t, c)))
                   for t, c in zip(batch.column(carried).to_pylist(), batch.column(carried + 1).to_pylist())]
            scores = [s for s, _ in got]
            arrays = [
                *(batch.column(i) for i in range(carried)),
                pa.array(scores, pa.float64()),
                pa.array([int(s >= THRESHOLD) for s in scores], pa.int32()),
                pa.array([e for _, e in got], pa.list_(pa.int64())),
            ]
            names = [*batch.schema.names[:carried], "score", "predicted", "neighbours"]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return run


def score_documents(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits: int
) -> DataFrame:
    """(id, held_out, score, predicted, neighbours) of every document."""
    model, counted = train(docs, labels, id_col, text_col, **limits)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = counted.schema[id_col].dataType.simpleString()
    scored = counted.select(id_col, held_out(id_col).alias("held_out"), "_terms", "_counts").mapInArrow(
        _score_batches(shared),
        f"`{id_col}` {kind}, held_out boolean, score double, predicted int, neighbours array<bigint>",
    )
    return scored


def _clean_batches(shared, text_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        for batch in batches:
            keep = [model.score(model.counts(t.as_py()))[0] < THRESHOLD for t in batch.column(text_at)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return run


def drop_toxic(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits: int
) -> DataFrame:
    """``docs`` without the documents predicted toxic; all columns as they are."""
    model, _ = train(docs, labels, id_col, text_col, **limits)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.mapInArrow(_clean_batches(shared, docs.columns.index(text_col)), docs.schema)
