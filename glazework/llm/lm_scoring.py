"""Masked pseudo-likelihood of documents under a bidirectional window network (operator 3).

Tokens are the lower-cased words of a whole text. Each has one of ``CLASSES`` classes: the ``OWN``
most frequent hash buckets of the corpus have one each, the other buckets share the rest. A token's
probability is P(class | neighbours) * P(word | class):

* the network predicts the class from the ``SIDE`` tokens on either side: each neighbour
  adds the row of its position's table, tanh, then a softmax over the classes;
* the word in its class goes by the counts of every word of the corpus, each plus one, and one
  for all words that the corpus doesn't hold.

A document's score is the sum of the log-probabilities of all its tokens, each given its neighbours.

Training, in numpy on Spark's partitions: in each of ``ROUNDS`` rounds every task starts
from the current weights, takes Adagrad steps on its own documents (in each round one token in as many as
there are rounds, from a place that depends on the text; over the rounds every token is the target once), and returns its
weights times the number of its targets. Spark sums them by weight; their mean starts the next
round. Word counts, too, are taken over all words of all documents.

Defined results: a text without words (null, empty, blank) has 0 tokens, sum 0 and a null
mean; repeated rows score alike; an empty table gives no rows (and no training). Extra columns are
carried only if named.

Scale: 2 + ``ROUNDS`` passes of the texts, without a shuffle of texts. Words are counted map-side
and the table of all words is written; it grows with the corpus. Words with a share of 1 / ``SHARE``
or more, at most ``HEAD`` of them, are sent to the tasks. The other words of each row
meet the table by a join on the word, where none is frequent, and are summed by row. Weights (some
41,000 rows a task) are summed with map-side combining. The driver gets at most ``BUCKETS`` counts,
``HEAD`` words and one set of weights.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from hashlib import blake2b
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

BUCKETS = 1 << 16
OWN, SHARED = 192, 64
CLASSES = OWN + SHARED
#: Class of the places before a text's first and after its last token.
PAD = CLASSES
SIDE = 2
OFFSETS = tuple(o for o in range(-SIDE, SIDE + 1) if o)
HIDDEN = 32
ROUNDS = 2
STEP = 1024
RATE = 0.1
SEED = 7
#: Tokens scored at a time.
CHUNK = 1024
ONES = np.ones(CLASSES, np.float32)
#: Places of a class's row in a table that holds its cells by twos.
TWOS = np.arange((CLASSES + 1) * HIDDEN // 2).reshape(CLASSES + 1, -1)
#: Row sums of exponentials between these are exact to a float's precision.
SAFE = 1e-25, 1e25
#: At most so many words are sent to the tasks, the most frequent ones,
HEAD = 1 << 18
#: each at least once in so many words.
SHARE = 1 << 20
#: Bytes of words that a task holds before they are counted and passed on.
HELD = 1 << 25
#: Longer words are kept by a digest.
LONG_WORD = 64
#: Log-counts are summed as whole numbers of 1 / ``UNIT``, so that their order doesn't matter.
UNIT = 1 << 26


def word_key(word: bytes) -> bytes:
    """What a word is counted and joined by."""
    return word if len(word) <= LONG_WORD else b" " + blake2b(word).digest()


def buckets(raw: bytes | None) -> np.ndarray:
    """The hash bucket of each word of a text's UTF-8 bytes."""
    return word_buckets((raw or b"").lower().split())


def word_buckets(words: list[bytes] | np.ndarray) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, words), np.int64, len(words)) % BUCKETS


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(the lower-cased words of all texts in a row, words of each text); ``bytes.lower().split()`` in Arrow."""
    wide = pa.types.is_large_binary(texts.type)
    # only ASCII functions, which take any bytes
    trimmed = pc.ascii_trim_whitespace(pc.ascii_lower(texts.view(pa.large_string() if wide else pa.string())))
    trimmed = pc.if_else(pc.greater(pc.binary_length(trimmed), 0), trimmed, pa.scalar(None, trimmed.type))
    split = pc.ascii_split_whitespace(trimmed)
    sizes = pc.fill_null(pc.list_value_length(split), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    return split.flatten().view(pa.large_binary() if wide else pa.binary()), sizes


def word_keys(words: pa.Array, raw: Iterable[bytes]) -> pa.Array:
    """The keys of words that are also given as bytes."""
    if (pc.max(pc.binary_length(words)).as_py() or 0) > LONG_WORD:
        return pa.array([word_key(w) for w in raw], pa.binary())
    return words.cast(pa.binary())


@dataclass
class Network:
    """Tables (one row per class and the pad) of each offset, and the output layer."""

    tables: np.ndarray  # offsets, CLASSES + 1, HIDDEN
    output: np.ndarray  # HIDDEN, CLASSES
    bias: np.ndarray  # CLASSES
    room: np.ndarray = field(default_factory=lambda: np.empty((max(STEP, CHUNK), CLASSES), np.float32), repr=False)

    @classmethod
    def start(cls, counts: np.ndarray) -> Network:
        """Small random tables; the output's bias is the log-share of each class."""
        rng = np.random.default_rng(SEED)
        share = (counts + 1.0) / (counts.sum() + len(counts))
        return cls(
            (0.1 * rng.standard_normal((len(OFFSETS), CLASSES + 1, HIDDEN))).astype(np.float32),
            (0.1 * rng.standard_normal((HIDDEN, CLASSES))).astype(np.float32),
            np.log(share).astype(np.float32),
        )

    def flat(self) -> np.ndarray:
        return np.concatenate([self.tables.ravel(), self.output.ravel(), self.bias])

    @classmethod
    def of(cls, flat: np.ndarray) -> Network:
        flat = flat.astype(np.float32)
        a = len(OFFSETS) * (CLASSES + 1) * HIDDEN
        b = a + HIDDEN * CLASSES
        return cls(
            flat[:a].reshape(len(OFFSETS), CLASSES + 1, HIDDEN).copy(),
            flat[a:b].reshape(HIDDEN, CLASSES).copy(),
            flat[b:].copy(),
        )

    def hidden(self, line: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The hidden layer at each place, and a last column of ones that meets the bias."""
        total = self.tables[0].take(line[at + OFFSETS[0]], axis=0)
        for table, offset in zip(self.tables[1:], OFFSETS[1:]):
            total += table.take(line[at + offset], axis=0)
        h = np.ones((len(at), HIDDEN + 1), np.float32)
        np.tanh(total, out=h[:, :-1])
        return h

    def weights(self, h: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(exp of each class's logit, their sum by row, the logit of the class ``own``).

        All logits of a row are lowered by its largest one where sums would leave the range of floats. The
        first array is only good until the next call.
        """
        layer = np.vstack([self.output, self.bias])
        e = np.matmul(h, layer, out=self.room[: len(h)] if len(h) <= len(self.room) else None)
        rows = np.arange(len(h))
        mine = e[rows, own]
        with np.errstate(over="ignore"):
            np.exp(e, out=e)
            total = e @ ONES
        if not (total.min(initial=1) > SAFE[0] and total.max(initial=1) < SAFE[1]):
            np.matmul(h, layer, out=e)
            e -= e.max(axis=1, keepdims=True)
            mine = e[rows, own]
            np.exp(e, out=e)
            total = e @ ONES
        return e, total, mine

    def log_probs(self, line: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Log-probability of the token at each place of ``line`` given its neighbours."""
        out = np.empty(len(at), np.float64)
        for k in range(0, len(at), CHUNK):
            part = at[k : k + CHUNK]
            _, total, mine = self.weights(self.hidden(line, part), line[part])
            out[k : k + CHUNK] = mine - np.log(total)
        return out

    def gradient(self, line: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        h, own = self.hidden(line, at), line[at]
        e, total, _ = self.weights(h, own)
        # e / (rows * total) is the gradient of the logits; the thin factors are divided, not e
        e[np.arange(len(at)), own] -= total
        scale = (1 / (len(at) * total))[:, None]
        back = e @ self.output.T
        back *= scale * (1 - h[:, :-1] ** 2)
        layer = (h * scale).T @ e
        # a complex number adds two cells at once
        twos = back.astype(np.float64).view(np.complex128).ravel()
        tables = np.zeros((len(OFFSETS), TWOS.size), np.complex128)
        for table, offset in zip(tables, OFFSETS):
            np.add.at(table, TWOS.take(line[at + offset], axis=0).ravel(), twos)
        return tables.view(np.float64).astype(np.float32).reshape(self.tables.shape), layer[:-1], layer[-1]


def padded_line(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(classes with ``SIDE`` pads around every text, places of the tokens, tokens per text)."""
    sizes = np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(sizes + SIDE) - sizes
    line = np.full(int(sizes.sum()) + SIDE * (len(texts) + 1), PAD, np.int64)
    for s, t in zip(starts, texts):
        line[s : s + len(t)] = t
    places = np.flatnonzero(line != PAD)
    return line, places, sizes


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(0, batch.num_rows, rows):
            yield batch.slice(k, rows)


def _word_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.Array] = []

    def taken() -> pa.RecordBatch:
        counts = pa.chunked_array(held).value_counts()
        held.clear()
        words = counts.field("values")
        raw = words.to_numpy(zero_copy_only=False)
        arrays = [word_keys(words, raw), pa.array(word_buckets(raw), pa.int32()), counts.field("counts")]
        return pa.RecordBatch.from_arrays(arrays, names=["word", "bucket", "n"])

    for batch in _slices(batches):
        held.append(split_words(batch.column(0))[0])
        if sum(h.nbytes for h in held) > HELD:
            yield taken()
    if held:
        yield taken()


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(word, bucket, n) of every word of all texts, written to the shared folder."""
    raw = docs.select(F.col(text_col).cast("binary").alias("_raw"))
    counted = raw.mapInArrow(_word_batches, "word binary, bucket int, n bigint")
    return stored(counted.groupBy("word", "bucket").agg(F.sum("n").alias("n")), "words")


def class_map(words: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(class of each bucket, tokens in each class, words in each class) from the counts of all words."""
    sums = np.zeros((2, BUCKETS))
    for r in words.groupBy("bucket").agg(F.sum("n"), F.count(F.lit(1))).collect():  # at most BUCKETS rows
        sums[:, r[0]] = r[1:]
    classes = OWN + np.arange(BUCKETS) % SHARED
    best = np.argsort(-sums[0], kind="stable")[:OWN]
    best = best[sums[0][best] > 0]
    classes[best] = np.arange(len(best))
    counts = np.bincount(classes, sums[0], CLASSES)
    return classes, counts, np.bincount(classes, sums[1], CLASSES)


@dataclass
class Words:
    """Log-counts of words, for their probability within a class."""

    table: DataFrame  # word, n
    head: dict[bytes, int]  # ln(n + 1) of the frequent words, in UNIT
    whole: np.ndarray  # ln(tokens + words + 1) of each class

    @classmethod
    def of(cls, words: DataFrame) -> Words:
        _, tokens, kinds = class_map(words)
        often = frequent(words, float(tokens.sum())).collect()  # at most HEAD rows
        return cls(words, {bytes(r["word"]): units(r["n"]) for r in often}, np.log(tokens + kinds + 1.0))


def frequent(words: DataFrame, tokens: float, most: int | None = None) -> DataFrame:
    """(word, n) of the words found once in ``SHARE`` of ``tokens`` words or more often, at most ``most`` (``HEAD``) of them.

    Where there are more, the rarer ones are left out, by steps of a sixteenth of a doubling.
    """
    often = words.select("word", "n", F.floor(F.log2("n") * 16).alias("step")).where(F.col("n") * SHARE >= tokens)
    steps = sorted(often.groupBy("step").count().collect(), reverse=True)  # some hundred rows
    taken = np.cumsum([r["count"] for r in steps])
    out = [r["step"] for r, n in zip(steps, taken) if n > (HEAD if most is None else most)]
    return often.where(F.col("step") > out[0] if out else F.lit(True)).select("word", "n")


def units(n: int) -> int:
    return int(np.rint(np.log(n + 1.0) * UNIT))


def targets_of(places: np.ndarray, texts: list[np.ndarray], turn: int, rounds: int) -> np.ndarray:
    """The tokens of a round: one in ``rounds`` of each text; the rounds' targets together are all tokens."""
    sizes = np.array([len(t) for t in texts], np.int64)
    first = np.repeat(np.cumsum(sizes) - sizes, sizes)
    phase = np.repeat(np.array([int(t.sum()) + turn for t in texts], np.int64), sizes)
    return places[(np.arange(len(places)) - first + phase) % rounds == 0]


def _train_batches(shared, turn: int, rounds: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, flat = shared.value
        net = Network.of(flat)
        params = (net.tables, net.output, net.bias)
        seen = [np.full_like(p, 1e-3) for p in params]
        targets = 0
        for batch in _slices(batches):
            texts = [classes[buckets(t.as_py())] for t in batch.column(0)]
            line, places, _ = padded_line(texts)
            at = targets_of(places, texts, turn, rounds)
            at = at[np.random.default_rng(len(at) + turn).permutation(len(at))]
            for k in range(0, len(at), STEP):
                part = at[k : k + STEP]
                weight = len(part) / STEP
                for p, g, s in zip(params, net.gradient(line, part), seen):
                    g *= weight
                    s += g * g
                    p -= RATE * g / np.sqrt(s)
            targets += len(at)
        if targets:
            values = net.flat().astype(np.float64) * targets
            arrays = [pa.array(np.arange(len(values))), pa.array(values), pa.array(np.full(len(values), targets))]
            yield pa.RecordBatch.from_arrays(arrays, names=["i", "v", "n"])

    return run


def train(
    docs: DataFrame, text_col: str = "text", rounds: int = ROUNDS, words: DataFrame | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """(class of each bucket, weights) fitted to all documents."""
    sc = docs.sparkSession.sparkContext
    raw = docs.select(F.col(text_col).cast("binary").alias("_raw"))
    classes, counts, _ = class_map(words or word_counts(docs, text_col))
    flat = Network.start(counts).flat()
    for turn in range(rounds):
        shared = sc.broadcast((classes, flat))
        sums = raw.mapInArrow(_train_batches(shared, turn, rounds), "i bigint, v double, n bigint").groupBy("i").agg(
            (F.sum("v") / F.sum("n")).alias("v")
        )
        rows = sums.collect()  # one row per weight, whatever the corpus
        if rows:
            flat = flat.copy()
            flat[[r["i"] for r in rows]] = [r["v"] for r in rows]
    return classes, flat


class Head:
    """The frequent words with their classes and log-counts, each found by one look-up of the word."""

    def __init__(self, classes: np.ndarray, head: dict[bytes, int]):
        self.classes, self.head = classes, head
        words = [w for w in head if len(w) <= LONG_WORD]
        self.places = {w: i for i, w in enumerate(words)}
        self.own = np.append(classes[word_buckets(words)], 0)  # the last is that of words not found
        self.units = np.array([*(head[w] for w in words), 0], np.int64)

    def of(self, texts: pa.Array) -> tuple[list[np.ndarray], np.ndarray, pa.ListArray]:
        """(classes of each text's words, log-counts of its frequent words, its other words with their counts)."""
        words, sizes = split_words(texts)
        coded = words.dictionary_encode()
        raw, code = coded.dictionary.to_numpy(zero_copy_only=False), coded.indices.to_numpy()
        places = np.fromiter(map(self.places.get, raw, repeat(-1)), np.int64, len(raw))
        rare = places < 0
        own, each = self.own[places], self.units[places]
        own[rare] = self.classes[word_buckets(raw[rare])]
        for i in np.flatnonzero(pc.binary_length(coded.dictionary).to_numpy() > LONG_WORD):
            key = word_key(raw[i])
            if key in self.head:
                each[i], rare[i] = self.head[key], False
        ends = np.cumsum(sizes)
        run_sums = np.r_[0, np.cumsum(each[code])]
        pairs = (np.repeat(np.arange(len(sizes)), sizes) * len(raw) + code)[rare[code]]
        pairs, times = np.unique(pairs, return_counts=True)
        row, kind = np.divmod(pairs, max(len(raw), 1))
        rest = pa.StructArray.from_arrays(
            [word_keys(coded.dictionary, raw).take(pa.array(kind)), pa.array(times, pa.int64())], names=["word", "times"]
        )
        offsets = np.searchsorted(row, np.arange(len(sizes) + 1))
        return (
            np.split(own[code], ends[:-1]), run_sums[ends] - run_sums[ends - sizes],
            pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), rest),
        )


def _score_batches(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (classes, flat), words, whole = shared.value
        net = Network.of(flat)
        head = Head(classes, words or {})
        for batch in _slices(batches):
            carried = batch.num_columns - 1
            texts, known, rest = head.of(batch.column(carried))
            line, places, sizes = padded_line(texts)
            log_probs = net.log_probs(line, places)
            if whole is not None:
                log_probs -= whole[line[places]]
            run_sums = np.r_[0.0, np.cumsum(log_probs)]
            ends = np.cumsum(sizes)
            arrays = [
                *(batch.column(i) for i in range(carried)),
                pa.array(sizes, pa.int64()), pa.array(run_sums[ends] - run_sums[ends - sizes], pa.float64()),
            ]
            names = [*batch.schema.names[:-1], "n_tokens", "log_likelihood"]
            if whole is not None:
                arrays += [pa.array(known, pa.int64()), rest]
                names += ["_units", "_rest"]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return run


def score_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None,
    model: tuple[np.ndarray, np.ndarray] | None = None, words: Words | None = None,
) -> DataFrame:
    """(id, carried columns, n_tokens, log_likelihood, mean_log_prob) of every row.

    Without a model, network and word counts are taken from ``docs``. A model without ``words`` scores
    the classes only.
    """
    own = {"n_tokens", "log_likelihood", "mean_log_prob"}
    carry = [id_col, *[c for c in (keep or []) if c != id_col and c not in own]]
    if model is None:
        counted = words.table if words else word_counts(docs, text_col)
        model, words = train(docs, text_col, words=counted), words or Words.of(counted)
    shared = docs.sparkSession.sparkContext.broadcast((model, words and words.head, words and words.whole))
    plain = docs.select(*carry, F.col(text_col).cast("binary").alias("_raw"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema.fields[:-1])
    schema += ", n_tokens bigint, log_likelihood double"
    if words is None:
        scored = plain.mapInArrow(_score_batches(shared), schema)
    else:
        scored = plain.mapInArrow(
            _score_batches(shared), f"{schema}, _units bigint, _rest array<struct<word: binary, times: bigint>>"
        )
        scored = stored(scored.withColumn("_row", F.monotonically_increasing_id()), "class-scores")
        units_of = F.rint(F.log(F.col("n") + 1.0) * UNIT).cast("long")
        rest = scored.select("_row", F.inline("_rest")).join(words.table.select("word", units_of.alias("_each")), "word")
        sums = rest.groupBy("_row").agg(F.sum(F.col("times") * F.col("_each")).alias("_more"))
        known = (F.col("_units") + F.coalesce("_more", F.lit(0))) / UNIT
        scored = scored.drop("_rest").join(sums, "_row", "left").withColumn("log_likelihood", F.col("log_likelihood") + known)
    return scored.select(
        *carry, "n_tokens", "log_likelihood",
        F.when(F.col("n_tokens") > 0, F.col("log_likelihood") / F.col("n_tokens")).alias("mean_log_prob"),
    )
