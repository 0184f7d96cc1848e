"""Operator 3: brute-force probabilities, gradients, and that training helps."""

import math

import numpy as np
import pyarrow as pa
import pytest

from glazework.llm import lm_scoring as L
from tests.conftest import SF_MID
from tests.llm.conftest import ODD


@pytest.fixture(scope="module")
def trained(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").repartition(2)
    return docs, L.train(docs)


def slow_score(model, text):
    classes, flat = model
    net = L.Network.of(flat)
    line = classes[L.buckets((text or "").encode())]
    total = 0.0
    for k in range(len(line)):
        z = np.zeros(L.HIDDEN)
        for table, o in zip(net.tables, L.OFFSETS):
            z += table[line[k + o] if 0 <= k + o < len(line) else L.PAD].astype(float)
        logits = np.tanh(z) @ net.output.astype(float) + net.bias
        total += logits[line[k]] - math.log(np.exp(logits - logits.max()).sum()) - logits.max()
    return total


def test_scores_by_brute_force(spark, documents, trained):
    _, model = trained
    texts = ODD[:8] + ODD[9:] + ["the of and " * 50]
    out = {r["doc_id"]: r for r in L.score_documents(documents(texts, extra=["1 AS _raw", "2 AS n_tokens"]), model=model).collect()}
    for i, text in enumerate(texts):
        n = len((text or "").encode().split())
        assert out[i]["n_tokens"] == n
        assert out[i]["log_likelihood"] == pytest.approx(slow_score(model, text), rel=1e-3, abs=1e-3)
        assert (out[i]["mean_log_prob"] is None) == (n == 0)
    assert out[3]["log_likelihood"] == out[4]["log_likelihood"]  # a repeated text


def test_long_text_in_chunks(trained):
    classes, flat = trained[1]
    net = L.Network.of(flat)
    line, places, _ = L.padded_line([classes[L.buckets(b"a b c d " * 6000)]])
    whole = net.log_probs(line, places)
    assert len(whole) == 24_000 > L.CHUNK
    assert np.allclose(whole[L.CHUNK - 5 : L.CHUNK + 5], net.log_probs(line, places[L.CHUNK - 5 : L.CHUNK + 5]), atol=1e-5)


def test_gradient_by_differences():
    rng = np.random.default_rng(1)
    net = L.Network.start(np.ones(L.CLASSES))
    line, places, _ = L.padded_line([rng.integers(0, L.CLASSES, 40)])
    tables, output, bias = net.gradient(line, places)

    def loss():
        return -net.log_probs(line, places).mean()

    for param, grad in ((net.tables, tables), (net.output, output), (net.bias, bias)):
        flat, g = param.reshape(-1), grad.reshape(-1)
        for i in np.argsort(-np.abs(g))[:4]:
            old = flat[i]
            flat[i] = old + 1e-2
            up = loss()
            flat[i] = old - 1e-2
            down = loss()
            flat[i] = old
            assert (up - down) / 2e-2 == pytest.approx(g[i], rel=0.05, abs=1e-4)


def test_training_beats_the_unigram(spark, trained):
    docs, model = trained
    out = L.score_documents(docs, model=model).collect()
    counts = np.zeros(L.CLASSES)
    for r in docs.collect():
        counts += np.bincount(model[0][L.buckets(r["text"].encode())], minlength=L.CLASSES)
    share = counts[counts > 0] / counts.sum()
    unigram = (counts[counts > 0] * np.log(share)).sum() / counts.sum()
    assert sum(r["log_likelihood"] for r in out) / sum(r["n_tokens"] for r in out) > unigram


def test_order_matters(trained):
    """The words of a real text in their order score higher than shuffled."""
    docs, model = trained
    rng = np.random.default_rng(2)
    better = total = 0
    for r in docs.where("n_chars > 800").limit(20).collect():
        words = r["text"].split()
        shuffled = " ".join(rng.permutation(words))
        better += slow_score(model, " ".join(words)) > slow_score(model, shuffled)
        total += 1
    assert better > total / 2


def test_empty_table(spark, documents):
    docs = documents(["x"]).where("false")
    assert L.score_documents(docs).collect() == []


def test_every_word_has_its_own_probability(spark, documents):
    """Class and word in the class, from the counts of all words; a rare word is no other word of its class."""
    texts = [f"the cat sat on the w{i} mat w{i % 40}" for i in range(3000)] + ["x" * 100 + " the", None, "the cat " + "x" * 100]
    docs = documents(texts)
    counted = L.word_counts(docs)
    model, words = L.train(docs, words=counted), L.Words.of(counted)
    n, tokens, kinds = {}, np.zeros(L.CLASSES), np.zeros(L.CLASSES)
    for w in " ".join(t or "" for t in texts).encode().split():
        n[w] = n.get(w, 0) + 1
    of = {w: model[0][L.buckets(w)[0]] for w in n}
    for w, c in n.items():
        tokens[of[w]] += c
        kinds[of[w]] += 1
    same = [w for w in n if of[w] == of[b"w7"] and n[w] != n[b"w7"]] or [b"w7"]
    asked = [*texts[:20], "the zyx", "the cat w7", f"the cat {same[0].decode()}", texts[-3]]

    def slow(text):
        said = (text or "").encode().split()
        classes = [model[0][L.buckets(w)[0]] for w in said]
        return slow_score(model, text) + sum(math.log((n.get(w, 0) + 1) / (tokens[c] + kinds[c] + 1)) for w, c in zip(said, classes))

    few = L.Words(words.table, {w: u for w, u in words.head.items() if w in (b"the", b"cat")}, words.whole)
    for some in (words, few):  # all words sent to the tasks, and most words joined
        out = {r["doc_id"]: r for r in L.score_documents(documents(asked), model=model, words=some).collect()}
        for i, text in enumerate(asked):
            assert out[i]["log_likelihood"] == pytest.approx(slow(text), rel=1e-3, abs=1e-3)
    own = {r["doc_id"]: r["log_likelihood"] for r in L.score_documents(docs).collect()}
    assert len(own) == len(texts) and own[190] < slow_score(model, texts[190]) - 1
    # the words of a class and the unknown word have all of its probability
    for c in set(of.values()):
        assert sum(n[w] + 1 for w in n if of[w] == c) + 1 == pytest.approx(math.exp(words.whole[c]))


def test_every_token_is_a_target_once():
    rng = np.random.default_rng(3)
    texts = [rng.integers(0, L.CLASSES, n) for n in (0, 1, 1, 2, 3, 7, 8, 50)]
    _, places, _ = L.padded_line(texts)
    for rounds in (1, L.ROUNDS, 5):
        turns = [L.targets_of(places, texts, turn, rounds) for turn in range(rounds)]
        assert sorted(np.concatenate(turns)) == sorted(places)


def test_table_gradient_takes_no_copies_of_places():
    """A place's four rows get its whole back-propagated row, also where classes repeat within a step."""
    rng = np.random.default_rng(4)
    net = L.Network.start(np.ones(L.CLASSES))
    line, places, _ = L.padded_line([rng.integers(0, 5, 300), rng.integers(250, L.CLASSES, 7)])
    tables, output, bias = net.gradient(line, places)
    h = net.hidden(line, places).astype(float)
    logits = h @ np.vstack([net.output, net.bias]).astype(float)
    p = np.exp(logits) / np.exp(logits).sum(axis=1, keepdims=True)
    p[np.arange(len(places)), line[places]] -= 1
    p /= len(places)
    back = (p @ net.output.T) * (1 - h[:, :-1] ** 2)
    expected = np.zeros(tables.shape)
    for k, at in enumerate(places):
        for i, offset in enumerate(L.OFFSETS):
            expected[i, line[at + offset]] += back[k]
    assert tables.dtype == np.float32 and np.allclose(tables, expected, atol=1e-6)
    assert np.allclose(output, h[:, :-1].T @ p, atol=1e-6) and np.allclose(bias, p.sum(axis=0), atol=1e-6)


BYTES = [
    b" The cat \xc3\xa9 the\tTHE\x0b\x0c\r\n \x1c\x85 \xc2\xa0x ", None, b"", b" \n", b"\xff\x00 A\xc3 \xe2\x82", b"\xc3\x89TA B", b"x",
    b"x" * L.LONG_WORD + b" " + b"y" * 65 + b" Cat " + b"Z" * 200 + b" " + b"Y" * 65 + b" cat",
]


def test_words_split_as_python_does():
    for kind in (pa.binary(), pa.large_binary()):
        for texts in (pa.array(BYTES * 3, kind), pa.array([b"cut"] + BYTES, kind).slice(1), pa.array([None, b""], kind), pa.array([], kind)):
            words, sizes = L.split_words(texts)
            said = [(t or b"").lower().split() for t in texts.to_pylist()]
            assert words.to_pylist() == [w for ws in said for w in ws]
            assert list(sizes) == [len(ws) for ws in said]


def test_words_are_looked_up_once_each():
    """Classes, log-counts and other words of texts as by hand; long words go by their digests, frequent or not."""
    classes = np.arange(L.BUCKETS) % L.CLASSES
    numbers = {b"the": 5, b"x" * L.LONG_WORD: 7, L.word_key(b"y" * 65): 11}
    for some in (numbers, {}):
        lines, known, rest = L.Head(classes, some).of(pa.array(BYTES, pa.binary()))
        for text, line, total, others in zip(BYTES, lines, known, rest.to_pylist(), strict=True):
            keys = [L.word_key(w) for w in (text or b"").lower().split()]
            assert list(line) == list(classes[L.buckets(text)])
            assert total == sum(some.get(k, 0) for k in keys)
            assert {p["word"]: p["times"] for p in others} == {k: keys.count(k) for k in keys if k not in some}
            assert len(others) == len({p["word"] for p in others})
    lines, known, rest = L.Head(classes, {}).of(pa.array([None, b" "], pa.binary()))
    assert [len(x) for x in lines] == [0, 0] and list(known) == [0, 0] and rest.to_pylist() == [[], []]


def test_words_are_counted_in_arrow(monkeypatch):
    said = [w for t in BYTES for w in (t or b"").lower().split()]
    texts = pa.RecordBatch.from_arrays([pa.array(BYTES * 300, pa.binary())], names=["t"])
    for held in (L.HELD, 1000):
        monkeypatch.setattr(L, "HELD", held)
        found = {}
        for batch in L._word_batches(iter([texts, texts.slice(0, 0)])):
            for r in batch.to_pylist():
                found[r["word"], r["bucket"]] = found.get((r["word"], r["bucket"]), 0) + r["n"]
        assert found == {(L.word_key(w), int(L.buckets(w)[0])): 300 * said.count(w) for w in said}
    assert list(L._word_batches(iter([]))) == []


def test_frequent_words_are_bounded(spark, monkeypatch):
    """Sent to the tasks: words from the share on, and never more than the bound, whatever the vocabulary."""
    words = spark.createDataFrame([(f"w{n}-{k}", n) for n in (1, 2, 40, 41, 1000) for k in range(4)], "word string, n bigint")

    def sent(tokens, most=None):
        return sorted({(r["n"]) for r in L.frequent(words, tokens, most).collect()}), L.frequent(words, tokens, most).count()

    assert sent(2.0 * L.SHARE) == ([2, 40, 41, 1000], 16)
    assert sent(2.0 * L.SHARE, 16) == ([2, 40, 41, 1000], 16)
    assert sent(2.0 * L.SHARE, 15) == ([40, 41, 1000], 12) == sent(40.0 * L.SHARE, 12)
    assert sent(2.0 * L.SHARE, 4) == ([1000], 4)
    assert sent(2.0 * L.SHARE, 3) == ([], 0)
    monkeypatch.setattr(L, "HEAD", 5)
    assert sent(1.0) == ([1000], 4)
