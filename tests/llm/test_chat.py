"""Operator 9: exact round trips."""

import hashlib

import pytest

from glazework.llm import chat as C
from glazework.llm.byte_bpe import byte_encoder
from glazework.llm.chat_digest import digests
from glazework.llm.queries import BYTE_BPE, EXTRA_TEXT, QUERIES
from tests.conftest import SF_SMALL
from tests.llm.conftest import ODD

TRICKS = [EXTRA_TEXT, C.END, f"{C.TURN}assistant{C.TEXT}x{C.END}", "\\", "<\\|", "<", "|", "<|", "\\\\<||>", "a\n\nb"]


@pytest.mark.parametrize("text", TRICKS + [t or "" for t in ODD])
def test_render_mask_and_back(text):
    turns = [("system", text), ("assistant", text), ("assistant", ""), ("a<|turn|>\n", text), ("assistant", "z" + text), ("user", "")]
    formatted, spans = C.render(turns)
    _, ends = byte_encoder(BYTE_BPE, C.CONTROLS).encode(formatted)
    assert ends[-1] == len(formatted.encode())
    assert C.parse(formatted) == turns
    assert "".join(C.masked_texts(formatted, ends, C.mask_runs(ends, spans))) == text + "z" + text
    assert formatted.count(C.TURN) == formatted.count(C.END) == len(turns)


def want(rows):
    """By conversation: what the query must return, from the rows themselves."""
    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append((turn, role, text or ""))
    out = {}
    for conv, turns in by.items():
        turns.sort(key=lambda t: t[0])
        whole = "".join(f"{r}\n{t}\n" for _, r, t in turns)
        loss = "".join(t for _, r, t in turns if r == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out[conv] = (len(turns), sha(whole), len(loss), sha(loss))
    return out


def test_query_round_trip(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-7, 0, "user", EXTRA_TEXT), (-7, 1, "assistant", EXTRA_TEXT)]
    out = QUERIES["op9_chat"](spark, SF_SMALL).collect()
    assert {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in out} == want(rows)
    assert len(out) == len(want(rows)) and all(0 <= r["n_loss_tokens"] < r["n_tokens"] for r in out)


def test_odd_rows(spark):
    rows = [(1, 2, "assistant", "late"), (1, 1, "user", None), (1, 1, "user", None), (1, None, None, "no turn"),
            (None, 1, "assistant", "no id"), (2, 1, "assistant", "same"), (2, 1, "assistant", "again")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").selectExpr("*", "1 AS formatted")
    out = {r["conv_id"]: r for r in C.format_conversations(df, BYTE_BPE).collect()}
    assert C.parse(out[1]["formatted"]) == [("", "no turn"), ("user", ""), ("user", ""), ("assistant", "late")]
    assert [t for _, t in C.parse(out[2]["formatted"])] == ["again", "same"]  # a tie: by text
    assert out[None]["n_turns"] == 1
    assert digests(C.format_conversations(df.where("false"), BYTE_BPE), BYTE_BPE).collect() == []


def test_long_conversation(spark):
    df = spark.range(3000).selectExpr("7L AS conv_id", "id AS turn", "IF(id % 2 = 0, 'user', 'assistant') AS role", "repeat('word ', 20) AS text")
    r = digests(C.format_conversations(df, BYTE_BPE), BYTE_BPE).first()
    assert r["n_turns"] == 3000 and r["loss_chars"] == 1500 * 100


def test_conversations_in_segments(spark):
    """A long conversation, dealt over tasks and cut, gives what it gives as one row; null ids and ties too."""
    rows = [(c, t, "assistant" if t % 2 else "user", f"{TRICKS[t % len(TRICKS)]} {t % 7} {c}") for c in (5, None) for t in range(400)]
    rows += [(5, 3, None, "a tie"), (5, 3, "user", None), (6, 1, "assistant", "short"), (7, None, "assistant", None)]
    rows += [(8, 1, "assistant", "z" * 3000)] * 3
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(5)
    one = C.format_conversations(df, BYTE_BPE)
    cut = C.format_conversations(df, BYTE_BPE, whole_bytes=4000, segment_chars=500)
    whole = {r["conv_id"]: r for r in one.collect()}
    parts = {}
    for r in cut.orderBy("segment").collect():
        parts.setdefault(r["conv_id"], []).append(r)
    assert all(r["whole"] for r in whole.values()) and parts.keys() == whole.keys()
    assert {c for c, p in parts.items() if not p[0]["whole"]} == {5, None, 8} and min(len(parts[5]), len(parts[None])) > 10
    for conv, r in whole.items():
        assert "".join(p["formatted"] for p in parts[conv]) == r["formatted"]
        assert [i for p in parts[conv] for i in p["token_ids"]] == r["token_ids"]
        runs, base = [], 0
        for p in parts[conv]:
            runs += [(base + a, base + b) for a, b in zip(p["mask_starts"], p["mask_ends"])]
            base += len(p["token_ids"])
        assert runs == list(zip(r["mask_starts"], r["mask_ends"]))
    rows_of = lambda f: sorted(map(tuple, digests(f, BYTE_BPE).collect()), key=str)
    assert rows_of(cut) == rows_of(one) and len(rows_of(one)) == 5


def test_long_conversation_is_dealt_over_tasks(spark):
    df = spark.range(0, 40000, 1, 8).selectExpr(
        "7L AS conv_id", "id AS turn", "IF(id % 2 = 0, 'user', 'assistant') AS role", "repeat('word ', 40) AS text"
    )
    out = C.format_conversations(df, BYTE_BPE)
    assert out.selectExpr("segment >> 32 AS task").distinct().count() > 1 and out.where("whole").isEmpty()
    r = digests(out, BYTE_BPE).collect()
    assert len(r) == 1 and r[0]["n_turns"] == 40000 and r[0]["loss_chars"] == 20000 * 200
