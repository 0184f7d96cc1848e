"""Operator 11: round trips through archives on disk."""

import gzip
import hashlib
import io
import random

import pytest
from pyspark.sql import functions as F

from glazework.llm import warc as WA
from glazework.llm import warc_format as WF
from glazework.llm.queries import ORACLE_SQL, QUERIES
from tests.conftest import SF_SMALL
from tests.llm.conftest import ODD

PAGES = "page_id bigint, url string, html string"


def write(spark, folder, rows, schema=PAGES, extra=(), **kw):
    df = spark.createDataFrame(rows, schema).repartition(3)
    return WA.write_archives(df.selectExpr("*", *extra), str(folder), **kw)


def sha(text):
    return hashlib.sha1((text or "").encode()).hexdigest()


def test_query_against_sql(spark):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{SF_SMALL}/pages.parquet'")
    got = QUERIES["op11_warc"](spark, SF_SMALL)
    want = con.sql(ORACLE_SQL["op11_warc"])
    assert sorted(map(tuple, got.select(*want.columns).collect()), key=str) == sorted(want.fetchall(), key=str)


@pytest.mark.parametrize("packed", [True, False])
def test_odd_payloads_come_back_whole(spark, tmp_path, packed):
    texts = [*ODD, "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n", "\r\n\r\n" * 900, "é" * 2500]
    rows = [(i if i else None, None if i == 1 else f"http://a/{i}\r\nX: y é", t) for i, t in enumerate(texts)]
    clash = ["1 AS _id", "'x' AS archive", "'y' AS _payload", "2 AS record_type"]
    found = write(spark, tmp_path / "a", rows, extra=clash, chunk=100, gzip=packed)
    chunks = WA.read_chunks(found, chunk=64)
    by = {}
    for r in chunks.orderBy("archive", "record_no", "chunk_no").collect():
        by.setdefault((r["archive"], r["record_no"]), []).append(r)
    assert len(by) == len(rows)
    got = {}
    for parts in by.values():
        data = b"".join(bytes(p["data"]) for p in parts)
        assert [p["chunk_no"] for p in parts] == list(range(len(parts)))
        assert all(len(p["data"]) == 64 for p in parts[:-1]) and [p["is_last"] for p in parts] == [False] * (len(parts) - 1) + [True]
        so_far = b""
        for p in parts:
            so_far += bytes(p["data"])
            assert (p["bytes_so_far"], p["sha1_so_far"]) == (len(so_far), hashlib.sha1(so_far).hexdigest())
        got[parts[0]["row_id"]] = (data.decode(), parts[0]["url"])
    assert got == {
        (str(i) if i else None): (t or "", None if i == 1 else f"http://a/{i}%0D%0AX: y é") for i, t in enumerate(texts)
    }
    recs = WA.records(chunks).collect()
    assert len({r["record_id"] for r in recs}) == len(rows) and all(r["digest_ok"] for r in recs)


def brute(rows, least):
    """Multiset of (id, type, bytes, sha1, id referred to), from the rows alone."""
    groups = {}
    for page, url, text in rows:
        groups.setdefault(text or "", []).append((page, url))
    out = []
    for text, members in groups.items():
        members.sort(key=lambda m: (m[0] is not None, m[0] or 0, m[1] is not None, m[1] or ""))
        size = len(text.encode())
        for i, (page, _) in enumerate(members):
            again = size >= least and i < len(members) - 1
            out.append((page, "revisit" if again else "response", size, sha(text), members[-1][0] if again else None))
    return sorted(out, key=str)


def test_revisits_ties_and_repeated_rows(spark, tmp_path):
    draw = random.Random(3)
    texts = ["a" * 1000, "b" * 999, "é" * 500, "hot " * 400, None, ""]
    rows = [(draw.choice([None, 1, 2, 3, 40]), draw.choice([None, "u", "v"]), draw.choice(texts)) for _ in range(300)]
    rows += [(9, "w", "hot " * 400)] * 100  # one row a hundred times, on top of its group
    recs = WA.with_referred(WA.records(WA.read_chunks(write(spark, tmp_path / "a", rows))))
    got = recs.collect()
    number = lambda t: None if t is None else int(t)
    assert sorted(
        ((number(r["row_id"]), r["record_type"], r["payload_bytes"], r["payload_sha1"], number(r["refers_row"])) for r in got),
        key=str,
    ) == brute(rows, 1000)
    ids = {r["record_id"]: r["record_type"] for r in got}
    assert len(ids) == len(rows) and all(ids[r["refers_to"]] == "response" for r in got if r["refers_to"])


def test_shuffle_join_gives_the_same(spark, tmp_path, monkeypatch):
    rows = [(i, f"u{i}", "x" * (1000 + i % 7)) for i in range(60)]
    monkeypatch.setattr(WA, "broadcast_if_small", lambda df: df.hint("merge"))
    recs = WA.with_referred(WA.records(WA.read_chunks(write(spark, tmp_path / "a", rows)))).collect()
    assert sorted(((int(r["row_id"]), r["record_type"]) for r in recs)) == sorted((b[0], b[1]) for b in brute(rows, 1000))


def test_empty_table_rolled_archives_and_left_files(spark, tmp_path):
    none = write(spark, tmp_path / "none", [(1, "u", "x")]).where("false")
    assert WA.read_chunks(none).collect() == []
    assert write(spark, tmp_path / "empty", [], schema=PAGES).collect() == []
    found = write(spark, tmp_path / "many", [(i, "u", f"text {i}") for i in range(50)], archive_bytes=1, gzip=False)
    assert found.count() == 50
    (tmp_path / "many" / "pages-left-by-a-lost-task.warc").write_bytes(b"WARC/1.1\r\nhalf a rec")
    assert WA.records(WA.read_chunks(found)).count() == 50


FOREIGN = (
    b"WARC/1.0\nwarc-type: warcinfo\nwarc-record-id: <urn:uuid:1>\ncontent-length: 5\n\nhello\n\n"
    b"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:uuid:2>\r\nContent-Type: text/plain\r\n"
    b"WARC-Payload-Digest: sha1:" + hashlib.sha1(b"abc\r\n\r\n").hexdigest().encode() + b"\r\nContent-Length: 7\r\n\r\nabc\r\n\r\n\r\n\r\n"
    b"WARC/1.0\r\nWARC-Type: response\r\nContent-Type: application/http\r\nContent-Length: 19\r\n\r\nHTTP/1.1 200 OK\r\n\r\n\r\n\r\n"
)


@pytest.mark.parametrize("pack", [bytes, gzip.compress], ids=["plain", "one member"])
def test_archives_of_others(spark, tmp_path, pack):
    path = tmp_path / "x.warc"
    path.write_bytes(pack(FOREIGN))
    df = spark.createDataFrame([(str(path),)], "archive string")
    out = WA.records(WA.read_chunks(df)).orderBy("record_no").collect()
    assert [(r["record_type"], r["payload_bytes"], r["digest_ok"]) for r in out] == [("warcinfo", 5, None), ("resource", 7, True), ("response", 0, None)]


@pytest.mark.parametrize("cut", [30, 70, 200])
@pytest.mark.parametrize("pack", [bytes, gzip.compress], ids=["plain", "gzip"])
def test_damaged_archive_is_named(spark, tmp_path, cut, pack):
    path = tmp_path / "broken.warc"
    path.write_bytes(pack(FOREIGN)[:cut])
    with pytest.raises(Exception, match="broken.warc"):
        WA.read_chunks(spark.createDataFrame([(str(path),)], "archive string")).collect()


class Slow(io.RawIOBase):
    """An endless-looking payload that counts what is asked of it."""

    def __init__(self, head, size):
        self.head, self.left, self.asked = head, size, 0

    def read(self, n):
        self.asked = max(self.asked, n)
        if self.head:
            out, self.head = self.head[:n], self.head[n:]
            return out
        n = min(n, self.left)
        self.left -= n
        return b"z" * n


def test_a_long_payload_is_never_whole_in_memory():
    import tracemalloc

    size = 200 << 20
    head = f"WARC/1.1\r\nWARC-Type: resource\r\nContent-Length: {size}\r\n\r\n".encode()
    tracemalloc.start()
    last = None
    for _, block in WF.read_records(Slow(head, size)):
        for last in WF.payload_chunks(block):
            pass
    assert tracemalloc.get_traced_memory()[1] < 8 << 20
    tracemalloc.stop()
    assert last.is_last and last.bytes_so_far == size and last.number == size // WF.CHUNK - 1


def test_chunks_of_a_row_follow_each_other(spark):
    df = spark.createDataFrame([(1, "u", "abcdefg" * 100)], PAGES)
    out = WA.chunk_rows(WA.record_rows(df), 64).withColumn("n", F.octet_length("_data")).collect()
    assert [r["_chunk"] for r in out] == list(range(11)) and sum(r["n"] for r in out) == 700
