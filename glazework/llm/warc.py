"""WARC archives as a chunked record table (operator 11).

:func:`read_chunks` streams archives into rows of (record, chunk number): a payload of any size
becomes chunks of bounded size, each with the length and SHA-1 of the payload up to its end, so
no task ever holds a record. :func:`records` keeps the last chunk of each, which has the whole
digest. :func:`write_archives` is the way back: rows with a payload become chunk rows, and
those are appended to archives as they come.

Equal payloads from ``min_revisit`` bytes on are stored once: of their rows, the one with the largest
id is the response (a tie in the id goes to the largest url, one of wholly equal rows to
one of them), the others become revisit records, which name it.

Defined results: a null payload is empty; a null id or url is left out of the record and read back as null, and
a null id is the smallest; ids and urls come back with control characters percent-encoded and without outer
spaces; repeated rows give a record each; payloads of any length are written and read whole; an empty table gives
no archive and no rows. Other columns of the input, whatever their names, are ignored. A damaged
archive raises an error that names it.

Scale: no text is shuffled. A first pass keeps digests only; payloads that occur twice or more are found by hash
aggregate (hot ones merge before the shuffle) and joined to the second pass, by broadcast where their table is
proven small, else by a shuffle with skew splitting. An archive is written under a name of its task
attempt, and only the manifest, which Spark commits, tells which ones count: what a lost or doubled task leaves
is never read. Archives end at ``archive_bytes``, and each is read by one task as a stream.
"""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glazework.session import broadcast_if_small

from .common import stored
from .warc_format import CHUNK, ROW_ID, ArchiveWriter, digest_hex, payload_chunks, read_records, record_head

MANIFEST = "archive string, n_records bigint, n_bytes bigint"
CHUNK_ROWS = (
    "archive string, record_no bigint, record_id string, record_type string, row_id string, url string, "
    "refers_to string, stated_sha1 string, stated_bytes bigint, chunk_no bigint, data binary, "
    "bytes_so_far bigint, sha1_so_far string, is_last boolean"
)
#: Bytes of chunks that a reader gathers before it hands them on.
BATCH_BYTES = 1 << 22


def _record_id(*parts: Column) -> Column:
    """A record id made from a row; it names a response without asking where that was written."""
    text = F.concat_ws("|", *[F.coalesce(F.concat(F.lit("="), p.cast("string")), F.lit("-")) for p in parts])
    h = F.sha2(text, 256)
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat(F.lit("urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in cuts]))


def payload_heads(pages: DataFrame, id_col: str, url_col: str, payload_col: str) -> DataFrame:
    """(_id, _url, _payload, _bytes, _sha1, _check) of every row."""
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    return pages.select(
        F.col(id_col).alias("_id"),
        F.col(url_col).cast("string").alias("_url"),
        payload.alias("_payload"),
        F.octet_length(payload).cast("bigint").alias("_bytes"),
        F.sha1(payload).alias("_sha1"),
        F.xxhash64(payload).alias("_check"),
    )


def repeated_payloads(heads: DataFrame, min_revisit: int) -> DataFrame:
    """Payloads of two rows or more, with the row that stays (``_top``) and how many rows equal it."""
    payload = ["_bytes", "_sha1", "_check"]
    equal = (
        heads.where(F.col("_bytes") >= min_revisit).groupBy(*payload, "_id", "_url").agg(F.count(F.lit(1)).alias("_n"))
    )
    top = F.struct(F.col("_id").alias("id"), F.col("_url").alias("url"), F.col("_n").alias("n"))
    groups = equal.groupBy(*payload).agg(F.sum("_n").alias("_rows"), F.max(top).alias("_top"))
    return groups.where(F.col("_rows") > 1)


def record_rows(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_revisit: int = 1000
) -> DataFrame:
    """(_kind, _id, _url, _payload, _bytes, _sha1, _record, _refers) of the record of every row.

    ``_record`` is set for responses that others may refer to; a revisit's payload is null.
    """
    heads = payload_heads(pages, id_col, url_col, payload_col)
    repeated = stored(repeated_payloads(heads.drop("_payload"), min_revisit), "repeated-payloads")
    named = lambda i, u: _record_id(i, u, F.col("_bytes"), F.col("_sha1"))
    rows = heads.join(broadcast_if_small(repeated), ["_bytes", "_sha1", "_check"], "left")
    top = F.col("_top")
    is_top = F.col("_id").eqNullSafe(top["id"]) & F.col("_url").eqNullSafe(top["url"])
    kind = F.when(top.isNull() | is_top, "response").otherwise("revisit")
    columns = ["_kind", "_id", "_url", "_payload", "_bytes", "_sha1", "_record", "_refers"]
    revisit = F.col("_kind") == "revisit"
    rows = rows.withColumn("_kind", kind).withColumns({
        "_payload": F.when(~revisit, F.col("_payload")),
        "_record": F.when(~revisit & (F.col("_bytes") >= min_revisit), named(F.col("_id"), F.col("_url"))),
        "_refers": F.when(revisit, named(top["id"], top["url"])),
    })
    several = repeated.where(F.col("_top.n") > 1)
    if several.isEmpty():
        return rows.select(*columns)
    # wholly equal rows lead a group: one of them is the response, the others are written as revisits of it
    tied = F.coalesce((F.col("_kind") == "response") & (F.col("_top.n") > 1), F.lit(False))
    one = rows.where(tied).groupBy("_bytes", "_sha1", "_check").agg(
        *[F.first(c).alias(c) for c in columns if c not in ("_bytes", "_sha1")]
    )
    again = several.select(
        F.lit("revisit").alias("_kind"), top["id"].alias("_id"), top["url"].alias("_url"),
        F.lit(None).cast("binary").alias("_payload"), "_bytes", "_sha1",
        F.lit(None).cast("string").alias("_record"), named(top["id"], top["url"]).alias("_refers"),
        F.explode(F.sequence(F.lit(2).cast("bigint"), top["n"])).alias("_copy"),
    )
    return rows.where(~tied).select(*columns).unionByName(one.select(*columns)).unionByName(again.select(*columns))


def chunk_rows(rows: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """A row for each chunk of each record, in order within its task; one at least."""
    last = F.greatest(F.ceil(F.coalesce(F.octet_length("_payload"), F.lit(0)) / chunk).cast("int") - 1, F.lit(0))
    pieces = F.transform(
        F.sequence(F.lit(0), last), lambda i: F.substring(F.col("_payload"), i * chunk + 1, F.lit(chunk))
    )
    return rows.select(
        "_kind", F.col("_id").cast("string").alias("_id"), "_url", "_bytes", "_sha1", "_record", "_refers",
        F.posexplode(pieces).alias("_chunk", "_data"),
    )


def _append_batches(out: str, date: str, archive_bytes: int, gzip: bool):
    """Task: appends the chunk rows to archives of its own and returns their names and sizes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = arrow_fs.FileSystem.from_uri(out)
        store.create_dir(folder, recursive=True)
        done, stream, archive, name = [], None, None, ""
        n_records = 0

        def close() -> None:
            archive.end()
            stream.close()
            done.append((f"{out}/{name}", n_records, archive.size))

        for batch in batches:
            kinds, ids, urls, sizes, shas, records, refers, chunks, datas = (
                batch.column(i) for i in range(batch.num_columns)
            )
            for i, number in enumerate(chunks.to_pylist()):
                if number == 0:
                    if stream is not None and archive.size >= archive_bytes:
                        close()
                        stream = None
                    if stream is None:
                        name = f"pages-{uuid.uuid4().hex}.warc" + ".gz" * gzip
                        stream, n_records = store.open_output_stream(f"{folder}/{name}", compression=None), 0
                        archive = ArchiveWriter(stream, gzip)
                    else:
                        archive.end()
                    record = records[i].as_py() or f"urn:uuid:{uuid.uuid4()}"
                    archive.begin(record_head(
                        kinds[i].as_py(), record, date, sizes[i].as_py(), shas[i].as_py(),
                        ids[i].as_py(), urls[i].as_py(), refers[i].as_py(),
                    ))
                    n_records += 1
                if datas[i].is_valid:
                    archive.write(datas[i].as_buffer())
        if stream is not None:
            close()
        for row in done:
            yield pa.RecordBatch.from_pylist([dict(zip(("archive", "n_records", "n_bytes"), row))])

    return run


def write_archives(
    pages: DataFrame, out: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
    min_revisit: int = 1000, archive_bytes: int = 1 << 30, chunk: int = CHUNK, gzip: bool = True,
) -> DataFrame:
    """Writes a record for each row into archives under the folder ``out``; returns the manifest.

    The manifest (archive, n_records, n_bytes) is also kept as ``out``/manifest; it alone says which
    archives count. ``out`` may be in any store that pyarrow opens, and must be seen by all executors.
    """
    date = datetime.datetime.now(datetime.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    rows = chunk_rows(record_rows(pages, id_col, url_col, payload_col, min_revisit), chunk)
    manifest = rows.mapInArrow(_append_batches(out.rstrip("/"), date, archive_bytes, gzip), MANIFEST)
    manifest.write.mode("append").parquet(f"{out.rstrip('/')}/manifest")
    return pages.sparkSession.read.schema(MANIFEST).parquet(f"{out.rstrip('/')}/manifest")


def _chunk_batches(chunk: int):
    names = [c.split()[0] for c in CHUNK_ROWS.split(", ")]
    kinds = {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_()}
    types = [kinds[c.split()[1]] for c in CHUNK_ROWS.split(", ")]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    def rows_of(path: str) -> Iterator[tuple]:
        store, inside = arrow_fs.FileSystem.from_uri(path)
        with store.open_input_stream(inside, compression=None) as stream:
            for number, (fields, block) in enumerate(read_records(stream)):
                is_http = fields.get("content-type", "").lower().startswith("application/http")
                http = block.http_head() if is_http else {}
                stated = http.get("content-length", "")
                bare = lambda key: fields[key].strip("<>") if key in fields else None
                head = (
                    path, number, bare("warc-record-id"), fields.get("warc-type"), fields.get(ROW_ID.lower()),
                    fields.get("warc-target-uri"), bare("warc-refers-to"),
                    digest_hex(fields.get("warc-payload-digest")), int(stated) if stated.isdigit() else None,
                )
                for part in payload_chunks(block, chunk):
                    yield (*head, *part)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows, size = [], 0
                try:
                    for row in rows_of(path):
                        rows.append(row)
                        size += len(row[10]) + 500
                        if size >= BATCH_BYTES:
                            yield batch_of(rows)
                            rows, size = [], 0
                except (ValueError, EOFError) as error:
                    raise ValueError(f"{path}: {error}") from error
                if rows:
                    yield batch_of(rows)

    return run


def read_chunks(archives: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """The chunk table of archives (column ``archive``: their paths), as ``CHUNK_ROWS``.

    An archive is read by one task as a stream. Bodies come as they are stored (no transfer decoding).
    """
    paths = archives.select("archive")
    n = paths.count()  # of the manifest's rows
    return paths.repartitionByRange(max(1, n), "archive").mapInArrow(_chunk_batches(chunk), CHUNK_ROWS)


def records(chunks: DataFrame) -> DataFrame:
    """One row for each record: its last chunk, which has the length and digest of the whole payload.

    A revisit has the length and digest that its head states. ``digest_ok``: the payload's digest is the
    stated one (null where none is stated, and for revisits).
    """
    revisit = F.col("record_type") == "revisit"
    return chunks.where("is_last").select(
        "archive", "record_no", "record_id", "record_type", "row_id", "url", "refers_to",
        F.when(revisit, F.col("stated_bytes")).otherwise(F.col("bytes_so_far")).alias("payload_bytes"),
        F.when(revisit, F.col("stated_sha1")).otherwise(F.col("sha1_so_far")).alias("payload_sha1"),
        F.when(~revisit, F.col("stated_sha1") == F.col("sha1_so_far")).alias("digest_ok"),
        (F.col("chunk_no") + 1).alias("n_chunks"),
    )


def with_referred(recs: DataFrame) -> DataFrame:
    """``recs`` with ``refers_row``, the row id of the response that a revisit names (else null)."""
    revisits = recs.where(F.col("record_type") == "revisit")
    named = recs.where(F.col("record_type") == "response").select(
        F.col("record_id").alias("_named"), F.col("row_id").alias("refers_row")
    )
    found = revisits.join(named, revisits["refers_to"] == named["_named"], "left").drop("_named")
    others = recs.where(~F.col("record_type").eqNullSafe("revisit"))
    return others.withColumn("refers_row", F.lit(None).cast("string")).unionByName(found)


#: The operator's result on ``pages``, from the table itself.
ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
g AS (SELECT html, max(page_id) AS top FROM p GROUP BY html)
SELECT p.page_id, strlen(p.html)::BIGINT AS payload_bytes, sha1(p.html) AS payload_digest,
  CASE WHEN strlen(p.html) < 1000 OR p.page_id = g.top THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN strlen(p.html) >= 1000 AND p.page_id <> g.top THEN g.top END AS refers_to
FROM p JOIN g USING (html)
"""
