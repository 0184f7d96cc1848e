"""WARC records as byte streams: a writer and a reader that never hold a whole record (operator 11).

Archives are WARC/1.1, one gzip member for each record (or no compression). A page is a record with
an HTTP response as its block; a revisit holds the response's head only, and names the
record that has the payload. The reader takes any archive, in pieces of bounded size.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from typing import NamedTuple

#: Bytes of payload in a row of the chunk table, and of what is read at once.
CHUNK = 1 << 18
#: Longest header line that is read.
LINE_LIMIT = 1 << 20
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_RECORD = "application/http; msgtype=response"
#: Header of this library's archives with the id of the row that a record was written from.
ROW_ID = "X-Row-Id"


def clean_value(text: str) -> str:
    """A header value on one line: control characters are percent-encoded, as in a URL."""
    return "".join(f"%{ord(c):02X}" if ord(c) < 32 or ord(c) == 127 else c for c in text)


def digest_value(sha1_hex: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(sha1_hex)).decode()


def digest_hex(value: str | None) -> str | None:
    """Lower-case hex of a ``sha1:`` digest in base 32 or hex; None for any other."""
    name, _, text = (value or "").strip().partition(":")
    if name.lower() != "sha1":
        return None
    try:
        raw = bytes.fromhex(text) if len(text) == 40 else base64.b32decode(text.upper())
    except ValueError:
        return None
    return raw.hex() if len(raw) == 20 else None


def record_head(
    kind: str, record_id: str, date: str, payload_bytes: int, payload_sha1: str,
    row_id: str | None = None, url: str | None = None, refers_to: str | None = None,
) -> bytes:
    """Everything of a record before its payload; a revisit has none."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {payload_bytes}\r\n\r\n"
    length = len(http) + (payload_bytes if kind == "response" else 0)
    fields = [("WARC-Type", kind), ("WARC-Record-ID", f"<{record_id}>"), ("WARC-Date", date)]
    if url is not None:
        fields.append(("WARC-Target-URI", clean_value(url)))
    if kind == "revisit":
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<{refers_to}>")]
    fields.append(("WARC-Payload-Digest", digest_value(payload_sha1)))
    if row_id is not None:
        fields.append((ROW_ID, clean_value(row_id)))
    fields += [("Content-Type", HTTP_RECORD), ("Content-Length", str(length))]
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n" + http).encode()


class ArchiveWriter:
    """Appends records to a binary stream, piece by piece."""

    def __init__(self, stream, gzip: bool = True):
        self._stream, self._gzip, self._member, self.size = stream, gzip, None, 0

    def _put(self, data: bytes) -> None:
        self._stream.write(data)
        self.size += len(data)

    def begin(self, head: bytes) -> None:
        if self._gzip:
            self._member = zlib.compressobj(1, zlib.DEFLATED, 31)
        self.write(head)

    def write(self, data: bytes) -> None:
        self._put(self._member.compress(data) if self._member else data)

    def end(self) -> None:
        self.write(b"\r\n\r\n")
        if self._member:
            self._put(self._member.flush())


class ByteSource:
    """Lines and pieces of a stream, plain or of gzip members, through a buffer of bounded size."""

    def __init__(self, stream, piece: int = CHUNK):
        self._stream, self._piece = stream, piece
        self._raw = stream.read(piece)
        self._inflate = zlib.decompressobj(31) if self._raw[:2] == b"\x1f\x8b" else None
        self._buffer = bytearray()
        self.ended = False

    def _fill(self) -> bool:
        """More bytes into the buffer; False at the end of the stream."""
        while not self.ended:
            if not self._raw:
                self._raw = self._stream.read(self._piece)
                if not self._raw:
                    if self._inflate and not self._inflate.eof:
                        rest = self._inflate.decompress(b"", self._piece)  # what the bound held back
                        if not rest:
                            raise EOFError("the archive ends inside a gzip member")
                        self._buffer += rest
                        return True
                    self.ended = True
                    break
            if self._inflate is None:
                data, self._raw = self._raw, b""
            else:
                if self._inflate.eof:  # the next member
                    self._inflate = zlib.decompressobj(31)
                data = self._inflate.decompress(self._raw, self._piece)
                self._raw = self._inflate.unused_data if self._inflate.eof else self._inflate.unconsumed_tail
            if data:
                self._buffer += data
                return True
        return False

    def line(self) -> bytes | None:
        """The next line without its end; None at the end of the stream."""
        searched = 0
        while (at := self._buffer.find(b"\n", searched)) < 0:
            searched = len(self._buffer)
            if searched > LINE_LIMIT:
                raise ValueError(f"a header line is longer than {LINE_LIMIT} bytes")
            if not self._fill():
                if not self._buffer:
                    return None
                at = len(self._buffer)
                break
        out = bytes(self._buffer[:at])
        del self._buffer[: at + 1]
        return out.removesuffix(b"\r")

    def read(self, most: int) -> bytes:
        """At least one byte and ``most`` at most; none at the end of the stream only."""
        if not self._buffer and not self._fill():
            return b""
        out = bytes(self._buffer[:most])
        del self._buffer[:most]
        return out


class Block:
    """The bytes of one record's block."""

    def __init__(self, source: ByteSource, length: int):
        self._source, self.left = source, length

    def read(self, most: int) -> bytes:
        if not self.left:
            return b""
        data = self._source.read(min(most, self.left))
        if not data:
            raise EOFError(f"the archive ends {self.left} bytes before the end of a record")
        self.left -= len(data)
        return data

    def http_head(self) -> dict[str, str]:
        """Fields of the HTTP head at the block's start, which is passed over."""
        head = bytearray()
        while self.left and not head.endswith((b"\r\n\r\n", b"\n\n")):
            if len(head) > LINE_LIMIT:
                raise ValueError(f"an HTTP head is longer than {LINE_LIMIT} bytes")
            head += self.read(1)
        return fields_of(bytes(head).split(b"\n")[1:])


class Chunk(NamedTuple):
    number: int
    data: bytes
    bytes_so_far: int
    sha1_so_far: str
    is_last: bool


def fields_of(lines: list[bytes]) -> dict[str, str]:
    """Header fields by lower-case name; the first of a name counts."""
    out: dict[str, str] = {}
    for line in lines:
        name, colon, value = line.decode("utf-8", "replace").partition(":")
        if colon:
            out.setdefault(name.strip().lower(), value.strip())
    return out


def read_records(stream) -> Iterator[tuple[dict[str, str], Block]]:
    """(header fields, block) of each record; what the caller leaves of a block is passed over."""
    source = ByteSource(stream)
    while (line := source.line()) is not None:
        if not line:
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record begins with {line[:40]!r}")
        lines = []
        while line := source.line():
            lines.append(line)
        fields = fields_of(lines)
        length = fields.get("content-length", "")
        if not length.isdigit():
            raise ValueError(f"record {fields.get('warc-record-id')} has no Content-Length")
        block = Block(source, int(length))
        yield fields, block
        while block.read(CHUNK):
            pass


def payload_chunks(block: Block, chunk: int = CHUNK) -> Iterator[Chunk]:
    """The rest of a block in chunks of ``chunk`` bytes (the last may be shorter), one at least.

    Each carries the length and SHA-1 of the payload up to its end, so the last has those
    of the whole; only one chunk is in memory.
    """
    sha, size, number = hashlib.sha1(), 0, 0
    while True:
        data = bytearray()
        while len(data) < chunk and (piece := block.read(chunk - len(data))):
            data += piece
        sha.update(data)
        size += len(data)
        yield Chunk(number, bytes(data), size, sha.hexdigest(), not block.left)
        if not block.left:
            return
        number += 1
