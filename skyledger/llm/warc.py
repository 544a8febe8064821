"""Pages as WARC archives, and a sequential reader that checks what it reads.

Writing: a record for each page, one gzip member for each record. Of pages whose payloads
are equal (and at least ``revisit_bytes`` long) the one with the largest id is written
whole, the others as ``revisit`` records that refer to it. Tasks write archives of bounded
size under the given folder and return their paths; a path counts only once its task has
ended well, so files of lost attempts are never read.

Reading: each archive is one pass over a stream: members are inflated piece by piece,
headers end at the blank line, the block is as long as its content length says, and block
and payload digests are recomputed and compared. A damaged record is an error.

Null pages are empty payloads; a null id is kept as null and counts as smaller than any
other; null addresses are empty. Rows with the same id and payload are equal records, all
of one type. No pages, no archives.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from urllib.parse import quote
from uuid import uuid4

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import small_batches
from skyledger.session import materialize, shared_dir

ARCHIVE_BYTES = 64_000_000
CHUNK = 1 << 16
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NO_ID = "none"
WRITTEN = "path string, records long, bytes long"
READ = "page_id bigint, url string, record_type string, refers_to bigint, payload_bytes long, payload_digest string, payload binary"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _member(headers: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{name}: {value}\r\n" for name, value in headers)
    record = f"WARC/1.1\r\n{head}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"
    return gzip.compress(record, compresslevel=6, mtime=0)


def _urn(page_id: int | None) -> str:
    return f"<urn:page:{NO_ID if page_id is None else page_id}>"


def _id(urn: str) -> int | None:
    text = urn.strip("<>").rpartition(":")[2]
    return None if text == NO_ID else int(text)


def record_of(page_id: int | None, url: str, payload: bytes, refers_to: int | None, is_revisit: bool) -> bytes:
    """One gzip member. A revisit keeps the digest and the length of its payload, not the payload."""

    answer = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = answer if is_revisit else answer + payload
    headers = [
        ("WARC-Type", "revisit" if is_revisit else "response"), ("WARC-Record-ID", _urn(page_id)), ("WARC-Date", DATE),
        ("WARC-Target-URI", quote(url, safe="!#$%&'()*+,/:;=?@[]~")),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", f"sha1:{base32_sha1(payload)}"), ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"),
    ]
    if is_revisit:
        headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _urn(refers_to))]
    return _member(headers, block)


@dataclass
class Record:
    headers: dict[str, str] = field(default_factory=dict)
    block: bytes = b""


class Inflated:
    """The inflated bytes of a stream of gzip members, member by member."""

    def __init__(self, stream, chunk: int = CHUNK):
        self.stream, self.chunk, self.rest = stream, chunk, b""
        self.inflate, self.out, self.done = None, bytearray(), False

    def next_member(self) -> bool:
        """Go to the next member; False at the end of the stream."""

        if not self.rest:
            self.rest = self.stream.read(self.chunk)
        self.inflate, self.out, self.done = zlib.decompressobj(wbits=31), bytearray(), False
        return bool(self.rest)

    def _more(self) -> bool:
        if self.done:
            return False
        data = self.rest or self.stream.read(self.chunk)
        if not data:
            raise ValueError("the archive ends inside a record")
        self.out += self.inflate.decompress(data)
        self.rest, self.done = self.inflate.unused_data, self.inflate.eof
        return True

    def until(self, mark: bytes) -> bytes:
        start = 0
        while (at := self.out.find(mark, start)) < 0:
            start = max(0, len(self.out) - len(mark) + 1)
            if not self._more():
                raise ValueError("a record without the end of its header")
        found = bytes(self.out[:at])
        del self.out[:at + len(mark)]
        return found

    def exactly(self, size: int) -> bytes:
        while len(self.out) < size:
            if not self._more():
                raise ValueError("a record shorter than its content length")
        found = bytes(self.out[:size])
        del self.out[:size]
        return found

    def end_of_member(self) -> None:
        while self._more():
            pass
        if self.out:
            raise ValueError("bytes after the end of a record")


def records_in(stream, chunk: int = CHUNK) -> Iterator[Record]:
    """The records of one archive in order; a digest, length or frame that does not fit is an error."""

    data = Inflated(stream, chunk)
    while data.next_member():
        version, *lines = data.until(b"\r\n\r\n").decode().split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError(f"not a record: {version[:40]!r}")
        headers = {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines)}
        block = data.exactly(int(headers["content-length"]))
        if data.exactly(4) != b"\r\n\r\n":
            raise ValueError("a record longer than its content length")
        data.end_of_member()
        if headers["warc-block-digest"] != f"sha1:{base32_sha1(block)}":
            raise ValueError(f"block digest of {headers['warc-record-id']}")
        yield Record(headers, block)


def page_of(record: Record) -> tuple:
    """(page_id, url, type, refers_to, length, digest, payload) with the payload's digest checked."""

    head, _, payload = record.block.partition(b"\r\n\r\n")
    kind, digest = record.headers["warc-type"], record.headers["warc-payload-digest"].removeprefix("sha1:")
    length = next(int(line.partition(b":")[2]) for line in head.split(b"\r\n") if line.lower().startswith(b"content-length:"))
    if kind == "response" and (length != len(payload) or digest != base32_sha1(payload)):
        raise ValueError(f"payload of {record.headers['warc-record-id']}")
    refers_to = _id(record.headers["warc-refers-to"]) if kind == "revisit" else None
    return (_id(record.headers["warc-record-id"]), record.headers["warc-target-uri"], kind, refers_to, length, digest,
            payload if kind == "response" else None)


def _writer(folder: str, archive_bytes: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = fs.FileSystem.from_uri(folder)
        out, path, records, size = None, "", 0, 0

        def closed() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_pydict({"path": [path], "records": [records], "bytes": [size]})

        for batch in batches:
            for page_id, url, html, refers_to, is_revisit in zip(*(column.to_pylist() for column in batch.columns)):
                if out is None:
                    path, records, size = f"{base}/{uuid4().hex}.warc.gz", 0, 0
                    out = system.open_output_stream(path)
                member = record_of(page_id, url or "", html or b"", refers_to, is_revisit)
                out.write(member)
                records, size = records + 1, size + len(member)
                if size >= archive_bytes:
                    yield closed()
                    out = None
        if out is not None:
            yield closed()

    return run


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                   revisit_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write the archives now; returns (path, records, bytes) of each."""

    spark = pages.sparkSession
    small_batches(spark)
    named = pages.select(
        F.col(f"`{id_col}`").alias("page_id"), F.coalesce(F.col(f"`{url_col}`"), F.lit("")).alias("url"),
        F.coalesce(F.col(f"`{html_col}`"), F.lit("")).cast("binary").alias("html"),
    ).withColumn("digest", F.sha2("html", 256))
    # Only payloads that occur more than once; counting combines within tasks before the shuffle.
    copies = (
        named.filter(F.octet_length("html") >= revisit_bytes).groupBy("digest")
        .agg(F.max("page_id").alias("kept"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    )
    # A page whose payload is very common: the adaptive planner splits its partition of this join.
    decided = named.join(copies, "digest", "left").select(
        "page_id", "url", "html", "kept",
        (F.col("kept").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("kept"))).alias("is_revisit"),
    )
    system, base = fs.FileSystem.from_uri(folder)
    system.create_dir(base, recursive=True)
    return materialize(decided.mapInArrow(_writer(folder, archive_bytes), WRITTEN), "archives")


def _reader(folder: str, chunk: int) -> Callable:
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
    names = [part.split()[0] for part in READ.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = fs.FileSystem.from_uri(folder)
        pack = lambda rows: pa.RecordBatch.from_arrays(
            [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)], names=names)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows, held = [], 0
                with system.open_input_stream(path) as stream:
                    for record in records_in(stream, chunk):
                        rows.append(page_of(record))
                        held += len(record.block)
                        if held > 4_000_000 or len(rows) >= 1000:
                            yield pack(rows)
                            rows, held = [], 0
                if rows:
                    yield pack(rows)

    return run


def read_archives(archives: DataFrame, folder: str, chunk: int = CHUNK) -> DataFrame:
    """The pages in the archives, a task for some archives each."""

    spread = archives.select("path").repartition(max(1, archives.count()), "path")
    return spread.mapInArrow(_reader(folder, chunk), READ)


def archive_folder(spark) -> str:
    """A new folder for archives under the shared one, as an address."""

    folder = f"{shared_dir(spark)}/warc-{uuid4().hex}"
    return folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"
