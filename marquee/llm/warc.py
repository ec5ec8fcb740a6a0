"""WARC archives through a chunked record table.

A record's payload is never handled as a whole: it travels as rows (record, chunk number, bytes) of at most
``CHUNK_BYTES``, and each row carries the SHA-1 of the payload up to its end. In the archive every row is a record
of its own, as the format provides for long payloads: the first is the ``response`` with ``WARC-Segment-Number: 1``,
the others are ``continuation`` records that name their origin, the last one with ``WARC-Segment-Total-Length``.

Plan: Spark's text sink writes a row per record with the record separator CRLF CRLF, gzip-compressed, so the tasks need
no file access of their own and any store that Spark can write to will do. Compressed files are not split, so a
task reads a file's pieces in order; a small parser joins them by ``Content-Length``, whatever the payload holds, and
resumes each payload's digest at every segment.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm.text import batches, small_batches
from marquee.session import fresh_path, materialize

CHUNK_BYTES = 1 << 18
SEPARATOR = b"\r\n\r\n"
DATE = "2026-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(digest) -> str:
    return base64.b32encode(digest.digest()).decode()


def _payloads(part: pa.RecordBatch) -> Iterator[tuple[int | None, memoryview]]:
    """(page_id, payload) without copies: views into the Arrow buffer."""
    for key, text in zip(part.column(0).to_pylist(), part.column(1), strict=True):
        buffer = text.as_buffer()
        yield key, memoryview(buffer) if buffer is not None else memoryview(b"")


def _chunks(payload: memoryview, size: int) -> Iterator[memoryview]:
    for at in range(0, max(len(payload), 1), size):
        yield payload[at:at + size]


def payload_digests(pages: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(page_id, payload_digest, payload_bytes), digested chunk by chunk."""
    schema = pa.schema([("page_id", pa.int64()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64())])

    def run(parts):
        def rows():
            for part in parts:
                for key, payload in _payloads(part):
                    digest = hashlib.sha1()
                    for chunk in _chunks(payload, chunk_bytes):
                        digest.update(chunk)
                    yield key, base32_sha1(digest), len(payload)

        yield from batches(schema, rows())

    small_batches(pages)
    return pages.select(F.col("page_id").cast("long"), F.col("html").cast("binary")).mapInArrow(
        run, "page_id bigint, payload_digest string, payload_bytes bigint"
    )


CHUNK = pa.schema([
    ("record_no", pa.int64()), ("page_id", pa.int64()), ("url", pa.string()), ("payload_digest", pa.string()),
    ("payload_bytes", pa.int64()), ("chunk_no", pa.int32()), ("running_digest", pa.string()), ("last", pa.bool_()), ("data", pa.binary()),
])
CHUNK_DDL = (
    "record_no bigint, page_id bigint, url string, payload_digest string, payload_bytes bigint, chunk_no int, "
    "running_digest string, last boolean, data binary"
)


def chunk_table(pages: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """A row per chunk of every page's payload; an empty payload has one empty chunk.

    ``record_no`` tells rows with equal ids apart; it is the task's number and a count within the task.
    """

    def run(parts):
        def rows():
            record = TaskContext.get().partitionId() << 40
            for part in parts:
                urls = part.column(2).to_pylist()
                for (key, payload), url in zip(_payloads(part), urls, strict=True):
                    whole = hashlib.sha1()
                    for chunk in _chunks(payload, chunk_bytes):
                        whole.update(chunk)
                    name, running, done = base32_sha1(whole), hashlib.sha1(), 0
                    for number, chunk in enumerate(_chunks(payload, chunk_bytes)):
                        running.update(chunk)
                        done += len(chunk)
                        yield record, key, url, name, len(payload), number, base32_sha1(running), done == len(payload), chunk
                    record += 1

        yield from batches(CHUNK, rows(), weigh=lambda row: len(row[8]))

    small_batches(pages)
    return pages.select(F.col("page_id").cast("long"), F.col("html").cast("binary"), F.col("url").cast("string")).mapInArrow(run, CHUNK_DDL)


def with_roles(chunks: DataFrame, digests: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Chunks with ``refers_to``: null for the pages whose payload is stored, else the page that stores it.

    Of pages with equal payloads of ``least_bytes`` or more the one with the smallest id is stored. Digests are
    reduced to one row per payload before they move; the payloads move once, by page.
    """
    first = (
        digests.filter(F.col("payload_bytes") >= least_bytes).groupBy("payload_digest", "payload_bytes")
        .agg(F.min("page_id").alias("first_id"))
    )
    pages = digests.select("page_id", "payload_digest", "payload_bytes").distinct()
    roles = materialize(
        pages.join(first, ["payload_digest", "payload_bytes"], "left")
        .filter("first_id IS NOT NULL AND NOT (page_id <=> first_id)")
        .select(F.col("page_id").alias("_page"), F.col("payload_digest").alias("_digest"), F.col("first_id").alias("refers_to")),
        "warc-revisits",
    )
    same = F.col("page_id").eqNullSafe(F.col("_page")) & (F.col("payload_digest") == F.col("_digest"))
    return chunks.join(roles, same, "left").drop("_page", "_digest").filter("refers_to IS NULL OR chunk_no = 0")


def records(chunks: DataFrame) -> DataFrame:
    """The archive's records as text, one per row, without the separator that ends a record."""
    uri = F.regexp_replace(F.col("url"), r"[\x00-\x20\x7F]", "%20")
    own = F.concat(F.lit("urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("null")))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    stored, opens = F.col("refers_to").isNull(), F.col("chunk_no") == 0
    segmented = ~(opens & F.col("last"))
    number = (F.col("chunk_no") + 1).cast("string")
    block = F.when(stored, F.col("data")).otherwise(F.lit(b""))
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(~stored, F.lit("revisit")).when(opens, F.lit("response")).otherwise(F.lit("continuation"))),
        line("WARC-Record-ID", F.when(opens, F.concat(F.lit("<"), own, F.lit(">"))).otherwise(F.concat(F.lit("<"), own, F.lit(":"), number, F.lit(">")))),
        line("WARC-Date", F.lit(DATE)),
        F.when(uri.isNull() | ~opens, F.lit("")).otherwise(line("WARC-Target-URI", uri)),
        F.when(opens, line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest")))).otherwise(F.lit("")),
        F.when(opens, line("X-Payload-Length", F.col("payload_bytes").cast("string"))).otherwise(F.lit("")),
        F.when(stored, F.lit("")).otherwise(F.concat(
            line("WARC-Profile", F.lit(PROFILE)),
            line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("refers_to").cast("string"), F.lit(">"))),
        )),
        F.when(stored & segmented, F.concat(
            line("WARC-Segment-Number", number),
            F.when(opens, F.lit("")).otherwise(line("WARC-Segment-Origin-ID", F.concat(F.lit("<"), own, F.lit(">")))),
            F.when(F.col("last"), line("WARC-Segment-Total-Length", F.col("payload_bytes").cast("string"))).otherwise(F.lit("")),
        )).otherwise(F.lit("")),
        F.when(stored, line("X-Running-Digest", F.concat(F.lit("sha1:"), F.col("running_digest")))).otherwise(F.lit("")),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.length(block).cast("string")),
        F.lit("\r\n"),
    )
    return chunks.select(F.concat(head.cast("binary"), block).cast("string").alias("value"))


def write_archives(pages: DataFrame, path: str, chunk_bytes: int = CHUNK_BYTES, least_bytes: int = 0) -> None:
    """Write a record per row of (page_id, url, html) as gzip-compressed archives below ``path``.

    The payload is the html in UTF-8, empty for null. Of equal payloads the page with the smallest id is a
    response, the others revisit it; pages without an id come last, and a payload that only they have is stored by
    each. Rows that repeat both id and payload are the same capture and share its role. A null url leaves the
    target out. The segments of a record are neighbours in one file. No rows give archives without records.
    """
    digests = materialize(payload_digests(pages, chunk_bytes), "warc-digests")
    placed = with_roles(chunk_table(pages, chunk_bytes), digests, least_bytes)
    # The join leaves the chunks of a record in one partition, since they agree in its key and come from one task;
    # they are put in order where they are.
    records(placed.sortWithinPartitions("record_no", "chunk_no")).write.option("compression", "gzip").option("lineSep", SEPARATOR.decode()).text(path)


class Parser:
    """Records from the pieces of an archive, fed in order; it holds one header or hands the payload on."""

    def __init__(self) -> None:
        self.buffer = bytearray()
        self.fields: dict[str, str] | None = None
        self.left = 0

    def feed(self, piece: bytes) -> Iterator[tuple[str, object]]:
        """Yield ('head', fields), ('data', bytes) and ('end', None) events."""
        self.buffer += piece
        while True:
            if self.fields is None:
                start = 0
                while start < len(self.buffer) and self.buffer[start] in b"\r\n":
                    start += 1
                del self.buffer[:start]
                end = self.buffer.find(SEPARATOR)
                if end < 0:
                    return
                lines = bytes(self.buffer[:end]).decode().split("\r\n")
                if not lines[0].startswith("WARC/"):
                    raise ValueError(f"no record where one should start: {lines[0][:60]!r}")
                del self.buffer[:end + len(SEPARATOR)]
                self.fields = dict(line.split(": ", 1) for line in lines[1:])
                self.left = int(self.fields["Content-Length"])
                yield "head", self.fields
            if self.left:
                if not self.buffer:
                    return
                data = bytes(self.buffer[:self.left])
                del self.buffer[:len(data)]
                self.left -= len(data)
                yield "data", data
                if self.left:
                    return
            yield "end", None
            self.fields = None


READ = pa.schema([
    ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()),
    ("refers_to", pa.int64()), ("url", pa.string()), ("segments", pa.int32()),
])
READ_DDL = (
    "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, url string, "
    "segments int"
)


def _page(identifier: str) -> int | None:
    name = identifier.strip("<>").split(":")[2]
    return None if name == "null" else int(name)


def _read(parts):
    """One row per record; the digest goes on over the segments and is checked against what was written."""

    def rows():
        parser, head, digest, size, segments = Parser(), None, None, 0, 0
        for part in parts:
            for piece in part.column(0):
                for kind, value in parser.feed(piece.as_py() + SEPARATOR):
                    if kind == "head":
                        if value["WARC-Type"] != "continuation":
                            head, digest, size, segments = value, hashlib.sha1(), 0, 0
                        elif head is None or value["WARC-Segment-Origin-ID"] != head["WARC-Record-ID"] or int(value["WARC-Segment-Number"]) != segments + 1:
                            raise ValueError(f"segment out of order: {value['WARC-Record-ID']}")
                        current, segments = value, segments + 1
                    elif kind == "data":
                        digest.update(value)
                        size += len(value)
                    else:
                        if head["WARC-Type"] == "revisit":
                            yield (
                                _page(head["WARC-Record-ID"]), int(head["X-Payload-Length"]), head["WARC-Payload-Digest"][5:],
                                "revisit", _page(head["WARC-Refers-To"]), head.get("WARC-Target-URI"), 1,
                            )
                            continue
                        name = base32_sha1(digest)
                        if current["X-Running-Digest"] != "sha1:" + name:
                            raise ValueError(f"damaged payload: {current['WARC-Record-ID']}")
                        if size == int(head["X-Payload-Length"]):
                            yield _page(head["WARC-Record-ID"]), size, name, "response", None, head.get("WARC-Target-URI"), segments

    yield from batches(READ, rows())


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """A row per record of the archives below ``path``: page_id, payload_bytes, payload_digest, record_type,
    refers_to, url and the number of segments. Payloads are streamed through the digest, whole ones are not kept."""
    pieces = spark.read.option("lineSep", SEPARATOR.decode()).text(path)
    small_batches(pieces)
    return pieces.select(F.col("value").cast("binary")).mapInArrow(_read, READ_DDL)


def round_trip(pages: DataFrame, chunk_bytes: int = CHUNK_BYTES, least_bytes: int = 0) -> DataFrame:
    """Write the pages to archives in the shared folder and read them back."""
    path = fresh_path(pages.sparkSession, "warc")
    write_archives(pages, path, chunk_bytes, least_bytes)
    return read_archives(pages.sparkSession, path)
