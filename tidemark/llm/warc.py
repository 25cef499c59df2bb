"""WARC archives as seekable Zstandard bundles, written and read back by Spark's own writers and readers.

A bundle is a file of independent Zstandard frames, each with some records, a skippable frame with the
places of the records, and at the end the seek table of the Zstandard seekable format.  A reader finds a
record by its identifier as (frame, offset within the frame's content) and decompresses that frame only.

A task holds one bundle at most.  Bundles are written by Spark's text sink, one row per file, so its commit
protocol drops the files of failed tasks and any file system Spark knows will do.  The sink ends each row by
its line separator: that is set to the last four bytes of the seek table, its magic number.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bloom
from .shared import free, quoted, short_batches, stored, with_group

#: Content of a frame, before compression, from which on it is closed.
FRAME_BYTES = 1 << 20
#: Bytes of a bundle from which on it is closed.
BUNDLE_BYTES = 32 << 20
#: Smaller payloads are always written in full.
LEAST_REVISITED = 1000

# Fixed values of the Zstandard seekable format and of WARC.
SKIPPABLE_SEEK_TABLE = 0x184D2A5E
SKIPPABLE_INDEX = 0x184D2A50
SEEKABLE_MAGIC = 0x8F92EAB1
WARC_VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_FOOTER = struct.Struct("<IBI")  # frames, descriptor, magic number
_PLACE = struct.Struct("<?qIII")  # has an identifier, identifier, frame, offset, length


def payload(html: Column) -> Column:
    """The bytes of a page: its text in UTF-8, none for null."""
    return F.coalesce(html, F.lit("")).cast("binary")


def _namespace_id(page_id: int | None, url: str | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {url}')}>"


def _line(text: str | None) -> str:
    """A header value on one line."""
    return " ".join((text or "").split())


def record(page_id: int | None, url: str | None, body: bytes, digest: bytes, refers_to: int | None) -> bytes:
    """One WARC record: a response with the payload, or a revisit without it."""
    head = [
        WARC_VERSION,
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {_namespace_id(page_id, url)}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Target-URI: {_line(url) or 'urn:none'}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(digest).decode()}",
        f"WARC-Page-ID: {'' if page_id is None else page_id}",
        f"WARC-Payload-Length: {len(body)}",
    ]
    if refers_to is None:
        block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(body) + body
    else:
        block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To-Page-ID: {refers_to}"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """Headers, HTTP head and payload of a record."""
    head, rest = data.split(b"\r\n\r\n", 1)
    lines = head.decode().split("\r\n")
    headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    block = rest[: int(headers["Content-Length"])]
    http, body = block.split(b"\r\n\r\n", 1)
    return {"headers": headers, "http": http, "payload": body}


class Bundle:
    """A bundle in the making; a record that fills a frame or the bundle closes it."""

    def __init__(self, frame_bytes: int = FRAME_BYTES):
        self.frame_bytes = frame_bytes
        self.pack = zstandard.ZstdCompressor(level=3, write_checksum=True)
        self.frames: list[bytes] = []
        self.sizes: list[tuple[int, int]] = []
        self.places: list[bytes] = []
        self.open = bytearray()
        self.bytes = 0

    def add(self, page_id: int | None, data: bytes) -> None:
        has = page_id is not None
        self.places.append(_PLACE.pack(has, page_id if has else 0, len(self.frames), len(self.open), len(data)))
        self.open += data
        if len(self.open) >= self.frame_bytes:
            self._close_frame()

    def _close_frame(self) -> None:
        if self.open:
            frame = self.pack.compress(bytes(self.open))
            self.frames.append(frame)
            self.sizes.append((len(frame), len(self.open)))
            self.bytes += len(frame)
            self.open = bytearray()

    def file(self) -> bytes:
        """The whole file."""
        self._close_frame()
        index = self.pack.compress(b"".join(self.places))
        index = struct.pack("<II", SKIPPABLE_INDEX, len(index)) + index
        # the seek table lists every frame of the file, the index as one without content
        entries = b"".join(struct.pack("<II", *size) for size in [*self.sizes, (len(index), 0)])
        footer = _FOOTER.pack(len(self.sizes) + 1, 0, SEEKABLE_MAGIC)
        return b"".join([*self.frames, index, struct.pack("<II", SKIPPABLE_SEEK_TABLE, len(entries) + len(footer)), entries, footer])


class BundleReader:
    """Random access to the records of one bundle."""

    def __init__(self, data: bytes):
        count, descriptor, magic = _FOOTER.unpack_from(data, len(data) - _FOOTER.size)
        if magic != SEEKABLE_MAGIC or descriptor & 0x80:
            raise ValueError("not a seekable bundle without checksums in its seek table")
        self.data, table = data, len(data) - _FOOTER.size - 8 * count
        self.starts, at = [], 0
        sizes = list(struct.iter_unpack("<II", data[table : table + 8 * count]))
        for packed, _ in sizes:
            self.starts.append(at)
            at += packed
        self.ends = [*self.starts[1:], at]
        unpack = zstandard.ZstdDecompressor()
        index = unpack.decompress(data[self.starts[-1] + 8 : at])
        self.places = [(i if has else None, *rest) for has, i, *rest in _PLACE.iter_unpack(index)]
        self._unpack, self._held = unpack, (-1, b"")

    def frame(self, number: int) -> bytes:
        if self._held[0] != number:
            self._held = number, self._unpack.decompress(self.data[self.starts[number] : self.ends[number]])
        return self._held[1]

    def records(self, wanted: set[int] | None = None) -> Iterator[tuple[int | None, dict]]:
        """The records, or those with the identifiers; frames without any of them stay packed."""
        for page_id, number, offset, length in self.places:
            if wanted is None or page_id in wanted:
                yield page_id, parse_record(self.frame(number)[offset : offset + length])


def revisit_plan(pages: DataFrame, id: str = "page_id", html: str = "html", least: int = LEAST_REVISITED) -> DataFrame:
    """``pages`` with digest (SHA-1, 20 bytes) and refers_to, the id of the response with the same payload.

    Where ``pages`` has columns of these names the new ones get underscores in front, as ``free`` deals them.

    Of equal payloads of ``least`` bytes or more the largest id is the response; of rows that repeat this id
    all are.  A null id is smaller than any other.  Payloads that a Bloom filter has not seen twice
    are responses and stay where they are; only the others are joined with their groups.
    """
    digest, refers_to, key, size, asked = free(pages, "digest", "refers_to", "key", "size", "asked")
    body = payload(quoted(html))
    digested = pages.withColumn(digest, F.unhex(F.sha1(body)))
    rows = stored(
        digested.filter(F.octet_length(body) >= least).select(quoted(id).alias("id"), quoted(digest).alias("digest")),
        "warc-digests",
    )
    twice = bloom.build(rows.select(F.xxhash64("digest").alias("key")), rows.count(), repeated=True)
    groups = stored(
        rows.filter(twice.may_hold(F.xxhash64("digest")))
        .groupBy(F.col("digest").alias(digest))
        .agg(F.max("id").alias(key), F.count("*").alias(size)),
        "warc-groups",
    )
    marked = digested.withColumn(
        asked, (F.octet_length(body) >= least) & twice.may_hold(F.xxhash64(quoted(digest)))
    )
    alone = marked.filter(~quoted(asked)).withColumn(refers_to, F.lit(None).cast(pages.schema[id].dataType))
    grouped = with_group(marked.filter(quoted(asked)), groups, [digest], size)
    other = F.when(~quoted(key).eqNullSafe(quoted(id)), quoted(key))
    grouped = grouped.withColumn(refers_to, other).select(*pages.columns, digest, asked, refers_to)
    return alone.unionByName(grouped).drop(asked)


def write_warc(
    pages: DataFrame,
    path: str,
    id: str = "page_id",
    url: str = "url",
    html: str = "html",
    least: int = LEAST_REVISITED,
    frame_bytes: int = FRAME_BYTES,
    bundle_bytes: int = BUNDLE_BYTES,
) -> None:
    """A record per row of ``pages``, in bundles under ``path``, which must not exist.

    A null html is an empty payload; a null url is written as ``urn:none``, a null id as none at all.  An
    empty table gives a folder without bundles.  Other columns are not read.
    """
    short_batches(pages.sparkSession)
    pages = pages.select(quoted(id), quoted(url), quoted(html))
    digest, refers_to = free(pages, "digest", "refers_to")
    planned = revisit_plan(pages, id, html, least).select(
        quoted(id).cast("long").alias("id"), quoted(url).cast("string").alias("url"),
        payload(quoted(html)).alias("body"), quoted(digest).alias("digest"), quoted(refers_to).cast("long").alias("refers_to"),
    )

    def bundles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle = Bundle(frame_bytes)
        for batch in batches:
            for i in range(batch.num_rows):
                row = [column[i].as_py() for column in batch.columns]
                bundle.add(row[0], record(*row))
                if bundle.bytes >= bundle_bytes:
                    yield _one(bundle.file()[:-4])
                    bundle = Bundle(frame_bytes)
        if bundle.places:
            yield _one(bundle.file()[:-4])

    files = planned.mapInArrow(bundles, "value binary").select(F.col("value").cast("string"))
    files.write.options(
        lineSep=struct.pack("<I", SEEKABLE_MAGIC).decode("latin-1"), encoding="ISO-8859-1", maxRecordsPerFile=1
    ).text(path)


def _one(value: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([value], pa.binary())], ["value"])


def read_warc(spark: SparkSession, path: str, ids: set[int] | None = None) -> DataFrame:
    """The records under ``path``: file, page_id, url, record_type, refers_to, digest, payload_bytes, payload.

    payload_bytes and digest are those of the full payload; the payload of a revisit is null.  With ``ids``
    only the frames that hold these records are decompressed.
    """
    schema = (
        "file string, page_id long, url string, record_type string, refers_to long, digest binary, "
        "payload_bytes long, payload binary"
    )

    def read(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for path, content in zip(part.path, part.content):
                held, size = [], 0
                for page_id, found in BundleReader(content).records(ids):
                    head = found["headers"]
                    revisit = head["WARC-Type"] == "revisit"
                    body = None if revisit else found["payload"]
                    digest = base64.b32decode(head["WARC-Payload-Digest"].removeprefix("sha1:"))
                    if not revisit and hashlib.sha1(body).digest() != digest:
                        raise ValueError(f"the payload of record {page_id} in {path} does not have its digest")
                    refers_to = int(head["WARC-Refers-To-Page-ID"]) if revisit else None
                    n = int(head["WARC-Payload-Length"])
                    held.append((path, page_id, head["WARC-Target-URI"], head["WARC-Type"], refers_to, digest, n, body))
                    size += 0 if body is None else n
                    if size > 8 << 20:
                        yield _frame(held)
                        held, size = [], 0
                yield _frame(held)

    names = [field.split()[0] for field in schema.split(", ")]

    def _frame(held: list[tuple]) -> pd.DataFrame:
        out = pd.DataFrame(held, columns=names)
        return out.astype({"page_id": "Int64", "refers_to": "Int64", "payload_bytes": "int64"})

    if not _has_bundles(spark, path):
        return spark.createDataFrame([], schema)
    # a file per task's batch: a bundle is read whole
    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(read, schema)


def _has_bundles(spark: SparkSession, path: str) -> bool:
    return not spark.read.format("binaryFile").load(path).select("path").isEmpty()


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """Where each record is: file, page_id, frame, offset in the frame's content, length."""
    schema = "file string, page_id long, frame int, offset long, length long"

    def read(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for path, content in zip(part.path, part.content):
                out = pd.DataFrame(BundleReader(content).places, columns=["page_id", "frame", "offset", "length"])
                yield out.assign(file=path).astype({"page_id": "Int64"})[["file", "page_id", "frame", "offset", "length"]]

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(read, schema)
