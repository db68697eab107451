"""WARC records in seekable Zstandard bundles.

A bundle is a file of independent Zstandard frames, each holding whole WARC/1.1 records of about
``FRAME_BYTES``, closed by a seek table in a skippable frame (sizes of all frames, then a fixed
footer). The record index maps a record id to its bundle, its frame and its place in the
uncompressed frame, so one record costs one frame.

Tasks write bundles to the shared folder under names of their own attempt. Only the index rows of
tasks that succeed are kept, so a repeated task leaves unreferenced files and no wrong rows.

Of records with equal payloads of at least ``least`` bytes the one with the smallest page_id is the
response and the others are revisits of it.

Results in special cases: a NULL html is an empty payload; a NULL url leaves the target out; a NULL
page_id is a record without number, a response only if no numbered page has its payload; repeated
rows of the smallest page_id are responses all, other repeated rows revisits all; an empty table
gives no record and no bundle; other columns are not read.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import staged
from .batches import chunks, pick, small_batches
from .files import opened, shared_folder

FRAME_BYTES = 256 << 10
BUNDLE_BYTES = 64 << 20
STRETCH = 32  # frames in a row that one task reads at least
DATE = "1970-01-01T00:00:00Z"  # the pages carry no capture time

# Fixed values of the seekable format and of WARC.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
URN = "urn:x-page:"

INDEX = "page_id long, bundle string, frame long, at long, size long"
RECORD = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string"


def digest(payload: bytes) -> str:
    """Base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC record; a revisit (``refers_to`` given) holds the HTTP header without the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (payload if refers_to is None else b"")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{URN}{'' if page_id is None else page_id}>",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest(payload)}",
        f"WARC-Payload-Length: {len(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=_URL_SAFE)}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: <{URN}{refers_to}>", f"WARC-Profile: {PROFILE}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


_URL_SAFE = "!#$%&'()*+,/:;=?@[]~"


def parsed(raw: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """Header fields, payload, and the place after the record that begins at ``at``."""
    end = raw.index(b"\r\n\r\n", at)
    lines = raw[at:end].decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"no record at {at}")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    begin = end + 4
    stop = begin + int(fields["Content-Length"])
    payload = raw[raw.index(b"\r\n\r\n", begin, stop) + 4 : stop]
    return fields, payload, stop + 4


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    """The closing skippable frame for (compressed, uncompressed) sizes."""
    body = b"".join(struct.pack("<II", *sizes) for sizes in frames)
    body += struct.pack("<IBI", len(frames), 0, SEEKABLE_MAGIC)
    return struct.pack("<II", SKIPPABLE_MAGIC, len(body)) + body


class Bundle:
    """An open bundle file, read frame by frame."""

    def __init__(self, address: str):
        store, path = opened(address)
        self._file = store.open_input_file(path)
        size = self._file.size()
        count, flags, magic = struct.unpack("<IBI", self._file.read_at(9, size - 9))
        if magic != SEEKABLE_MAGIC or flags:
            raise ValueError(f"{address} has no seek table")
        table = np.frombuffer(self._file.read_at(8 * count, size - 9 - 8 * count), dtype="<u4").reshape(-1, 2)
        self.sizes = table.astype(np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes[:, 0])])

    def frame(self, number: int) -> bytes:
        """One frame, uncompressed, without touching the others."""
        packed, plain = self.sizes[number].tolist()
        raw = self._file.read_at(packed, int(self.starts[number]))
        out = zstandard.ZstdDecompressor().decompressobj().decompress(raw)
        if len(out) != plain:
            raise ValueError(f"frame {number} holds {len(out)} bytes instead of {plain}")
        return out

    def close(self) -> None:
        self._file.close()


class _Writer:
    """The bundles of one task attempt."""

    def __init__(self, folder: str):
        self._store, self._folder = opened(folder)
        self._store.create_dir(self._folder, recursive=True)
        self._address = folder
        self._compressor = zstandard.ZstdCompressor(level=3)
        self._stream = None

    def add(self, page_id: int | None, raw: bytes) -> Iterator[list[tuple]]:
        """Take a record; yields index rows whenever a frame is written."""
        if self._stream is None:
            name = f"{uuid.uuid4().hex}.warc.zst"
            self._stream = self._store.open_output_stream(f"{self._folder}/{name}", compression=None)
            self._name = f"{self._address}/{name}"
            self._frames: list[tuple[int, int]] = []
            self._held, self._size, self._written = [], 0, 0
        self._held.append((page_id, raw))
        self._size += len(raw)
        if self._size >= FRAME_BYTES:
            yield self._flush()
            if self._written >= BUNDLE_BYTES:
                self._end()

    def _flush(self) -> list[tuple]:
        plain = b"".join(raw for _, raw in self._held)
        packed = self._compressor.compress(plain)
        self._stream.write(packed)
        rows, at = [], 0
        for page_id, raw in self._held:
            rows.append((page_id, self._name, len(self._frames), at, len(raw)))
            at += len(raw)
        self._frames.append((len(packed), len(plain)))
        self._written += len(packed)
        self._held, self._size = [], 0
        return rows

    def _end(self) -> None:
        self._stream.write(seek_table(self._frames))
        self._stream.close()
        self._stream = None

    def finish(self) -> Iterator[list[tuple]]:
        if self._stream is not None:
            if self._held:
                yield self._flush()
            self._end()


def with_first(pages: DataFrame, least: int = 0) -> DataFrame:
    """page_id, url, payload and ``first``: the page that the record revisits, NULL for a response."""
    plain = pick(pages, "page_id", "url", "html").select(
        "page_id", "url", F.coalesce(F.col("html").cast("binary"), F.lit("").cast("binary")).alias("payload")
    )
    same = F.struct(F.octet_length("payload").alias("n"), F.sha2("payload", 256).alias("h"))
    keyed = plain.withColumn("same", same)
    # payloads met once need no partner; the others are few numbers each
    firsts = (
        keyed.where(F.col("same.n") >= least)
        .groupBy("same")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("copies"))
        .where("copies > 1 AND first IS NOT NULL")
        .drop("copies")
    )
    first = F.when(F.col("page_id").eqNullSafe(F.col("first")), F.lit(None)).otherwise(F.col("first"))
    return keyed.join(firsts, "same", "left").select("page_id", "url", "payload", first.cast("long").alias("first"))


def write_bundles(pages: DataFrame, least: int = 0) -> DataFrame:
    """Write all pages as bundles; returns the record index, itself stored."""
    small_batches(pages)
    folder = shared_folder(pages.sparkSession, "warc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = _Writer(folder)
        for batch in batches:
            for part in chunks(batch, "payload"):
                for page in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    for rows in writer.add(page[0], record(*page)):
                        yield _index(rows)
        for rows in writer.finish():
            yield _index(rows)

    return staged(with_first(pages, least).mapInArrow(run, INDEX), "warc-index")


def _index(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [("page_id", pa.int64()), ("bundle", pa.string()), ("frame", pa.int64()), ("at", pa.int64()), ("size", pa.int64())]
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, kinds, strict=True)], names=[n for n, _ in kinds])


@functools.lru_cache(maxsize=4)
def _bundle(address: str) -> Bundle:
    return Bundle(address)


def _number(urn: str | None) -> int | None:
    digits = (urn or "").strip("<>").removeprefix(URN)
    return int(digits) if digits else None


def _row(fields: dict[str, str], payload: bytes) -> tuple:
    """A record's columns; a response's payload must agree with its header."""
    expected = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    length = int(fields["WARC-Payload-Length"])
    if fields["WARC-Type"] == "response" and (digest(payload), len(payload)) != (expected, length):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} is damaged")
    return (
        _number(fields["WARC-Record-ID"]),
        fields.get("WARC-Target-URI"),
        fields["WARC-Type"],
        _number(fields.get("WARC-Refers-To")),
        length,
        expected,
    )


def read_bundles(index: DataFrame) -> DataFrame:
    """All records of the bundles that the index names, the frames dealt to tasks in stretches of ``STRETCH``."""
    frames = index.select("bundle", "frame").distinct()
    # a number given by the frames themselves: the index is so small that its bytes would ask for one task
    held, wide = frames.count(), 4 * frames.sparkSession.sparkContext.defaultParallelism
    tasks = max(min(held // STRETCH, wide), held // (16 * STRETCH)) + 1
    stretch = F.floor(F.col("frame") / STRETCH)
    frames = frames.repartition(tasks, "bundle", stretch).sortWithinPartitions("bundle", "frame")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for address, number in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                raw, at, rows = _bundle(address).frame(number), 0, []
                while at < len(raw):
                    fields, payload, at = parsed(raw, at)
                    rows.append(_row(fields, payload))
                yield _records(rows)

    return frames.mapInArrow(run, RECORD)


def _records(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()]
    names = ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def fetch(index: DataFrame, wanted: DataFrame) -> DataFrame:
    """(page_id, payload) of the wanted page ids' records, reading only the frames that hold them; a
    revisit has the payload of the page it refers to only through that page."""
    rows = index.join(pick(wanted, "page_id").distinct(), "page_id", "left_semi")
    sorted_ = rows.select("page_id", "bundle", "frame", "at").repartition("bundle", "frame")
    sorted_ = sorted_.sortWithinPartitions("bundle", "frame", "at")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, raw = None, b""
        for batch in batches:
            for page_id, address, number, at in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (address, number) != last:
                    last, raw = (address, number), _bundle(address).frame(number)
                fields, payload, _ = parsed(raw, at)
                kept = payload if fields["WARC-Type"] == "response" else None
                yield pa.RecordBatch.from_arrays(
                    [pa.array([page_id], pa.int64()), pa.array([kept], pa.binary())], names=["page_id", "payload"]
                )

    return sorted_.mapInArrow(run, "page_id long, payload binary")


def warc_report(pages: DataFrame) -> DataFrame:
    """Write the archives, read them back, and report each record."""
    return read_bundles(write_bundles(pages)).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


_BITS = "".join(f"{i:04b}" for i in range(16))
_GROUPS = ",".join(f"{i:05b}" for i in range(32))

# Classes of equal payloads straight from the table, and base32 from the digest's bits.
WARC_SQL = f"""
WITH payloads AS (
    SELECT page_id, coalesce(html, '') AS payload FROM pages
), classes AS (
    SELECT payload, min(page_id) AS smallest, sha1(payload) AS hexed FROM payloads GROUP BY payload
), bits AS (
    SELECT *, array_to_string(list_transform(range(1, 41), lambda i:
        substr('{_BITS}', 4 * strpos('0123456789abcdef', substr(hexed, i::INT, 1))::INT - 3, 4)), '') AS line
    FROM classes
), coded AS (
    SELECT payload, smallest, array_to_string(list_transform(range(0, 32), lambda j:
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
               ((strpos('{_GROUPS}', substr(line, (5 * j + 1)::INT, 5)) - 1) // 6 + 1)::INT, 1)), '') AS digest
    FROM bits
)
SELECT page_id, strlen(payload)::BIGINT AS payload_bytes, digest AS payload_digest,
       CASE WHEN page_id = smallest THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = smallest THEN NULL ELSE smallest END AS refers_to
FROM payloads JOIN coded USING (payload)
"""
