"""WARC archives in seekable Zstandard bundles: independent frames, a seek table at the end, and an
index from records to their frames.

A bundle is a file of Zstandard frames, each of whole WARC records, so any frame can be read alone and
any Zstandard tool reads the file from end to end. Its last frame is a skippable one that holds the
sizes of all others (the seekable format of the Zstandard project). The index is a table: for every
record its bundle, its frame, and its offset inside the frame.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from podium.llm.common import delete, scratch, staged, unstage

# Uncompressed bytes after which a frame is closed, and compressed bytes after which a bundle is.
FRAME_BYTES = 1 << 20
BUNDLE_BYTES = 64 << 20
LEVEL = 3
# Payloads below this are always written whole.
LEAST_REVISIT = 100
# Most repeated digests that are sent to all executors, about 60 bytes each; above it they are joined
# by a shuffle. The results do not depend on it.
MOST_BROADCAST = 500_000

# Fixed values of the formats.
_SKIPPABLE, _SEEKABLE = 0x184D2A5E, 0x8F92EAB1
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DATE = "1970-01-01T00:00:00Z"

INDEX = "bundle string, frame int, offset long, length long, record_id string, page_id long, record_type string"
RECORDS = (
    "page_id long, url string, record_type string, refers_to long, record_id string, refers_to_id string, payload binary"
)


# --- records


def record_id(page_id: int | None, digest: str) -> str:
    """The identifier of a page's record: the same for rows that repeat both id and payload."""
    own = hashlib.sha256(f"{'' if page_id is None else page_id}:{digest}".encode()).digest()
    return f"<urn:uuid:{uuid.UUID(bytes=own[:16], version=5)}>"


def _line(value: str) -> str:
    """A header value: white space and control characters as in a URL."""
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in value)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, first: int | None, date: str = _DATE) -> tuple[str, bytes]:
    """Identifier and bytes of one record: a response, or a revisit of page `first`."""
    own = record_id(page_id, digest)
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if first is not None else head + payload
    fields = [
        ("WARC-Type", "response" if first is None else "revisit"),
        ("WARC-Record-ID", own),
        ("WARC-Date", date),
        ("WARC-Target-URI", None if url is None else _line(url)),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("Page-ID", page_id),
    ]
    if first is not None:
        fields += [("WARC-Profile", _REVISIT), ("WARC-Refers-To", record_id(first, digest)), ("Refers-To-Page-ID", first)]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", len(block))]
    lines = "".join(f"{name}: {value}\r\n" for name, value in fields if value is not None)
    return own, b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def parse(buffer: bytes, at: int = 0) -> tuple[tuple, int]:
    """The record at a place as a row of :data:`RECORDS`, and where the next one begins.

    A response whose payload does not have the digest it was written with is an error.
    """
    end = buffer.index(b"\r\n\r\n", at)
    lines = buffer[at:end].decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"no WARC record at offset {at}")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    start, size = end + 4, int(fields["Content-Length"])
    payload = None
    if fields["WARC-Type"] == "response":
        payload = buffer[buffer.index(b"\r\n\r\n", start) + 4 : start + size]
        if hashlib.sha256(payload).hexdigest() != fields["WARC-Payload-Digest"].removeprefix("sha256:"):
            raise ValueError(f"the payload of {fields['WARC-Record-ID']} is damaged")
    whole = [None if fields.get(name) is None else int(fields[name]) for name in ("Page-ID", "Refers-To-Page-ID")]
    row = (
        whole[0], fields.get("WARC-Target-URI"), fields["WARC-Type"], whole[1],
        fields["WARC-Record-ID"], fields.get("WARC-Refers-To"), payload,
    )
    return row, start + size + 4


# --- bundles


def open_store(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder and the path in it."""
    uri = uri.replace("s3a://", "s3://", 1)
    if uri.startswith("file:"):
        uri = "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(uri)


class BundleWriter:
    """A new bundle: records go to frames, frames to the file as soon as they are full."""

    def __init__(self, folder: str, frame_bytes: int = FRAME_BYTES) -> None:
        store, path = open_store(folder)
        store.create_dir(path, recursive=True)
        # A repeated task writes a file of another name; only files that the index names count.
        self.name = f"{uuid.uuid4().hex}.warc.zst"
        self._file = store.open_output_stream(f"{path}/{self.name}", compression=None)
        self._frame_bytes, self._press = frame_bytes, zstandard.ZstdCompressor(level=LEVEL, write_content_size=True)
        self._parts, self._size, self._frames = [], 0, []
        self.written = 0

    def add(self, data: bytes) -> tuple[int, int]:
        """Frame and offset of a record."""
        if self._size >= self._frame_bytes:
            self._flush()
        place = len(self._frames), self._size
        self._parts.append(data)
        self._size += len(data)
        return place

    def _flush(self) -> None:
        frame = self._press.compress(b"".join(self._parts))
        self._file.write(frame)
        self._frames.append((len(frame), self._size))
        self.written += len(frame)
        self._parts, self._size = [], 0

    def close(self) -> None:
        if self._parts:
            self._flush()
        table = b"".join(struct.pack("<II", *sizes) for sizes in self._frames)
        table += struct.pack("<IBI", len(self._frames), 0, _SEEKABLE)
        self._file.write(struct.pack("<II", _SKIPPABLE, len(table)) + table)
        self._file.close()


class BundleReader:
    """A bundle's frames, each read alone."""

    def __init__(self, folder: str, name: str) -> None:
        store, path = open_store(folder)
        self._file = store.open_input_file(f"{path}/{name}")
        size = self._file.size()
        count, _, magic = struct.unpack("<IBI", self._file.read_at(9, size - 9))
        if magic != _SEEKABLE:
            raise ValueError(f"{name} has no seek table")
        table = self._file.read_at(8 * count, size - 9 - 8 * count)
        self.sizes = list(struct.iter_unpack("<II", table))
        self._starts = [0]
        for compressed, _ in self.sizes:
            self._starts.append(self._starts[-1] + compressed)

    def frame(self, number: int) -> bytes:
        compressed, plain = self.sizes[number]
        data = self._file.read_at(compressed, self._starts[number])
        return zstandard.ZstdDecompressor().decompress(data, max_output_size=plain)

    def records(self, number: int) -> Iterator[tuple]:
        buffer, at = self.frame(number), 0
        while at < len(buffer):
            row, at = parse(buffer, at)
            yield row

    def close(self) -> None:
        self._file.close()


# --- archives


def payload_of(html: str | Column) -> Column:
    """The bytes of a page; none for a null."""
    return F.coalesce((F.col(html) if isinstance(html, str) else html).cast("string"), F.lit("")).cast("binary")


def _digest(payload: str) -> Column:
    return F.unhex(F.sha2(payload, 256))


def write_archive(
    pages: DataFrame,
    folder: str,
    *,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    frame_bytes: int = FRAME_BYTES,
    bundle_bytes: int = BUNDLE_BYTES,
    least_revisit: int = LEAST_REVISIT,
    most_broadcast: int = MOST_BROADCAST,
) -> DataFrame:
    """Write a record per row of `pages` below `folder`; the index, one row per record (:data:`INDEX`).

    Of records with equal payloads of `least_revisit` bytes or more, that with the smallest page id is
    a response and the others are revisits of it; all smaller ones are responses. Pages are written
    where they are read: only digests and ids are shuffled, unless more than `most_broadcast` digests
    repeat. Each task writes bundles of its own, and the index is committed by Spark, so a lost task
    leaves at most files that no index names.

    A null page is an empty payload, a null URL no header. A null id is never the smallest: such rows
    are revisits where the group has an id, and responses where it has none. Rows that repeat the id
    and the payload of a response are responses too, under one record identifier. Control characters
    and blanks of a URL are percent-encoded. Other columns are ignored. An empty table gives an empty
    index and no file.
    """
    spark, bundles = pages.sparkSession, f"{folder.rstrip('/')}/bundles"
    rows = pages.select(
        F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), payload_of(html).alias("payload")
    ).withColumn("digest", _digest("payload"))
    repeated = staged(
        rows.where(F.length("payload") >= least_revisit)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 and first is not null")
        .select("digest", "first"),
        "repeated-digests",
    )
    known = F.broadcast(repeated) if repeated.count() <= most_broadcast else repeated
    typed = rows.join(known, "digest", "left").select(
        "page_id", "url", "payload", F.lower(F.hex("digest")).alias("digest"),
        F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("first"),
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, places = None, []

        def closed() -> pa.RecordBatch:
            out.close()
            columns = list(zip(*places))
            kinds = (pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string())
            names = ["bundle", "frame", "offset", "length", "record_id", "page_id", "record_type"]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

        for batch in batches:
            for k in range(batch.num_rows):
                own, address, payload, digest, first = (column[k].as_py() for column in batch.columns)
                out = out or BundleWriter(bundles, frame_bytes)
                name, data = record(own, address, payload, digest, first)
                places.append((out.name, *out.add(data), len(data), name, own, "response" if first is None else "revisit"))
                if out.written >= bundle_bytes:
                    yield closed()
                    out, places = None, []
        if out:
            yield closed()

    path = f"{folder.rstrip('/')}/index"
    typed.mapInArrow(write, INDEX).write.parquet(path)
    unstage(repeated)
    return spark.read.schema(INDEX).parquet(path)


def _rows(found: Iterable[tuple]) -> Iterator[pa.RecordBatch]:
    """Rows of :data:`RECORDS` as batches of bounded size."""
    kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.binary())
    names = [field.split()[0] for field in RECORDS.split(", ")]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    rows, size = [], 0
    for row in found:
        rows.append(row)
        size += 200 + len(row[-1] or b"")
        if size >= 8 << 20:
            yield batch(rows)
            rows, size = [], 0
    if rows:
        yield batch(rows)


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """All records of an archive (:data:`RECORDS`), read from its bundles; revisits have no payload.

    One task per bundle, one frame in memory at a time.
    """
    folder = folder.rstrip("/")
    names = spark.read.schema(INDEX).parquet(f"{folder}/index").groupBy("bundle").agg(F.count(F.lit(1)).alias("n"))
    names = staged(names.select("bundle"), "bundles")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            for batch in batches:
                for name in batch.column(0).to_pylist():
                    bundle = BundleReader(f"{folder}/bundles", name)
                    for number in range(len(bundle.sizes)):
                        yield from bundle.records(number)
                    bundle.close()

        yield from _rows(found())

    return names.repartition(max(1, names.count())).mapInArrow(read, RECORDS)


def fetch(spark: SparkSession, folder: str, places: DataFrame) -> DataFrame:
    """The records at some rows of the index (:data:`INDEX`): only their frames are read.

    Rows are sorted by frame in each task, so a frame is read once however many of its records are
    asked for.
    """
    folder = folder.rstrip("/")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            at, bundle, buffer = (None, None), None, b""
            for batch in batches:
                for name, frame, offset in zip(*(batch.column(k).to_pylist() for k in range(3))):
                    if name != at[0]:
                        if bundle:
                            bundle.close()
                        bundle = BundleReader(f"{folder}/bundles", name)
                    if (name, frame) != at:
                        buffer = bundle.frame(frame)
                    at = name, frame
                    yield parse(buffer, offset)[0]
            if bundle:
                bundle.close()

        yield from _rows(found())

    sorted_places = places.select("bundle", "frame", "offset").repartition("bundle", "frame")
    return sorted_places.sortWithinPartitions("bundle", "frame", "offset").mapInArrow(read, RECORDS)


def archived(pages: DataFrame, **options) -> DataFrame:
    """One row per row of `pages`, out of an archive written and read back: page_id, url,
    payload_bytes, payload_digest, record_type, refers_to.

    A revisit has the size and digest of the response that it refers to. The archive is deleted; use
    :func:`write_archive` to keep one. Awkward rows are those of :func:`write_archive`.
    """
    spark = pages.sparkSession
    folder = scratch(spark, "archive")
    write_archive(pages, folder, **options)
    back = staged(
        read_archive(spark, folder).select(
            "page_id", "url", "record_type", "refers_to", "record_id", "refers_to_id",
            F.octet_length("payload").cast("long").alias("payload_bytes"),
            F.sha2("payload", 256).alias("payload_digest"),
        ),
        "archived",
    )
    delete(spark, folder)
    responses = back.where("record_type = 'response'")
    whole = responses.groupBy(F.col("record_id").alias("refers_to_id")).agg(
        F.any_value("payload_bytes").alias("payload_bytes"), F.any_value("payload_digest").alias("payload_digest")
    )
    # The second key makes Spark deal both sides anew, so that adaptive execution can split a response
    # that very many pages revisit.
    again = F.hash("refers_to_id").alias("again")
    revisits = back.where("record_type = 'revisit'").drop("payload_bytes", "payload_digest")
    revisits = revisits.select("*", again).join(whole.select("*", again), ["again", "refers_to_id"], "left")
    columns = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return responses.select(*columns).unionByName(revisits.select(*columns))
