"""WARC archives as seekable Zstandard bundles.

Records are grouped into independent Zstandard frames; a bundle (one file)
ends with the seek table of the public seekable format, a skippable frame
with the sizes and checksums of all frames. A record is addressed by bundle,
frame and offset inside the decompressed frame, so reading one record
decompresses one frame.

Bundles are written with Spark's text sink, one row a file, so any store that
Spark writes will do: its line separator supplies the last four bytes, the
magic number that closes a seek table. They are read with ``binaryFile``.

Payloads that repeat are stored once: the record with the smallest page_id is
a ``response``, the others are ``revisit`` records that name it. Which pages
repeat is found from digests alone, so a hot payload never meets in one task.

Defined results: a null payload is empty; a null page_id counts as larger
than every other; all rows that carry the smallest page_id of a payload are
responses; a null url is left out; line breaks in a url are percent-encoded;
texts of any length are one payload; equal rows are
records of their own; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Callable, Iterator

import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_map, binary_view, materialize, new_work_dir

# Fixed values of the public seekable format and of WARC 1.1.
SEEK_MAGIC = 0x8F92EAB1
SKIPPABLE_MAGIC = 0x184D2A5E
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

FRAME_BYTES = 1 << 18
BUNDLE_BYTES = 8 << 20
DATE = "1970-01-01T00:00:00Z"
LEVEL = 3


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id, digest: str) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}:{digest}>"


def page_of(uri: str | None) -> int | None:
    """The page_id in a record identifier."""
    number = uri[len("<urn:page:"):].partition(":")[0] if uri else ""
    return int(number) if number else None


def warc_record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in headers), f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def page_record(page_id, url: str | None, payload: bytes, refers_to: int | None, date: str = DATE) -> bytes:
    """A response record, or a revisit record if ``refers_to`` is given."""
    digest = base32_sha1(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    headers = [("WARC-Type", "response" if refers_to is None else "revisit"),
               ("WARC-Record-ID", record_id(page_id, digest)), ("WARC-Date", date),
               ("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http; msgtype=response")]
    if url is not None:
        safe = url.replace("%", "%25") if "\r" in url or "\n" in url else url
        headers.append(("WARC-Target-URI", safe.replace("\r", "%0D").replace("\n", "%0A")))
    if refers_to is None:
        return warc_record(headers, http + payload)
    headers += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_id(refers_to, digest))]
    return warc_record(headers, http)


class BundleWriter:
    """Collects records into frames and frames into one seekable bundle."""

    def __init__(self, name: str, frame_bytes: int, date: str):
        self.frame_bytes, self.body, self.entries, self.held = frame_bytes, [], [], []
        self.packer = zstandard.ZstdCompressor(level=LEVEL, write_content_size=True)
        self.size = self.waiting = 0
        self.add(warc_record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:bundle:{name}>"),
                              ("WARC-Date", date), ("WARC-Filename", name),
                              ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n"))

    def add(self, record: bytes) -> None:
        if self.held and self.waiting + len(record) > self.frame_bytes:
            self.flush()
        self.held.append(record)
        self.waiting += len(record)

    def flush(self) -> None:
        if not self.held:
            return
        plain = b"".join(self.held)
        packed = self.packer.compress(plain)
        self.entries.append(struct.pack("<III", len(packed), len(plain), xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF))
        self.body.append(packed)
        self.size += len(packed)
        self.held, self.waiting = [], 0

    def close(self) -> bytes:
        self.flush()
        table = b"".join(self.entries) + struct.pack("<IBI", len(self.entries), 0x80, SEEK_MAGIC)
        return b"".join(self.body) + struct.pack("<II", SKIPPABLE_MAGIC, len(table)) + table


def seek_table(bundle: bytes) -> list[tuple[int, int, int, int | None]]:
    """(start, packed size, plain size, checksum) of every frame."""
    count, flags, magic = struct.unpack("<IBI", bundle[-9:])
    if magic != SEEK_MAGIC:
        raise ValueError("not a seekable bundle")
    width = 12 if flags & 0x80 else 8
    at, start, out = len(bundle) - 9 - count * width, 0, []
    for i in range(count):
        packed, plain = struct.unpack_from("<II", bundle, at + i * width)
        check = struct.unpack_from("<I", bundle, at + i * width + 8)[0] if width == 12 else None
        out.append((start, packed, plain, check))
        start += packed
    return out


def read_frame(bundle: bytes, entry: tuple) -> bytes:
    start, packed, plain_size, check = entry
    plain = zstandard.ZstdDecompressor().decompress(bundle[start:start + packed], max_output_size=plain_size)
    if len(plain) != plain_size or check is not None and xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF != check:
        raise ValueError("a frame does not match its seek table")
    return plain


def parse_record(frame: bytes, at: int) -> tuple[dict[str, str], bytes, int]:
    """(headers, block, offset of the next record) of the record at ``at``."""
    end = frame.index(b"\r\n\r\n", at)
    lines = frame[at:end].decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no record at this offset")
    headers = dict(x.split(": ", 1) for x in lines[1:])
    body, n = end + 4, int(headers["Content-Length"])
    return headers, frame[body:body + n], body + n + 4


def http_parts(block: bytes) -> tuple[int, bytes]:
    """(Content-Length, payload) of an HTTP response block."""
    head, _, payload = block.partition(b"\r\n\r\n")
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        if name.lower() == b"content-length":
            return int(value), payload
    raise ValueError("no Content-Length")


def _bundles(frame_bytes: int, bundle_bytes: int, date: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made, writer = TaskContext.get().partitionId(), 0, None
        for batch in batches:
            data, offsets = binary_view(batch.column("payload"))
            ids, urls = batch.column("page_id").to_pylist(), batch.column("url").to_pylist()
            refers, marked = batch.column("refers_to").to_pylist(), batch.column("revisit").to_pylist()
            for i, page_id in enumerate(ids):
                if writer is None:
                    writer = BundleWriter(f"{part:06d}-{made:06d}.warc.zst", frame_bytes, date)
                payload = data[offsets[i]:offsets[i + 1]].tobytes()
                writer.add(page_record(page_id, urls[i], payload, refers[i] if marked[i] else None, date))
                if writer.size + writer.waiting >= bundle_bytes:
                    yield pa.RecordBatch.from_arrays([pa.array([writer.close()[:-4]], pa.binary())], names=["bundle"])
                    writer, made = None, made + 1
        if writer is not None:
            yield pa.RecordBatch.from_arrays([pa.array([writer.close()[:-4]], pa.binary())], names=["bundle"])
    return run


def write_archives(pages: DataFrame, path: str, min_revisit_bytes: int = 0, frame_bytes: int = FRAME_BYTES,
                   bundle_bytes: int = BUNDLE_BYTES, date: str = DATE) -> None:
    """Write ``pages`` (page_id, url, html) as seekable bundles under ``path``.
    Payloads shorter than ``min_revisit_bytes`` are always stored in full."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select("page_id", "url", payload.alias("payload"), F.sha1(payload.cast("binary")).alias("sha"))
    keys = rows.filter(F.octet_length("payload") >= min_revisit_bytes).select("page_id", "sha")
    groups = keys.groupBy("sha").agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")) \
        .filter("n > 1 and refers_to is not null")
    again = keys.join(groups, "sha").filter("not (page_id <=> refers_to)") \
        .select(F.col("page_id").alias("_page"), F.col("sha").alias("_sha"), "refers_to").distinct()
    again = materialize(again, "revisits")
    on = F.col("page_id").eqNullSafe(F.col("_page")) & (F.col("sha") == F.col("_sha"))
    marked = rows.join(again, on, "left").select(
        "page_id", "url", "payload", "refers_to", F.col("refers_to").isNotNull().alias("revisit"))
    bundles = arrow_map(marked, _bundles(frame_bytes, bundle_bytes, date), "bundle binary")
    closing = struct.pack("<I", SEEK_MAGIC).decode("latin-1")
    bundles.select(F.col("bundle").cast("string")).write.mode("errorifexists") \
        .option("maxRecordsPerFile", 1).option("lineSep", closing).option("encoding", "ISO-8859-1") \
        .option("compression", "none").text(path)


_INDEX = "bundle string, record_id string, frame int, record_offset bigint, record_bytes bigint, page_id bigint, " \
         "payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in _INDEX.split(", ")]
    for batch in batches:
        for i in range(batch.num_rows):
            bundle = batch.column("content")[i].as_py()
            name = batch.column("path")[i].as_py().rpartition("/")[2]
            rows = []
            for k, entry in enumerate(seek_table(bundle)):
                frame, at = read_frame(bundle, entry), 0
                while at < len(frame):
                    headers, block, end = parse_record(frame, at)
                    if headers["WARC-Type"] in ("response", "revisit"):
                        size, payload = http_parts(block)
                        digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
                        if headers["WARC-Type"] == "response" and (len(payload) != size or base32_sha1(payload) != digest):
                            raise ValueError(f"{headers['WARC-Record-ID']}: payload does not match its digest")
                        rows.append((name, headers["WARC-Record-ID"], k, at, end - at, page_of(headers["WARC-Record-ID"]),
                                     size, digest, headers["WARC-Type"], page_of(headers.get("WARC-Refers-To"))))
                    at = end
            columns = list(zip(*rows)) if rows else [[] for _ in names]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, [pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64(),
                                                          pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()])],
                names=names)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Read every record back and verify it: the index of the archives, one
    row per page record (bundle, frame, offset inside the frame, digests)."""
    files = spark.read.format("binaryFile").load(path).filter("length > 0").select("path", "content")
    return arrow_map(files, _scan, _INDEX)


def _fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            bundle, ids, payloads, opened = batch.column("content")[i].as_py(), [], [], {}
            table = seek_table(bundle)
            for spot in sorted(batch.column("spots")[i].as_py(), key=lambda s: (s["frame"], s["record_offset"])):
                if spot["frame"] not in opened:
                    opened = {spot["frame"]: read_frame(bundle, table[spot["frame"]])}
                headers, block, _ = parse_record(opened[spot["frame"]], spot["record_offset"])
                ids.append(headers["WARC-Record-ID"])
                payloads.append(http_parts(block)[1])
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(payloads, pa.binary())],
                                             names=["record_id", "payload"])


def fetch_records(spark: SparkSession, path: str, index: DataFrame, wanted: DataFrame) -> DataFrame:
    """record_id and payload of the records named by ``wanted.record_id``:
    only their frames are decompressed. A bundle bounds the spots in a row."""
    spots = index.join(wanted.select("record_id").distinct(), "record_id", "left_semi").groupBy("bundle") \
        .agg(F.collect_set(F.struct("frame", "record_offset")).alias("spots"))
    files = spark.read.format("binaryFile").load(path) \
        .select(F.element_at(F.split("path", "/"), -1).alias("bundle"), "content")
    return arrow_map(files.join(spots, "bundle").select("content", "spots"), _fetch, "record_id string, payload binary")


def archive_pages(pages: DataFrame) -> DataFrame:
    """Write ``pages`` to fresh archives in the shared folder and read the
    digest of every record back."""
    path = new_work_dir(pages.sparkSession, "warc")
    write_archives(pages, path)
    return read_archives(pages.sparkSession, path).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to",
        "bundle", "frame", "record_offset", "record_bytes")
