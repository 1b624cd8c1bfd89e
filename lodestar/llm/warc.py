"""WARC archives as seekable Zstandard bundles.

A bundle is a chain of Zstandard frames. Each of the first ones holds whole WARC/1.1 records of together about
``FRAME_BYTES`` and can be read alone. Then follow, as skippable frames that any decoder passes over: the record map
(page id, frame, offset in the frame, length), the seek table of the Zstandard seekable format (sizes of each
frame, their number, its magic number), and nine bytes that end in the line end of the writer. So a record is
read by seeking to one frame.

Bundles are written by Spark's own writer, one row a file, to any store that Spark reaches.

Of records with equal payloads of at least ``min_bytes`` that with the smallest page id is a response, the
others revisit it. Defined results: a null html is the empty payload; rows that share that smallest id are all responses; a row without
page_id has no turn of its own: it revisits the smallest id there is, and is a response if there is none. A null url is written as ``urn:lodestar:unknown``;
blanks and control characters in it are percent-encoded. Other columns are not looked at. An empty table gives no bundle.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.llm import common

FRAME_BYTES, BUNDLE_BYTES, DATE = 256 << 10, 8 << 20, "1970-01-01T00:00:00Z"
SKIP, SKIP_MAP, SEEKABLE, TAIL = 0x184D2A5E, 0x184D2A5D, 0x8F92EAB1, 9
NO_ID = -(1 << 63)


def record_name(page_id: int | None) -> str:
    return f"<urn:lodestar:page:{'none' if page_id is None else page_id}>"


def page_of(name: str) -> int | None:
    value = name.rsplit(":", 1)[1].rstrip(">")
    return None if value == "none" else int(value)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str = DATE) -> bytes:
    """One WARC record: a response, or a revisit (without payload) if refers_to is given."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "urn:lodestar:unknown")
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {record_name(page_id)}", f"WARC-Date: {date}", f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha1:{digest}"]
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {record_name(refers_to)}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"


def parse(raw: bytes, at: int = 0) -> tuple[dict[str, str], dict[str, str], bytes, int]:
    """(WARC headers, HTTP headers, payload, position after) of the record at a position."""

    def headers(start: int) -> tuple[dict[str, str], int]:
        end = raw.index(b"\r\n\r\n", start)
        lines = raw[start:end].decode("utf-8", "surrogatepass").split("\r\n")
        return {"": lines[0]} | {k.lower(): v for k, v in (x.split(": ", 1) for x in lines[1:])}, end + 4

    warc, body = headers(at)
    if warc[""] != "WARC/1.1":
        raise ValueError("not a WARC record")
    end = body + int(warc["content-length"])
    http, payload = headers(body)
    return warc, http, raw[payload:end], end + 4


class Bundle:
    """A bundle in the making; add records, then finish()."""

    def __init__(self):
        import zstandard

        self.pack = zstandard.ZstdCompressor(level=3).compress
        self.frames, self.sizes, self.rows, self.held, self.length = [], [], [], [], 0
        self.raw = 0

    def add(self, page_id: int | None, raw: bytes) -> None:
        self.rows.append((NO_ID if page_id is None else page_id, len(self.frames), self.length, len(raw)))
        self.held.append(raw)
        self.length += len(raw)
        self.raw += len(raw)
        if self.length >= FRAME_BYTES:
            self.close_frame()

    def close_frame(self) -> None:
        if self.held:
            frame = self.pack(b"".join(self.held))
            self.sizes.append((len(frame), self.length))
            self.frames.append(frame)
            self.held, self.length = [], 0

    def finish(self) -> bytes:
        """Everything but the last byte, which the writer adds."""
        self.close_frame()
        names = b"".join(struct.pack("<qIII", *r) for r in self.rows)
        seek = b"".join(struct.pack("<II", *s) for s in self.sizes) + struct.pack("<IBI", len(self.sizes), 0, SEEKABLE)
        return b"".join([*self.frames, struct.pack("<II", SKIP_MAP, len(names)), names, struct.pack("<II", SKIP, len(seek)), seek, struct.pack("<II", SKIP, 1)])


class BundleReader:
    """Random access to the records of a bundle's bytes."""

    def __init__(self, raw: bytes):
        import zstandard

        self.raw, self.unpack = raw, zstandard.ZstdDecompressor().decompress
        end = len(raw) - TAIL
        n, _, magic = struct.unpack_from("<IBI", raw, end - 9)
        if magic != SEEKABLE:
            raise ValueError("no seek table")
        table = end - 9 - 8 * n
        sizes = list(struct.iter_unpack("<II", raw[table : end - 9]))
        self.frames, at = [], 0
        for packed, size in sizes:
            self.frames.append((at, packed, size))
            at += packed
        _, length = struct.unpack_from("<II", raw, at)
        self.rows = list(struct.iter_unpack("<qIII", raw[at + 8 : at + 8 + length]))
        self.places: dict[int, tuple[int, int]] | None = None

    def frame(self, k: int) -> bytes:
        at, packed, size = self.frames[k]
        return self.unpack(self.raw[at : at + packed], max_output_size=size)

    def records(self):
        """(page_id, WARC headers, HTTP headers, payload) of each record, by the record map."""
        k, frame = -1, b""
        for page_id, f, offset, _ in self.rows:
            if f != k:
                k, frame = f, self.frame(f)
            yield (None if page_id == NO_ID else page_id, *parse(frame, offset)[:3])

    def get(self, page_id: int):
        """The record of a page id, from its one frame; None if the bundle has none."""
        if self.places is None:
            self.places = {name: (f, offset) for name, f, offset, _ in reversed(self.rows)}
        if page_id not in self.places:
            return None
        f, offset = self.places[page_id]
        return (page_id, *parse(self.frame(f), offset)[:3])


def write(pages: DataFrame, path: str, min_bytes: int = 0) -> None:
    """Writes bundles of pages (page_id, url, html) under path."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "utf-8").alias("payload"))
    keys = rows.select("page_id", F.sha1("payload").alias("sha"), F.octet_length("payload").alias("size")).where(F.col("size") >= min_bytes)
    firsts = keys.groupBy("sha").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1 and first is not null").select("sha", "first")
    again = keys.join(firsts, "sha").where("page_id is null or page_id <> first").select("page_id", "sha", F.col("first").alias("refers_to")).distinct()
    joined = rows.withColumn("sha", F.sha1("payload")).alias("p").join(again.alias("a"), F.expr("p.page_id <=> a.page_id and p.sha = a.sha"), "left").select("p.page_id", "url", "payload", "refers_to")
    schema = pa.schema([("content", pa.binary())])

    def run(batches):
        bundle = Bundle()
        for b in batches:
            for page_id, url, payload, first in zip(*(c.to_pylist() for c in b.columns)):
                digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                bundle.add(page_id, record(page_id, url, payload, digest, first))
                if bundle.raw >= BUNDLE_BYTES:
                    yield common.batch(schema, [bundle.finish()])
                    bundle = Bundle()
        if bundle.rows:
            yield common.batch(schema, [bundle.finish()])

    bundles = common.map_arrow(joined, run, "content binary")
    bundles.select(F.col("content").cast("string").alias("value")).write.option("maxRecordsPerFile", 1).text(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """One row a record of the bundles under path: page_id, url, record_type, payload (null for a revisit), payload_bytes, payload_digest, refers_to."""
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64())])

    def run(batches):
        for b in batches:
            for raw in b.column(0):
                rows = []
                for page_id, warc, http, payload in BundleReader(raw.as_py()).records():
                    kind, digest = warc["warc-type"], warc["warc-payload-digest"].removeprefix("sha1:")
                    if kind == "response" and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                        raise ValueError(f"the payload of {warc['warc-record-id']} does not have its digest")
                    rows.append((page_id, warc["warc-target-uri"], kind, payload if kind == "response" else None, int(http["content-length"]), digest, page_of(warc["warc-refers-to"]) if kind == "revisit" else None))
                    if len(rows) == 200:
                        yield common.batch(schema, *zip(*rows))
                        rows = []
                if rows:
                    yield common.batch(schema, *zip(*rows))

    common.small_batches(spark)
    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, "page_id long, url string, record_type string, payload binary, payload_bytes long, payload_digest string, refers_to long")


def index(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, file, frame, packed, size, offset): where each record lies (its frame's first byte, packed and unpacked size, the record's offset in it). Made when
    first asked for, beside the bundles and sorted by page_id, and kept; a filter on page_id reads few row groups of it."""
    place = f"{path.rstrip('/')}/_index"
    names = "page_id long, file string, frame long, packed long, size long, offset long"
    p = spark._jvm.org.apache.hadoop.fs.Path(place + "/_SUCCESS")
    if not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        schema = pa.schema([("page_id", pa.int64()), ("file", pa.string()), *((k, pa.int64()) for k in ("frame", "packed", "size", "offset"))])

        def run(batches):
            for b in batches:
                for name, raw in zip(b.column(0).to_pylist(), b.column(1)):
                    reader = BundleReader(raw.as_py())
                    rows = [(page_id, name, *reader.frames[f], offset) for page_id, f, offset, _ in reader.rows if page_id != NO_ID]
                    if rows:
                        yield common.batch(schema, *zip(*rows))

        common.small_batches(spark)
        spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, names).sort("page_id").write.mode("overwrite").parquet(place)
    return spark.read.schema(names).parquet(place)


def fetch(spark: SparkSession, path: str, page_id: int):
    """(page_id, WARC headers, HTTP headers, payload) of a page, reading one frame of one bundle; None if there is none."""
    import zstandard

    for r in index(spark, path).where(F.col("page_id") == page_id).limit(1).collect():
        frame = zstandard.ZstdDecompressor().decompress(common.ranged(spark, r.file, r.frame, r.packed), max_output_size=r.size)
        return (page_id, *parse(frame, r.offset)[:3])
    return None


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = common.fresh_path(spark, "warc")
    write(common.table(spark, sf_dir, "pages"), path)
    return read(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def _base32_of_hex() -> str:
    """SQL for the base32 form of a SHA-1 in hexadecimal, h: 20 bits at a time."""
    digit = "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (((('0x' || substr(h, 1 + 5 * {g}, 5))::BIGINT) >> {s}) & 31)::INTEGER, 1)"
    return " || ".join(digit.format(g=g, s=s) for g in range(8) for s in (15, 10, 5, 0))


ORACLE_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS h FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first FROM p)
SELECT page_id, strlen(body)::BIGINT AS payload_bytes, {_base32_of_hex()} AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to FROM f
"""
