"""WARC archives: captures are written as request, response (or revisit) and metadata records and assembled again when read.

Writing is a plan of column expressions and Spark's own text writer (a record ends with an empty line, which is the writer's line
separator), one gzip file a task. Reading parses whole archives in Arrow batches by Content-Length, so a payload may hold anything,
also what looks like a record.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.llm.common import joined_small, repeated, saved
from tallymark.llm.reputation import PARTS

DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Records of an archive at most (three for each capture).
FILE_RECORDS = 60_000
CHUNK = 1 << 20

RECORD = (
    "record_id string, kind string, concurrent_to string, refers_to string, target_uri string, "
    "declared_digest string, payload_bytes bigint, payload_digest string, payload binary, page_id bigint, page_bytes bigint"
)
_ARROW = {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}


def sha1_base32(data: Column) -> Column:
    """The SHA-1 of binary data in upper-case base32 without padding."""
    hexed = F.sha1(data)
    groups = [F.lpad(F.conv(F.substring(hexed, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _id(kind: str, *parts: Column) -> Column:
    h = F.md5(F.concat_ws("|", F.lit(kind), *[F.coalesce(p.cast("string"), F.lit("-")) for p in parts]))
    pieces = [F.substring(h, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *pieces), F.lit(">"))


def _record(headers: list[Column], block: Column) -> Column:
    """The text of a record without its last empty line; a null header is left out."""
    size = F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"))
    return F.concat(F.concat_ws("\r\n", F.lit("WARC/1.1"), *headers, size), F.lit("\r\n\r\n"), block)


def _header(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value)


def write_archives(pages: DataFrame, path: str, smallest: int = 0) -> None:
    """Write one capture per row of `pages` (page_id, url, html) below `path`.

    Of payloads of at least `smallest` bytes that are equal, the one with the largest page_id is a response, the others revisit it
    and hold no payload; smaller ones are all responses. A null page_id is the smallest; if a row is repeated, so is its capture (the
    largest page_id of a payload may thus be written several times). A null html is an empty payload; a null url has no
    target; line ends in a url are percent-encoded. Other columns are not written; an empty table gives no records.
    """
    html, low = F.coalesce("html", F.lit("")), F.lit(-(1 << 63))
    size = F.octet_length(html)
    digests = pages.select("page_id", sha1_base32(F.encode(html, "UTF-8")).alias("digest"), size.alias("bytes"))
    # only payloads that repeat need to know their first; those are few as a rule, and then no payload is shuffled
    first = digests.filter(F.col("bytes") >= smallest).groupBy("digest", "bytes").agg(
        F.max(F.coalesce("page_id", low)).alias("first"), F.min(F.coalesce("page_id", low)).alias("last")
    ).filter("first <> last").drop("last")
    rows = joined_small(
        pages.select(
            "page_id", F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A").alias("uri"), html.alias("html"),
            sha1_base32(F.encode(html, "UTF-8")).alias("digest"), size.alias("bytes"),
        ), saved(first, "payloads"), ["digest", "bytes"],
    )
    own = _id("capture", F.col("page_id"), F.col("digest"), F.col("bytes"), F.col("uri"))
    again = F.col("first").isNotNull() & (F.coalesce("page_id", low) != F.col("first"))
    page = F.when(F.col("first") != low, F.col("first"))
    common = [_header("WARC-Date", F.lit(DATE)), _header("WARC-Target-URI", F.col("uri"))]
    digest = _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes").cast("string"), F.lit("\r\n\r\n"))
    kind = [_header("Content-Type", F.lit("application/http;msgtype=response"))]
    response = _record([_header("WARC-Type", F.lit("response")), _header("WARC-Record-ID", own), *common, digest, *kind], F.concat(http, F.col("html")))
    revisit = _record(
        [
            _header("WARC-Type", F.lit("revisit")), _header("WARC-Record-ID", own), *common, digest, *kind,
            _header("WARC-Profile", F.lit(PROFILE)), _header("WARC-Refers-To-Page", page.cast("string")),
        ], http,
    )
    host, path_part = F.regexp_extract("uri", PARTS, 1), F.regexp_extract("uri", PARTS, 2)
    get = F.concat(F.lit("GET "), F.coalesce(F.when(path_part != "", path_part), F.lit("/")), F.lit(" HTTP/1.1\r\nHost: "), F.coalesce(host, F.lit("")), F.lit("\r\n\r\n"))
    request = _record(
        [
            _header("WARC-Type", F.lit("request")), _header("WARC-Record-ID", _id("request", own)), *common,
            _header("WARC-Concurrent-To", own), _header("Content-Type", F.lit("application/http;msgtype=request")),
        ], get,
    )
    fields = F.concat_ws("\r\n", _header("page_id", F.col("page_id").cast("string")), _header("payload_bytes", F.col("bytes").cast("string")))
    metadata = _record(
        [
            _header("WARC-Type", F.lit("metadata")), _header("WARC-Record-ID", _id("metadata", own)), *common,
            _header("WARC-Concurrent-To", own), _header("Content-Type", F.lit("application/warc-fields")),
        ], F.concat(fields, F.lit("\r\n")),
    )
    records = rows.select(F.explode(F.array(request, F.when(again, revisit).otherwise(response), metadata)).alias("value"))
    (
        records.write.option("lineSep", "\r\n\r\n").option("compression", "gzip")
        .option("maxRecordsPerFile", FILE_RECORDS).text(path)
    )


class _Bytes:
    """The bytes of an archive, gzip members one after the other or plain, without holding all of them."""

    def __init__(self, data: memoryview):
        self.data, self.at, self.held, self.zip = data, 0, bytearray(), None
        self.zipped = bytes(data[:2]) == b"\x1f\x8b"

    def more(self) -> bool:
        if self.at >= len(self.data) and not (self.zip and self.zip.unused_data):
            return False
        piece = bytes(self.data[self.at : self.at + CHUNK])
        self.at += len(piece)
        if not self.zipped:
            self.held += piece
            return True
        while piece:
            if self.zip is None or self.zip.eof:
                self.zip = zlib.decompressobj(31)
            self.held += self.zip.decompress(piece)
            piece = self.zip.unused_data if self.zip.eof else b""
        return True

    def line(self) -> bytes | None:
        seen = 0
        while (end := self.held.find(b"\r\n", seen)) < 0:
            seen = max(len(self.held) - 1, 0)
            if not self.more():
                return None
        found = bytes(self.held[:end])
        del self.held[: end + 2]
        return found

    def take(self, n: int) -> bytes:
        while len(self.held) < n:
            if not self.more():
                raise ValueError("an archive ends inside a record")
        found = bytes(self.held[:n])
        del self.held[:n]
        return found


def parse(data: memoryview) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers with lower-case names, block) of each record of an archive."""
    source = _Bytes(data)
    while (line := source.line()) is not None:
        if not line:
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record begins with {line[:40]!r}")
        headers = {}
        while line := source.line():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            headers[name.strip().lower()] = value.strip()
        yield headers, source.take(int(headers.get("content-length", "0")))


def _row(headers: dict[str, str], block: bytes) -> dict:
    kind, payload, fields = headers.get("warc-type"), None, {}
    if kind in ("response", "revisit"):
        _, _, payload = block.partition(b"\r\n\r\n")
    elif kind == "metadata":
        fields = dict(x.split(": ", 1) for x in block.decode("utf-8", "replace").split("\r\n") if ": " in x)
    refers = headers.get("warc-refers-to-page")
    full = kind == "response"
    return {
        "record_id": headers.get("warc-record-id"), "kind": kind, "concurrent_to": headers.get("warc-concurrent-to"),
        "refers_to": refers, "target_uri": headers.get("warc-target-uri"),
        "declared_digest": (headers.get("warc-payload-digest") or "").removeprefix("sha1:") or None,
        "payload_bytes": len(payload) if full else None,
        "payload_digest": base64.b32encode(hashlib.sha1(payload).digest()).decode() if full else None,
        "payload": payload if full else None,
        "page_id": int(fields["page_id"]) if fields.get("page_id") else None,
        "page_bytes": int(fields["payload_bytes"]) if fields.get("payload_bytes") else None,
    }


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """The records of all archives below `path` (files named *.warc, *.gz or *.txt); a task holds one archive at a time."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.{warc,gz,txt}").load(path).select("content")
    schema = pa.schema([(name, _ARROW[kind]) for name, kind in (x.split() for x in RECORD.split(", "))])

    def batches(them):
        for batch in them:
            for content in batch.column(0):
                rows, held = [], 0
                for headers, block in parse(memoryview(content.as_buffer())):
                    rows.append(_row(headers, block))
                    held += len(block) + 200
                    if held > 4 * CHUNK:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return files.mapInArrow(batches, RECORD)


def captures(records: DataFrame) -> DataFrame:
    """One nested row per capture: capture_id, page_id, target_uri, request, response, metadata.

    A transaction is the response or revisit and the records that are concurrent to it. All three kinds meet in one shuffle by the
    response's identifier, in place of a join for each kind. A record written several times with one identifier is one record,
    and the capture comes out as often as its response was written. Captures without a request or metadata have nulls there; records concurrent to nothing in the archives are
    left out.
    """
    main = F.col("kind").isin("response", "revisit")
    by = records.filter(F.col("kind").isin("response", "revisit", "request", "metadata")).withColumn(
        "capture_id", F.when(main, F.col("record_id")).otherwise(F.col("concurrent_to"))
    ).filter("capture_id is not null")

    def first(name: str, of: Column = main) -> Column:
        return F.first(F.when(of, F.col(name)), ignorenulls=True)

    request, metadata = F.col("kind") == "request", F.col("kind") == "metadata"
    grouped = by.groupBy("capture_id").agg(
        F.count(F.when(main, 1)).alias("copies"),
        first("target_uri").alias("target_uri"),
        first("record_id", request).alias("request_id"),
        first("record_id", metadata).alias("metadata_id"),
        first("page_id", metadata).alias("page_id"),
        first("page_bytes", metadata).alias("page_bytes"),
        *[first(c).alias(c) for c in ("kind", "refers_to", "declared_digest", "payload_bytes", "payload_digest", "payload")],
    ).filter("copies > 0")
    nested = grouped.select(
        "capture_id", "page_id", "target_uri", "copies",
        F.struct("request_id").alias("request"),
        F.struct("kind", "declared_digest", "payload_bytes", "payload_digest", "payload", F.col("refers_to").cast("bigint").alias("refers_to")).alias("response"),
        F.struct("metadata_id", "page_id", "page_bytes").alias("metadata"),
        F.lit(0).cast("bigint").alias("start"),
    )
    return repeated(nested, "copies", "start", "copy").drop("copies", "start", "copy")


def page_records(spark: SparkSession, pages: DataFrame, path: str) -> DataFrame:
    """Archives of `pages` below `path`, read back: page_id, payload_bytes, payload_digest, record_type, refers_to.

    A response's bytes and digest are those of the payload read back; a revisit's are the ones its records declare.
    """
    write_archives(pages, path)
    r = F.col("response")
    return captures(read_records(spark, path)).select(
        "page_id",
        F.coalesce(r["payload_bytes"], F.col("metadata")["page_bytes"]).alias("payload_bytes"),
        F.coalesce(r["payload_digest"], r["declared_digest"]).alias("payload_digest"),
        r["kind"].alias("record_type"),
        r["refers_to"].alias("refers_to"),
    )


SQL = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS h,
    max(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages)
SELECT page_id, payload_bytes,
  translate(array_to_string(list_transform(range(8), lambda i: to_base(('0x' || h[5 * i + 1 : 5 * i + 5])::BIGINT, 32, 4)), ''),
    '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM p
"""
