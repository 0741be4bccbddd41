"""WARC archives: written by Spark's text writer, read back, and assembled per capture.

A page becomes three records that name each other through WARC-Concurrent-To: request,
response (or revisit) and metadata. A payload's digest is its SHA-1 in base32; of the pages
with equal payloads of at least ``min_bytes`` bytes, the smallest page id keeps the payload
and the others revisit it. Archives are gzip streams of records; reading follows each
record's Content-Length and checks nothing but what it needs. ``captures`` joins the three
kinds of records again and gives one nested row per response or revisit.

A null html is an empty payload. Pages that repeat the smallest page id with the same
payload are responses each. A null page id comes after all others. A null url is written
without a target. Archive files are bounded by ``RECORDS_PER_FILE``, batches of records by
``READ_BYTES``; other columns of the pages are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmart.llm.common import ready, stored, stored_side
from trailmart.session import fresh_path

RECORDS_PER_FILE, READ_BYTES = 12_000, 4 << 20
#: Most duplicated payloads whose first page is broadcast; beyond it the pages are shuffled.
BROADCAST_PAYLOADS = 200_000
BLANK = "\r\n\r\n"
HTTP = "application/http; msgtype="
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# The letters of base32, beside the digits that conv() gives for 0 to 31.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
CONV32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
RECORDS = """
    record_id string, record_type string, target_uri string, concurrent_to string,
    refers_to_page bigint, page_id bigint, headers map<string, string>,
    declared_digest string, declared_bytes bigint, payload binary
"""
NAMES = [column.split()[0] for column in RECORDS.replace("map<string, string>", "m").split(",")]


def base32_sha1(text: Column) -> Column:
    """The SHA-1 of a text's UTF-8 bytes in upper-case base32: 4 letters for 20 bits."""
    digits = F.sha1(text.cast("binary"))
    parts = [
        F.lpad(F.conv(F.substring(digits, at, 5), 16, 32), 4, "0") for at in range(1, 41, 5)
    ]
    return F.translate(F.concat(*parts), CONV32, BASE32)


def with_types(pages: DataFrame, min_bytes: int) -> DataFrame:
    """(page_id, url, payload, digest, first_page, first_url) of each page.

    ``first_page`` is null for responses. Only digests and ids are grouped; the pages
    themselves are shuffled only if too many payloads repeat for a broadcast.
    """
    payload = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", "url", payload.alias("payload"))
    rows = rows.withColumn("digest", base32_sha1(F.col("payload")))
    long_enough = F.octet_length("payload") >= min_bytes
    order = F.struct(F.col("page_id").isNull().alias("last"), "page_id", "url")
    repeats = (
        rows.filter(long_enough)
        .groupBy("digest")
        .agg(F.min(order).alias("first"), F.count("*").alias("copies"))
        .filter("copies > 1")
        .select(
            F.col("digest").alias("repeated"),
            F.col("first.page_id").alias("first_page"),
            F.col("first.url").alias("first_url"),
        )
    )
    side = stored_side(repeats, "repeats", BROADCAST_PAYLOADS)
    later = ~F.col("page_id").eqNullSafe(F.col("first_page"))
    same = (F.col("digest") == F.col("repeated")) & long_enough & later
    return rows.join(side, same, "left")


def _record(kind: Column, headers: list[tuple[str, Column]], block: Column) -> Column:
    lines = [F.concat(F.lit("WARC/1.1\r\nWARC-Type: "), kind)]
    for name, value in headers:
        lines.append(F.coalesce(F.concat(F.lit(f"\r\n{name}: "), value), F.lit("")))
    length = F.octet_length(block).cast("string")
    return F.concat(*lines, F.lit("\r\nContent-Length: "), length, F.lit(BLANK), block)


def _one_line(value: Column) -> Column:
    return F.translate(value, "\r\n", "")


def record_texts(typed: DataFrame) -> DataFrame:
    """(value): the records of each page, three rows a page."""
    page, url = F.col("page_id").cast("string"), _one_line(F.col("url"))
    revisit = F.col("repeated").isNotNull()
    rows = typed.withColumn("capture", F.expr("uuid()"))
    urn = F.concat(F.lit("<urn:uuid:"), F.col("capture"), F.lit(">"))
    day = ("WARC-Date", F.lit("1970-01-01T00:00:00Z"))
    shared = [("WARC-Target-URI", url), day]
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.octet_length("payload").cast("string"),
        F.lit(BLANK),
    )
    response = _record(
        F.when(revisit, "revisit").otherwise("response"),
        [
            ("WARC-Record-ID", urn),
            *shared,
            ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
            ("WARC-Profile", F.when(revisit, PROFILE)),
            ("WARC-Refers-To-Target-URI", F.when(revisit, _one_line(F.col("first_url")))),
            ("WARC-Refers-To-Page", F.when(revisit, F.col("first_page").cast("string"))),
            ("Content-Type", F.lit(f"{HTTP}response")),
        ],
        F.concat(http, F.when(revisit, "").otherwise(F.col("payload"))),
    )
    asked = F.concat(
        F.lit("GET "),
        F.coalesce(url, F.lit("/")),
        F.lit(" HTTP/1.1\r\nUser-Agent: trailmart"),
        F.lit(BLANK),
    )
    side = {
        "request": (asked, f"{HTTP}request"),
        "metadata": (
            F.coalesce(F.concat(F.lit("page-id: "), page, F.lit("\r\n")), F.lit("")),
            "application/warc-fields",
        ),
    }
    others = [
        _record(
            F.lit(kind),
            [
                ("WARC-Record-ID", F.regexp_replace(urn, ">$", f"/{kind}>")),
                *shared,
                ("WARC-Concurrent-To", urn),
                ("Content-Type", F.lit(content)),
            ],
            block,
        )
        for kind, (block, content) in side.items()
    ]
    return rows.select(F.explode(F.array(others[0], response, others[1])).alias("value"))


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0) -> None:
    """Write the records of the pages as gzip streams of WARC records."""
    ready(pages.sparkSession)
    texts = record_texts(with_types(pages, min_bytes))
    options = {"lineSep": BLANK, "compression": "gzip", "maxRecordsPerFile": RECORDS_PER_FILE}
    texts.write.options(**options).text(folder)


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """The records of all archives in a folder, with the payload of responses."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch["content"]:
                yield from _batches(_parsed(_Stream(memoryview(content.as_buffer()))))

    files = ready(spark).read.format("binaryFile").load(folder)
    return files.select("content").mapInArrow(parse, RECORDS)


class _Stream:
    """Bytes of a plain file or of gzip members, one after the other."""

    def __init__(self, content: memoryview) -> None:
        self.content, self.at, self.ready, self.unpack = content, 0, bytearray(), None
        self.packed = bytes(content[:2]) == b"\x1f\x8b"

    def _more(self) -> bool:
        part = self.content[self.at : self.at + 65_536]
        if not len(part):
            return False
        self.at += len(part)
        if not self.packed:
            self.ready += part
            return True
        self.unpack = self.unpack or zlib.decompressobj(wbits=31)
        self.ready += self.unpack.decompress(part)
        if self.unpack.eof:
            self.at -= len(self.unpack.unused_data)
            self.unpack = None
        return True

    def take(self, size: int) -> bytes:
        while len(self.ready) < size and self._more():
            pass
        taken = bytes(self.ready[:size])
        del self.ready[:size]
        return taken

    def until(self, mark: bytes) -> bytes | None:
        """What lies before a mark, which is passed over; None at the end."""
        looked = 0
        while (at := self.ready.find(mark, looked)) < 0:
            looked = max(0, len(self.ready) - len(mark))
            if not self._more():
                return None
        head = self.take(at)
        self.take(len(mark))
        return head


def _headers(block: bytes) -> dict[str, str]:
    lines = block.decode("utf-8", "replace").split("\r\n")
    pairs = (line.partition(":") for line in lines if ":" in line)
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


def _number(value: str | None) -> int | None:
    return int(value) if value and value.lstrip("-").isdigit() else None


def _parsed(stream: _Stream) -> Iterator[tuple]:
    while (head := stream.until(b"\r\n\r\n")) is not None:
        if not head.strip():
            continue
        headers = _headers(head.lstrip())
        block = stream.take(_number(headers.get("content-length")) or 0)
        kind = headers.get("warc-type", "")
        payload = page = length = None
        if kind in ("response", "revisit"):
            http, _, body = block.partition(b"\r\n\r\n")
            length = _number(_headers(http).get("content-length"))
            payload = body if kind == "response" else None
        elif kind == "metadata":
            page = _number(_headers(block).get("page-id"))
        digest = headers.get("warc-payload-digest", "").removeprefix("sha1:") or None
        yield (
            headers.get("warc-record-id"), kind, headers.get("warc-target-uri"),
            headers.get("warc-concurrent-to"), _number(headers.get("warc-refers-to-page")), page,
            list(headers.items()), digest, length, payload,
        )


KINDS = (
    *[pa.string()] * 4, *[pa.int64()] * 2, pa.map_(pa.string(), pa.string()), pa.string(),
    pa.int64(), pa.binary(),
)


def _batches(records: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    waiting, size = [], 0
    for record in records:
        waiting.append(record)
        size += 1_000 + len(record[-1] or b"")
        if size >= READ_BYTES:
            yield _batch(waiting)
            waiting, size = [], 0
    if waiting:
        yield _batch(waiting)


def _batch(records: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(column, kind) for column, kind in zip(zip(*records), KINDS)]
    return pa.RecordBatch.from_arrays(columns, NAMES)


def captures(records: DataFrame) -> DataFrame:
    """One nested row per capture: (record_id, response, request, metadata).

    The response (or revisit) joins the request and the metadata that are concurrent to it;
    a capture without one of them has a null struct there.
    """
    inner = [name for name in records.columns if name not in ("record_id", "concurrent_to")]

    def of(*kinds: str) -> DataFrame:
        return records.filter(F.col("record_type").isin(*kinds))

    whole = of("response", "revisit").select("record_id", F.struct(*inner).alias("response"))
    for kind in ("request", "metadata"):
        own = of(kind).select(
            F.col("concurrent_to").alias("record_id"),
            F.struct(F.col("record_id").alias(f"{kind}_id"), *inner).alias(kind),
        )
        whole = whole.join(own, "record_id", "left")
    return whole


def payload_columns(records: DataFrame) -> DataFrame:
    """Records with the size and digest of the full payload in place of the payload.

    Both come from the bytes that were read; revisits, which have none, declare them.
    """
    payload = F.col("payload")
    size = F.coalesce(F.octet_length(payload).cast("bigint"), "declared_bytes")
    digest = F.coalesce(base32_sha1(payload), "declared_digest")
    return records.withColumns({"payload_bytes": size, "payload_digest": digest}).drop("payload")


def round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write the pages, read the archives and give one row per page."""
    spark = pages.sparkSession
    folder = fresh_path(spark, "warc")
    write_archives(pages, folder, min_bytes)
    narrow = payload_columns(read_records(spark, folder)).drop("headers")
    whole = captures(stored(narrow, "records"))
    return whole.select(
        "metadata.page_id",
        "response.payload_bytes",
        "response.payload_digest",
        "response.record_type",
        F.col("response.refers_to_page").alias("refers_to"),
    )
