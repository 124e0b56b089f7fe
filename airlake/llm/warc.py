"""WARC archives: writing captures and assembling them again.

A capture is three records: the request, the response (or a revisit, when an earlier page
had the same payload) and metadata. The others name the request in WARC-Concurrent-To,
and joining on that identifier puts a transaction together again, one nested row each.
"""

from __future__ import annotations

import gzip
import hashlib
import io
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airlake.llm.prefilter import may_match
from airlake.scratch import keep

#: Payloads below are always stored in full.
LEAST_REVISITED_BYTES = 100
#: Captures in a file at most; a file is read by one task.
CAPTURES_PER_FILE = 2_000
#: Bytes of records that go to Spark at a time.
BATCH_BYTES = 8 << 20

IDENTICAL_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORDS = (
    "type STRING, record_id STRING, concurrent_to STRING, uri STRING, date STRING, payload_digest STRING, "
    "refers_to STRING, http_head STRING, payload BINARY"
)


def _urn(md5: Column) -> Column:
    cut = [F.substring(md5, start, n) for start, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def _record(headers: list[tuple[str, Column]], block: Column) -> Column:
    """A record without the two line ends that close it. Null headers are left out."""
    lines = [F.concat(F.lit(f"\r\n{name}: "), value) for name, value in headers]
    lines.append(F.concat(F.lit("\r\nContent-Length: "), F.octet_length(block).cast("string")))
    return F.concat(F.lit("WARC/1.1"), *(F.coalesce(x, F.lit("")) for x in lines), F.lit("\r\n\r\n"), block)


def write_captures(
    pages: DataFrame,
    path: str,
    id_column: str = "page_id",
    url_column: str = "url",
    payload_column: str = "html",
    date: str = "2000-01-01T00:00:00Z",
    least_bytes: int = LEAST_REVISITED_BYTES,
) -> None:
    """Write a request, a response or revisit, and a metadata record for every row.

    Of rows whose payloads are equal and have ``least_bytes`` bytes at least, that with the
    smallest id gets the response, others a revisit record that names it. Rows repeated
    with that id are responses too. A null payload is empty, a null url leaves the URI out,
    a null id is never the smallest. Line ends and blanks are left out of a record's URI;
    the metadata hold the url as it was. Files are gzipped and of bounded row counts.
    """
    rows = pages.select(
        F.col(f"`{id_column}`").cast("long").alias("page"),
        F.col(f"`{url_column}`").cast("string").alias("url"),
        F.coalesce(F.col(f"`{payload_column}`").cast("string"), F.lit("")).alias("payload"),
    ).withColumn("digest", F.sha2(F.col("payload").cast("binary"), 256))
    first = (
        rows.where(F.octet_length("payload") >= least_bytes)
        .groupBy("digest")
        .agg(F.min("page").alias("first"), F.count(F.lit(1)).alias("rows"))
        .where("rows > 1")
        .select("digest", "first")
    )
    # Most payloads are the only ones of their kind: those need not be moved.
    first = keep(first, "first-pages")
    alone = may_match(rows, first, "digest", "left_anti").withColumn("first", F.lit(None).cast("long"))
    rows = may_match(rows, first, "digest").join(first, "digest", "left").unionByName(alone)
    rows = rows.withColumn("capture", F.expr("uuid()"))

    uri = F.regexp_replace("url", r"[\x00-\x20\x7F]", "")
    revisit = F.col("first").isNotNull() & ~F.col("page").eqNullSafe(F.col("first"))
    request_id = F.concat(F.lit("<urn:uuid:"), "capture", F.lit(">"))

    def content_id(page: Column) -> Column:
        return _urn(F.md5(F.concat_ws("|", F.lit("response"), page.cast("string"), "digest").cast("binary")))

    common = [("WARC-Target-URI", uri), ("WARC-Date", F.lit(date))]
    request = _record(
        [("WARC-Type", F.lit("request")), ("WARC-Record-ID", request_id), *common,
         ("Content-Type", F.lit("application/http; msgtype=request"))],
        F.concat(F.lit("GET "), F.coalesce(uri, F.lit("/")), F.lit(" HTTP/1.1\r\n\r\n")),
    )
    head = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.octet_length("payload").cast("string"), F.lit("\r\n\r\n"),
    )
    response = _record(
        [("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
         ("WARC-Record-ID", F.when(revisit, _urn(F.md5(F.concat(F.lit("revisit"), "capture").cast("binary"))))
          .otherwise(content_id(F.col("page")))),
         ("WARC-Concurrent-To", request_id), *common,
         ("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest")),
         ("WARC-Profile", F.when(revisit, IDENTICAL_PAYLOAD)),
         ("WARC-Refers-To", F.when(revisit, content_id(F.col("first")))),
         ("Content-Type", F.lit("application/http; msgtype=response"))],
        F.when(revisit, head).otherwise(F.concat(head, "payload")),
    )
    fields = [
        ("page", F.col("page").cast("string")),
        ("url", F.base64(F.col("url").cast("binary"))),
        ("payload-length", F.octet_length("payload").cast("string")),
        ("refers-to-page", F.when(revisit, F.col("first").cast("string"))),
    ]
    metadata = _record(
        [("WARC-Type", F.lit("metadata")),
         ("WARC-Record-ID", _urn(F.md5(F.concat(F.lit("metadata"), "capture").cast("binary")))),
         ("WARC-Concurrent-To", request_id), *common, ("Content-Type", F.lit("application/warc-fields"))],
        F.concat(*(F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit("")) for name, value in fields)),
    )
    end = "\r\n\r\n"
    (
        rows.select(F.concat_ws(end, request, response, metadata).alias("value"))
        .write.option("lineSep", end)
        .option("compression", "gzip")
        .option("maxRecordsPerFile", CAPTURES_PER_FILE)
        .text(path)
    )


def parse_records(stream: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case, the first of equal names) and block of each record.

    Lengths are taken from Content-Length, so a block may hold anything. A record that
    is cut short or doesn't begin as one is an error.
    """
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record where one should begin: {line[:40]!r}")
        headers: dict[str, str] = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            headers.setdefault(name.strip().lower(), value.strip())
        length = int(headers.get("content-length", -1))
        block = stream.read(length) if length >= 0 else b""
        if length < 0 or len(block) < length:
            raise ValueError(f"record {headers.get('warc-record-id')} has no length or is cut short")
        yield headers, block


def _row(headers: dict[str, str], block: bytes) -> tuple:
    kind, head = headers.get("warc-type"), None
    if kind in ("request", "response", "revisit") and headers.get("content-type", "").startswith("application/http"):
        before, _, block = block.partition(b"\r\n\r\n")
        head = before.decode("utf-8", "replace")
    digest = headers.get("warc-payload-digest")
    if kind == "response" and digest and digest.lower().startswith("sha256:"):
        if hashlib.sha256(block).hexdigest() != digest[7:].lower():
            raise ValueError(f"payload of {headers.get('warc-record-id')} doesn't have its digest")
    return (
        kind, headers.get("warc-record-id"), headers.get("warc-concurrent-to"), headers.get("warc-target-uri"),
        headers.get("warc-date"), digest, headers.get("warc-refers-to"), head, None if kind == "revisit" else block,
    )


def _read_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    types = [pa.string()] * 8 + [pa.binary()]
    names = [x.split()[0] for x in RECORDS.split(", ")]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows) if rows else [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names=names)

    for files in batches:
        for content in files.column("content"):
            data = io.BytesIO(content.as_buffer())
            packed = data.read(2) == b"\x1f\x8b"
            data.seek(0)
            rows, held = [], 0
            for record in parse_records(io.BufferedReader(gzip.GzipFile(fileobj=data)) if packed else data):
                rows.append(_row(*record))
                held += len(record[1])
                if held >= BATCH_BYTES:
                    yield batch(rows)
                    rows, held = [], 0
            yield batch(rows)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """All records of the archives below a path, gzipped or not.

    A file is parsed by one task, record by record; it must fit in an executor as it is stored.
    """
    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(_read_files, RECORDS)


def field(metadata: str, name: str) -> Column:
    """The first value of a metadata field, null without one."""
    return F.get(F.filter(metadata, lambda x: x["name"] == name), F.lit(0))["value"]


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: ``capture_id``, ``request``, ``response``, ``metadata``.

    Responses and revisits join the request that their concurrent-to identifier names,
    metadata join the request or response that theirs names. A part that is missing is
    null: requests without response, responses and metadata without partner are captures
    of their own. Other record types are left out. ``metadata`` lists the fields' names and values.
    """
    request = F.struct("record_id", "uri", "date", "http_head").alias("request")
    response = F.struct(
        "type", "record_id", "uri", "date", "payload_digest", "refers_to", "http_head",
        F.octet_length("payload").cast("long").alias("payload_length"), "payload",
    ).alias("response")
    requests = records.where("type = 'request'").select(F.col("record_id").alias("request_id"), request)
    responses = records.where("type IN ('response', 'revisit')").select(
        F.col("concurrent_to").alias("response_to"), F.col("record_id").alias("response_id"), response
    )
    lines = F.filter(F.split(F.col("payload").cast("string"), "\r\n"), lambda x: F.instr(x, ":") > 0)
    named = F.transform(
        lines,
        lambda x: F.struct(
            F.substring_index(x, ":", 1).alias("name"), F.trim(F.substring(x, F.instr(x, ":") + 1, F.length(x))).alias("value")
        ),
    )
    metadata = records.where("type = 'metadata'").select(
        F.col("concurrent_to").alias("metadata_to"), F.col("record_id").alias("metadata_id"),
        named.alias("metadata"),
    )
    pairs = requests.join(responses, F.col("request_id") == F.col("response_to"), "full_outer")
    pairs = pairs.withColumn("capture_id", F.coalesce("request_id", "response_id"))
    return pairs.join(metadata, F.col("capture_id") == F.col("metadata_to"), "full_outer").select(
        F.coalesce("capture_id", "metadata_id").alias("capture_id"), "request", "response", "metadata"
    )
