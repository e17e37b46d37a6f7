"""WARC archives with revisit records instead of repeated payloads.

Only headers are shuffled by payload digest: of equal payloads the page with the smallest id keeps
its response, the others become revisits of it. Archives are written by Spark's text writer, whose
line separator is the end of a WARC record; any file system that Spark knows will do. Reading takes
whole files, follows the length of each block, and joins revisit records to the responses that they
refer to, which gives them back what their payload was.

A payload that makes up a large share of the rows is no hot key: originals come from partial
minima, and both joins are between written tables, whose skewed side Spark splits.

Defined cases: a null payload is an empty one. Repeated rows of the smallest id are responses, each.
Pages without an id revisit the page that has their payload, and are responses where none with an id
has it. Line breaks in a URL are written percent-encoded, a null URL as an empty field. Very long payloads
are records of archives of their own. An empty table gives no records. Other columns, whatever their
names, are not looked at.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmark.llm.store import Store

CRLF = "\r\n"
RECORD_END = CRLF + CRLF
# Fixed values of the format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DIGITS_32, LETTERS_32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
RECORDS = (
    "page_id long, record_type string, record_id string, refers_to_id string,"
    " payload_digest string, payload_bytes long, target_uri string"
)


def payload_digest(payload: Column) -> Column:
    """SHA-1 in base 32. Five hexadecimal digits make four of base 32."""
    code = F.sha1(payload.cast("binary"))
    parts = [
        F.lpad(F.conv(F.substring(code, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)
    ]
    return F.translate(F.concat(*parts), DIGITS_32, LETTERS_32)


def record_id(page_id: Column) -> Column:
    """A UUID of version 3's form, the same on every run."""
    code = F.md5(F.concat(F.lit("page:"), F.coalesce(page_id.cast("string"), F.lit(""))))
    parts = [F.substring(code, a, n) for a, n in ((1, 8), (9, 4), (14, 3), (18, 3), (21, 12))]
    parts[2], parts[3] = F.concat(F.lit("3"), parts[2]), F.concat(F.lit("8"), parts[3])
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _field(name: str, value: Column | str) -> Column:
    return F.concat(F.lit(f"{name}: "), F.lit(value) if isinstance(value, str) else value,
                    F.lit(CRLF))


def _uri(url: Column) -> Column:
    return F.replace(
        F.replace(F.coalesce(url, F.lit("")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A")
    )


def revisits(pages: DataFrame, store: Store, page_id: str = "page_id", url: str = "url",
             payload: str = "html", least_bytes: int = 0) -> DataFrame:
    """page_id, digest, refers_to, refers_to_url of the rows whose payload an earlier page has."""
    body = F.coalesce(F.col(payload), F.lit(""))
    headers = store.hold(
        pages.select(
            F.col(page_id).alias("page_id"), F.col(url).alias("url"),
            payload_digest(body).alias("digest"), F.octet_length(body).alias("bytes"),
        ).filter(F.col("bytes") >= least_bytes),
        "headers",
    )
    originals = store.hold(
        headers.groupBy("digest", "bytes").agg(
            F.min("page_id").alias("refers_to"), F.max("page_id").alias("last"),
            F.count_if(F.col("page_id").isNull()).alias("unnamed"),
            F.min_by("url", "page_id").alias("refers_to_url"),
        ).filter("last > refers_to or unnamed > 0 and refers_to is not null").drop("last", "unnamed"),
        "originals",
    )
    return store.hold(
        headers.drop("url").join(originals, ["digest", "bytes"])
        .filter("page_id > refers_to or page_id is null")
        .select("page_id", "digest", "refers_to", "refers_to_url")
        .distinct(),
        "revisits",
    )


FILE_BYTES = 64 << 20  # of an archive, about; one record may be larger


def _file_sizes(most_records: int) -> list[tuple[int, int | None]]:
    """(records per file, most bytes of a record in it) of archives for small and larger records."""
    counts = sorted({max(1, most_records // n) for n in (1, 8, 64)} | {1}, reverse=True)
    return [(n, FILE_BYTES // n if n > 1 else None) for n in counts]


def write_archives(pages: DataFrame, path: str, store: Store, page_id: str = "page_id",
                   url: str = "url", payload: str = "html", least_bytes: int = 0,
                   date: str | None = None, records_per_file: int = 1000) -> None:
    """One record per page. Payloads move only if the revisits are too many for Spark to broadcast
    by their measured size. Archives hold `records_per_file` records at most and about `FILE_BYTES`:
    larger records go to archives of fewer, in a pass of their own, if there are any. `date` is the
    records' WARC-Date, the time of this run if none is given."""
    date = date or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    marks = revisits(pages, store, page_id, url, payload, least_bytes)
    body = F.coalesce(F.col("body"), F.lit(""))
    # A repeated id may have several payloads, so the digest is part of the key.
    rows = pages.select(
        F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(payload).alias("body"),
        payload_digest(F.coalesce(F.col(payload), F.lit(""))).alias("digest"),
    )
    marks = marks.select(
        F.col("page_id").alias("_page"), F.col("digest").alias("_digest"), "refers_to", "refers_to_url"
    )
    same = F.col("page_id").eqNullSafe(F.col("_page")) & (F.col("digest") == F.col("_digest"))
    rows = rows.join(marks, same, "left")
    again = F.col("refers_to").isNotNull()
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        F.octet_length(body), F.lit(CRLF + CRLF),
    )
    block = F.when(again, http).otherwise(F.concat(http, body))
    record = F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        _field("WARC-Type", F.when(again, "revisit").otherwise("response")),
        _field("WARC-Record-ID", record_id(F.col("page_id"))),
        _field("WARC-Target-URI", _uri(F.col("url"))),
        _field("WARC-Date", date),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        _field("X-Page-ID", F.coalesce(F.col("page_id").cast("string"), F.lit(""))),
        F.when(again, F.concat(
            _field("WARC-Profile", PROFILE),
            _field("WARC-Refers-To", record_id(F.col("refers_to"))),
            _field("WARC-Refers-To-Target-URI", _uri(F.col("refers_to_url"))),
            _field("WARC-Refers-To-Date", date),
        )).otherwise(""),
        _field("Content-Type", "application/http; msgtype=response"),
        _field("Content-Length", F.octet_length(block)),
        F.lit(CRLF), block,
    )
    size = F.octet_length(body) + F.octet_length(F.coalesce(F.col("url"), F.lit("")))
    sizes = _file_sizes(records_per_file)
    largest = pages.select(F.col(url).alias("url"), F.col(payload).alias("body")).agg(
        F.max(size)
    ).first()[0] or 0
    least = -1  # bytes of the records written so far
    for count, most in sizes:
        if least >= largest and least >= 0:
            break
        part = rows if least < 0 else rows.filter(size > least)
        if most is not None and most < largest:
            part = part.filter(size <= most)
        (
            part.select(record.alias("value"))
            .write.mode("overwrite" if least < 0 else "append")
            .option("lineSep", RECORD_END)
            .option("maxRecordsPerFile", count)
            .text(path)
        )
        least = largest if most is None else most


# ---- reading ---------------------------------------------------------------------------------

_HEADER = re.compile(rb"([^:\r\n]+):[ \t]*([^\r\n]*)\r\n")


def records(content: bytes) -> Iterator[tuple[dict[str, str], memoryview]]:
    """Fields (names in lower case) and block of each record of an archive."""
    view, at = memoryview(content), 0
    while at < len(content):
        end = content.index(b"\r\n\r\n", at) + 4
        fields = {
            name.decode().lower(): value.decode("utf-8", "replace")
            for name, value in _HEADER.findall(content, content.index(b"\r\n", at) + 2, end)
        }
        stop = end + int(fields["content-length"])
        yield fields, view[end:stop]
        if content[stop:stop + 4] != b"\r\n\r\n":
            raise ValueError("a record does not end where its length says")
        at = stop + 4


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [part.split()[0] for part in RECORDS.split(",")]
    kinds = [pa.int64() if part.split()[1] == "long" else pa.string()
             for part in RECORDS.split(",")]
    for batch in batches:
        for content in batch["content"]:
            rows = []
            for fields, block in records(content.as_buffer().to_pybytes()):
                kind = fields["warc-type"]
                digest, size = fields["warc-payload-digest"].removeprefix("sha1:"), None
                if kind == "response":
                    block = bytes(block)
                    payload = memoryview(block)[block.index(b"\r\n\r\n") + 4:]
                    size = len(payload)
                    found = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                    if found != digest:
                        raise ValueError(f"damaged payload of {fields['warc-record-id']}")
                page = fields.get("x-page-id")
                rows.append((int(page) if page else None, kind, fields["warc-record-id"],
                             fields.get("warc-refers-to"), digest, size,
                             fields["warc-target-uri"]))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names
                )


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The records, with the payload's size where it is stored. A file is read by one task."""
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(_parsed, RECORDS)


def resolve(found: DataFrame) -> DataFrame:
    """Every record with its payload's size; a revisit with the page that it refers to."""
    responses = found.filter("record_type = 'response'")
    originals = responses.filter("page_id is not null").select(
        F.col("record_id").alias("refers_to_id"), "payload_digest",
        F.col("page_id").alias("refers_to"), F.col("payload_bytes").alias("original_bytes"),
    ).distinct()
    again = found.filter("record_type <> 'response'").join(
        originals, ["refers_to_id", "payload_digest"], "left"
    )
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return responses.withColumn("refers_to", F.lit(None).cast("long")).select(columns).unionByName(
        again.withColumn("payload_bytes", F.col("original_bytes")).select(columns)
    )


def archive_pages(pages: DataFrame) -> DataFrame:
    """Writes the pages as deduplicated archives, reads them back and resolves the revisits."""
    store = Store(pages.sparkSession, "warc")
    write_archives(pages, store.path("archives"), store)
    store.drop("headers", "originals", "revisits")
    found = read_archives(pages.sparkSession, store.path("archives"))
    return resolve(store.hold(found, "records"))
