"""Web captures as WARC archives: written from pages, read back, assembled by concurrent-to ids.

Writing: one capture per page, three records next to each other: request, response (or
revisit) and metadata; request and metadata name the response in ``WARC-Concurrent-To``.
Of pages with equal payloads (SHA-1 and length) of at least ``REVISIT_BYTES`` bytes, that
with the largest page_id is stored, the others are revisits of it. Spark's text writer
makes the archives: a row is a capture's records, and the line separator is the blank
lines that end a record. A file is one gzip stream of at most ``CAPTURES_PER_FILE``
captures (so a reader's unit stays small), not one gzip member per record.

Reading: each archive is one row (``binaryFile``) that a task cuts into records by their
``Content-Length``, so payloads may hold anything, record headers too.

Assembly: records join on the id of their response. A capture is one nested row: its
requests, its response or revisit, its metadata records. A request or metadata record
whose response is missing makes a capture without one. Revisits take digest and length
of the full payload from the record they refer to.

Defined cases: null html is the empty payload; a null url is the empty URI; line breaks
in urls are percent-encoded; rows that repeat page_id and payload are one capture; pages
with a null page_id are captures of a null id. Other columns are ignored.
"""

from __future__ import annotations

import gzip
import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm.common import rows_with_ids
from tarmac.session import scratch_path

REVISIT_BYTES = 1000
CAPTURES_PER_FILE = 500
CAPTURED_AT = "2024-01-01T00:00:00Z"
BATCH_BYTES = 8 << 20

# ── fixed values: the archive format ──────────────────────────────────
CRLF = "\r\n"
RECORD_END = CRLF + CRLF
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# ───────────────────────────────────────────────────────────────────────


# ── writing ───────────────────────────────────────────────────────────


def _record_id(kind: str, page_id: Column, digest: Column) -> Column:
    h = F.md5(F.concat_ws("|", F.lit(kind), F.coalesce(page_id.cast("string"), F.lit("null")), digest)
              .cast("binary"))
    return F.concat(F.lit("<urn:uuid:"), F.substr(h, F.lit(1), F.lit(8)), *(
        x for at, n in ((9, 4), (13, 4), (17, 4), (21, 12))
        for x in (F.lit("-"), F.substr(h, F.lit(at), F.lit(n)))), F.lit(">"))


def _record(fields: list[tuple[str, Column | str | None]], block: Column) -> Column:
    """Header lines (those with a null value left out), a blank line, the block."""
    lines = [F.lit(VERSION + CRLF)]
    for name, value in fields:
        value = F.lit(value) if isinstance(value, str) else value
        lines.append(F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)), F.lit("")))
    lines.append(F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit(RECORD_END)))
    return F.concat(*lines, block)


def with_digest(pages: DataFrame) -> DataFrame:
    payload = F.coalesce("html", F.lit(""))
    url = F.replace(F.replace(F.coalesce("url", F.lit("")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return pages.select(F.col("page_id").cast("long").alias("page_id"), url.alias("url"),
                        payload.alias("payload"), F.sha1(payload.cast("binary")).alias("digest"),
                        F.octet_length(payload).cast("long").alias("n_bytes"))


def revisits(pages: DataFrame) -> DataFrame:
    """(digest, n_bytes, stored): for each payload that several pages have, the page that
    keeps it."""
    rows = with_digest(pages).select("page_id", "digest", "n_bytes").where(F.col("n_bytes") >= REVISIT_BYTES)
    return (rows.groupBy("digest", "n_bytes").agg(F.max("page_id").alias("stored"), F.count(F.lit(1)).alias("n"))
            .where("n > 1 and stored is not null").select("digest", "n_bytes", "stored"))


def write_archives(pages: DataFrame, path: str) -> None:
    """Write ``pages(page_id, url, html)`` as WARC archives under ``path``."""
    rows = with_digest(pages)
    shared = revisits(pages)
    rows = rows_with_ids(rows, shared.drop("n_bytes"), "digest", how="left")
    stored = F.when((F.col("n_bytes") >= REVISIT_BYTES) & ~F.col("page_id").eqNullSafe(F.col("stored")),
                    F.col("stored"))
    rows = rows.withColumn("stored", stored)
    target, digest = F.col("url"), F.concat(F.lit("sha1:"), F.col("digest"))
    own = _record_id("capture", F.col("page_id"), F.col("digest"))
    shown = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        F.col("n_bytes").cast("string"), F.lit(RECORD_END))
    again = F.col("stored").isNotNull()
    block = F.when(again, shown).otherwise(F.concat(shown, F.col("payload")))
    response = _record([
        ("WARC-Type", F.when(again, "revisit").otherwise("response")), ("WARC-Record-ID", own),
        ("WARC-Date", CAPTURED_AT), ("WARC-Target-URI", target), ("WARC-Payload-Digest", digest),
        ("WARC-Profile", F.when(again, REVISIT_PROFILE)),
        ("WARC-Refers-To", F.when(again, _record_id("capture", F.col("stored"), F.col("digest")))),
        ("Content-Type", "application/http;msgtype=response")], block)
    asked = F.concat(F.lit("GET "), target, F.lit(f" HTTP/1.1{CRLF}Accept: text/html{RECORD_END}"))
    request = _record([
        ("WARC-Type", "request"), ("WARC-Record-ID", _record_id("request", F.col("page_id"), F.col("digest"))),
        ("WARC-Date", CAPTURED_AT), ("WARC-Target-URI", target), ("WARC-Concurrent-To", own),
        ("Content-Type", "application/http;msgtype=request")], asked)
    told = F.concat(F.coalesce(F.concat(F.lit("page_id: "), F.col("page_id").cast("string"), F.lit(CRLF)), F.lit("")),
                    F.lit("payload_bytes: "), F.col("n_bytes").cast("string"), F.lit(CRLF))
    metadata = _record([
        ("WARC-Type", "metadata"), ("WARC-Record-ID", _record_id("metadata", F.col("page_id"), F.col("digest"))),
        ("WARC-Date", CAPTURED_AT), ("WARC-Target-URI", target), ("WARC-Concurrent-To", own),
        ("Content-Type", "application/warc-fields")], told)
    (rows.select(F.concat_ws(RECORD_END, request, response, metadata).alias("value"))
     .write.option("lineSep", RECORD_END).option("compression", "gzip")
     .option("maxRecordsPerFile", CAPTURES_PER_FILE).mode("overwrite").text(path))


# ── reading ───────────────────────────────────────────────────────────

RECORDS = pa.schema([
    ("record_type", pa.string()), ("record_id", pa.string()), ("concurrent_to", pa.list_(pa.string())),
    ("refers_to", pa.string()), ("target_uri", pa.string()), ("date", pa.string()),
    ("digest", pa.string()), ("n_bytes", pa.int64()), ("payload", pa.binary()),
    ("fields", pa.map_(pa.string(), pa.string()))])
RECORDS_DDL = ("record_type string, record_id string, concurrent_to array<string>, refers_to string, "
               "target_uri string, date string, digest string, n_bytes long, payload binary, "
               "fields map<string,string>")


def _lines(raw: bytes) -> list[tuple[str, str]]:
    out = []
    for line in raw.decode("utf-8", "replace").split(CRLF):
        name, _, value = line.partition(":")
        if name:
            out.append((name.strip(), value.strip()))
    return out


def parse_archive(data: bytes):
    """Rows of ``RECORDS`` of one archive (gzip or plain)."""
    if data[:2] == b"\x1f\x8b":
        data = gzip.decompress(data)
    at = 0
    while at < len(data):
        if data[at: at + 2] == b"\r\n":
            at += 2
            continue
        head_end = data.find(b"\r\n\r\n", at)
        if not data.startswith(b"WARC/", at) or head_end < 0:
            raise ValueError(f"no record header at byte {at}")
        first = data.index(b"\r\n", at) + 2
        head = _lines(data[first:head_end])
        by = {k.lower(): v for k, v in head}
        begin = head_end + 4
        end = begin + int(by["content-length"])
        if end > len(data):
            raise ValueError(f"record at byte {at} is cut short")
        block = data[begin:end]
        at = end
        kind = by["warc-type"]
        payload, fields = block, []
        if by.get("content-type", "").startswith("application/http"):
            cut = block.find(b"\r\n\r\n")
            payload = block[cut + 4:] if cut >= 0 else b""
            if kind == "request":
                fields = [("line", block.split(b"\r\n", 1)[0].decode("utf-8", "replace"))]
        elif by.get("content-type") == "application/warc-fields":
            fields = _lines(block)
        yield (kind, by.get("warc-record-id"), [v for k, v in head if k.lower() == "warc-concurrent-to"],
               by.get("warc-refers-to"), by.get("warc-target-uri"), by.get("warc-date"),
               hashlib.sha1(payload).hexdigest(), len(payload), payload, list(dict(fields).items()))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives under ``path``."""
    def cut(batches):
        for batch in batches:
            for data in batch.column(0):
                rows, size = [], 0
                for row in parse_archive(data.as_py()):
                    rows.append(row)
                    size += row[7] + 500
                    if size >= BATCH_BYTES:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, f.type) for c, f in zip(zip(*rows), RECORDS)], schema=RECORDS)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, f.type) for c, f in zip(zip(*rows), RECORDS)], schema=RECORDS)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return files.select("content").mapInArrow(cut, RECORDS_DDL)


# ── assembly ──────────────────────────────────────────────────────────


def captures(records: DataFrame) -> DataFrame:
    """One nested row per capture: capture_id, ``response`` (its type, target, date, payload with
    digest and length; null if missing), ``requests`` and ``metadata`` (arrays of records)."""
    whole = records.where(F.col("record_type").isin("response", "revisit", "resource"))
    response = whole.dropDuplicates(["record_id"]).select(
        F.col("record_id").alias("capture_id"),
        F.struct("record_type", "target_uri", "date", "refers_to", "digest", "n_bytes", "payload")
        .alias("response"))

    def beside(kind: str, name: str) -> DataFrame:
        rows = records.where(F.col("record_type") == kind).select(
            F.explode_outer("concurrent_to").alias("to"), "record_id", "target_uri", "date", "fields")
        return (rows.select(F.coalesce("to", "record_id").alias("capture_id"),
                            F.struct("record_id", "target_uri", "date",
                                     F.map_entries("fields").alias("fields")).alias("r"))
                .groupBy("capture_id").agg(F.array_sort(F.collect_set("r")).alias(name)))

    out = (response.join(beside("request", "requests"), "capture_id", "full_outer")
           .join(beside("metadata", "metadata"), "capture_id", "full_outer"))
    return out


def capture_report(spark: SparkSession, pages: DataFrame, path: str | None = None) -> DataFrame:
    """Write the pages' archives, read them back and tell of every capture: page_id,
    payload_bytes, payload_digest (of the full payload), record_type, refers_to (page_id)."""
    path = path or scratch_path(spark, "warc")
    write_archives(pages, path)
    page = F.element_at(F.map_from_entries(F.col("metadata")[0]["fields"]), "page_id").cast("long")
    rows = captures(read_records(spark, path)).select(
        "capture_id", page.alias("page_id"), F.col("response.record_type").alias("record_type"),
        F.col("response.refers_to").alias("refers"), F.col("response.digest").alias("digest"),
        F.col("response.n_bytes").alias("n_bytes"))
    kept = rows.where("record_type = 'response'").select(
        F.col("capture_id").alias("refers"), F.col("page_id").alias("stored"),
        F.col("digest").alias("full_digest"), F.col("n_bytes").alias("full_bytes"))
    seen = rows.where("record_type = 'revisit'").join(kept, "refers", "left").select(
        "page_id", F.col("full_bytes").alias("payload_bytes"), F.col("full_digest").alias("payload_digest"),
        "record_type", F.col("stored").alias("refers_to"))
    first = rows.where("record_type <> 'revisit'").select(
        "page_id", F.col("n_bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"),
        "record_type", F.lit(None).cast("long").alias("refers_to"))
    return first.unionByName(seen)
