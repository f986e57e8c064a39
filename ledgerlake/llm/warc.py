"""WARC archives: write captures, read them back, and assemble transactions.

A capture is written as three records: a request, a response (or a revisit, when an
equal payload has a response already) and metadata. Request and metadata name the
capture they belong to by WARC-Concurrent-To; reading back joins them on that
identifier and gives one nested row per capture.

Writing uses Spark's text sink (records hold UTF-8 text, a record ends with the empty
lines that close it), gzip-compressed, into a folder of the shared storage; a file holds
a bounded number of bytes. Reading uses Spark's binary source, and follows
Content-Length, never separators, so any payload survives. Reading works for gzip files
with one member or one member per record, and for plain files.

Defined cases: null html is an empty payload; empty payloads count as equal payloads;
a null url is written as an empty target; a payload is written whole; of records with
equal payloads the smallest page id is the response and the others revisit it (null ids
come last; rows with the same id are records of their own, told apart by a number); an
empty table gives no archive and no rows; other columns are not written.
"""
from __future__ import annotations

import base64
import hashlib
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .common import maybe_broadcast, stored

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
MIN_PAYLOAD = 0  # smaller payloads are always responses
FILE_BYTES = 16 << 20  # of text before compression, a page more at most
DATE = "2024-01-01T00:00:00Z"  # of the capture, as the pages carry none
_CRLF = "\r\n"


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 SHA-1: eight groups of 20 bits, four letters each."""
    hexed = F.sha1(payload)
    letters = []
    for g in range(8):
        bits = F.conv(F.substring(hexed, 5 * g + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            at = F.shiftright(bits, shift).bitwiseAND(F.lit(31)) + 1
            letters.append(F.substring(F.lit(ALPHABET), at, F.lit(1)))
    return F.concat(*letters)


def plan_captures(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                  min_payload: int = MIN_PAYLOAD) -> tuple[DataFrame, int]:
    """page_id, copy, url, payload, its size and digest, record_type and refers_to / refers_copy, by payload;
    and the average record size in bytes.

    Equal payloads are found on digest and size alone; the first of each comes from a
    grouped minimum, so a payload that many pages share is no hot spot. `copy` tells
    rows of equal ids apart (0 for an id's only row).
    """
    body = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.coalesce(F.col(url_col), F.lit("")).alias("url"),
                        body.alias("payload"), F.octet_length(body).cast("bigint").alias("payload_bytes"),
                        base32_sha1(body.cast("binary")).alias("payload_digest"))
    keyed = stored(rows.select("page_id", "url", "payload_digest", "payload_bytes"))
    n, total = keyed.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("payload_bytes") + 1200), F.lit(0))).first()
    repeated = keyed.groupBy(F.col("page_id").alias("p")).count().where("count > 1").select("p")

    def numbered(df: DataFrame) -> DataFrame:
        w = Window.partitionBy("page_id").orderBy("payload_digest", "url")
        again = df.join(repeated, F.col("page_id").eqNullSafe(F.col("p")), "left_semi")
        once = df.join(repeated, F.col("page_id").eqNullSafe(F.col("p")), "left_anti")
        return once.withColumn("copy", F.lit(0)).union(again.withColumn("copy", F.row_number().over(w) - 1))

    if repeated.isEmpty():
        rows, keyed = (df.withColumn("copy", F.lit(0)) for df in (rows, keyed))
    else:
        rows, keyed = numbered(rows), numbered(keyed)
    shared = stored(keyed.where(F.col("payload_bytes") >= min_payload).groupBy(F.col("payload_digest").alias("d"))
                    .agg(F.min(F.struct(F.col("page_id").isNull().alias("unknown"), "page_id", "copy")).alias("first"),
                         F.count(F.lit(1)).alias("n")).where("n > 1").select("d", "first.page_id", "first.copy")
                    .toDF("d", "first", "first_copy"))
    # only payloads that repeat need the lookup: usually few rows
    planned = rows.join(maybe_broadcast(shared, shared.count()), (F.col("payload_digest") == F.col("d"))
                        & (F.col("payload_bytes") >= min_payload), "left")
    own = F.col("first").eqNullSafe(F.col("page_id")) & (F.col("first_copy") == F.col("copy"))
    revisit = F.col("d").isNotNull() & ~own
    return planned.select("page_id", "copy", "url", "payload", "payload_bytes", "payload_digest",
                          F.when(revisit, "revisit").otherwise("response").alias("record_type"),
                          F.when(revisit, F.col("first")).alias("refers_to"),
                          F.when(revisit, F.col("first_copy")).alias("refers_copy")), total // max(1, n)


def _record(kind: str, record_id: Column, headers: list[tuple[str, Column]], block: Column) -> Column:
    """One record without its closing empty lines (the text sink's separator)."""
    lines = [F.lit(f"WARC/1.1{_CRLF}WARC-Type: {kind}{_CRLF}WARC-Date: {DATE}{_CRLF}WARC-Record-ID: <"), record_id,
             F.lit(">" + _CRLF)]
    for name, value in headers:
        lines += [F.lit(name + ": "), value, F.lit(_CRLF)]
    lines += [F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit(_CRLF + _CRLF), block]
    return F.concat(*lines)


def _urn(kind: str, page_id: Column, copy: Column) -> Column:
    """A reproducible record id from the kind, the page id and the number of its row."""
    h = F.md5(F.concat(F.lit(kind + ":"), F.coalesce(page_id.cast("string"), F.lit("null")), F.lit(":"),
                       copy.cast("string")))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("urn:uuid:"), F.concat_ws("-", *parts))


def write_archives(captures: DataFrame, path: str, record_bytes: int) -> None:
    """Three records per row of plan_captures(), under `path`, about FILE_BYTES a file."""
    page, copy, target = F.col("page_id"), F.col("copy"), F.regexp_replace("url", "[\\x00-\\x20\\x7f]", "%20")
    said = F.coalesce(page.cast("string"), F.lit("null"))
    digest = F.concat(F.lit("sha1:"), F.col("payload_digest"))
    capture_id = _urn("capture", page, copy)
    http = F.lit(f"HTTP/1.1 200 OK{_CRLF}Content-Type: text/html; charset=utf-8{_CRLF}")
    length = F.concat(F.lit("Content-Length: "), F.col("payload_bytes").cast("string"), F.lit(_CRLF + _CRLF))
    common = [("WARC-Target-URI", target)]
    http_type = [("Content-Type", F.lit("application/http; msgtype=response")), ("WARC-Payload-Digest", digest)]
    response = _record("response", capture_id, common + http_type, F.concat(http, length, F.col("payload")))
    revisit = _record("revisit", capture_id, common + http_type + [
        ("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        ("WARC-Refers-To", F.concat(F.lit("<"), _urn("capture", F.col("refers_to"), F.col("refers_copy")), F.lit(">")))],
        F.concat(http, length))
    concurrent = [("WARC-Concurrent-To", F.concat(F.lit("<"), capture_id, F.lit(">")))]
    request = _record("request", _urn("request", page, copy), common + concurrent + [
        ("Content-Type", F.lit("application/http; msgtype=request"))],
        F.concat(F.lit("GET "), target, F.lit(f" HTTP/1.1{_CRLF}{_CRLF}")))
    metadata = _record("metadata", _urn("metadata", page, copy), common + concurrent + [
        ("Content-Type", F.lit("application/warc-fields"))],
        F.concat(F.lit("page-id: "), said, F.lit(f"{_CRLF}refers-to-page: "),
                 F.coalesce(F.col("refers_to").cast("string"), F.lit("")),
                 F.lit(f"{_CRLF}payload-bytes: "), F.col("payload_bytes").cast("string"), F.lit(_CRLF)))
    main = F.when(F.col("record_type") == "revisit", revisit).otherwise(response)
    text = F.concat_ws(_CRLF * 2, request, main, metadata)
    (captures.select(text.alias("value")).write.option("lineSep", _CRLF * 2).option("compression", "gzip")
     .option("maxRecordsPerFile", max(1, FILE_BYTES // max(1, record_bytes))).text(path))


_RECORDS = pa.schema([("record_type", pa.string()), ("record_id", pa.string()), ("concurrent_to", pa.string()),
                      ("refers_to", pa.string()), ("target_uri", pa.string()), ("payload_digest", pa.string()),
                      ("payload_bytes", pa.int64()), ("computed_digest", pa.string()), ("block", pa.binary())])
_RECORDS_DDL = ("record_type string, record_id string, concurrent_to string, refers_to string, target_uri string, "
                "payload_digest string, payload_bytes bigint, computed_digest string, block binary")


def _inflated(data: bytes) -> bytes:
    if data[:2] != b"\x1f\x8b":
        return data
    parts = []
    while data:
        z = zlib.decompressobj(31)
        parts.append(z.decompress(data))
        data = z.unused_data
    return b"".join(parts)


def parse_records(data: bytes):
    """(headers with lower-case names, block) of each record of an archive."""
    data, at = memoryview(_inflated(data)), 0
    whole = data.obj
    while True:
        while whole[at:at + 2] == b"\r\n":
            at += 2
        if at >= len(whole):
            return
        end = whole.index(b"\r\n\r\n", at)
        head = whole[at:end].decode().split("\r\n")
        if not head[0].startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        headers = {}
        for line in head[1:]:
            name, _, value = line.partition(":")
            headers[name.strip().lower()] = value.strip()
        start = end + 4
        at = start + int(headers["content-length"])
        yield headers, bytes(data[start:at])


def _bare(v: str | None) -> str | None:
    return v.strip("<>") if v else None


def _parsed(keep_blocks: bool):
    def run(batches):
        for b in batches:
            for data in b.column("content"):
                rows = []
                for h, block in parse_records(data.as_py()):
                    kind, payload = h["warc-type"], None
                    if kind == "response":
                        payload = block[block.index(b"\r\n\r\n") + 4:]
                    digest = h.get("warc-payload-digest", "").removeprefix("sha1:") or None
                    rows.append((kind, _bare(h["warc-record-id"]), _bare(h.get("warc-concurrent-to")),
                                 _bare(h.get("warc-refers-to")), h.get("warc-target-uri"), digest,
                                 None if payload is None else len(payload),
                                 None if payload is None else base64.b32encode(hashlib.sha1(payload).digest()).decode(),
                                 block if keep_blocks or kind == "metadata" else None))
                yield pa.RecordBatch.from_pydict(dict(zip(_RECORDS.names, zip(*rows))) if rows else
                                                 {n: [] for n in _RECORDS.names}, schema=_RECORDS)
    return run


def read_archives(spark: SparkSession, path: str, keep_blocks: bool = True) -> DataFrame:
    """One row per record. `payload_bytes` and `computed_digest` come from a response's payload itself."""
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(_parsed(keep_blocks), _RECORDS_DDL)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: the capture itself, its request and its metadata.

    Records meet by the capture's id: the one they are concurrent to, or their own. A
    capture has few records, whatever the size of the table.
    """
    keyed = records.withColumn("capture_id", F.coalesce("concurrent_to", "record_id"))
    one = F.struct(*[F.col(c) for c in records.columns])

    def of(*kinds: str) -> Column:
        return F.filter("_all", lambda r: r["record_type"].isin(*kinds))
    grouped = keyed.groupBy("capture_id").agg(F.collect_list(one).alias("_all"))
    return grouped.select("capture_id", F.get(of("response", "revisit"), F.lit(0)).alias("capture"),
                          F.get(of("request"), F.lit(0)).alias("request"), of("metadata").alias("metadata"))


def _field(block: Column, name: str) -> Column:
    return F.regexp_extract(block.cast("string"), f"(?:^|\\n){name}: ([^\\r\\n]*)", 1)


def round_trip(pages: DataFrame, id_col: str = "page_id", **how) -> DataFrame:
    """Write the pages as archives, read them back, assemble: page_id, payload_bytes,
    payload_digest, record_type, refers_to (a page id), has_request.

    A revisit's payload is that of the record it refers to: size and digest come from there.
    """
    spark = pages.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/warc-{uuid.uuid4().hex}"
    captures, record_bytes = plan_captures(pages, id_col, **how)
    write_archives(captures, path, record_bytes)
    records = read_archives(spark, path, keep_blocks=False)
    captures = stored(assemble(records).select(
        "capture_id", "capture.record_type", F.col("capture.refers_to").alias("refers_id"),
        F.col("capture.payload_digest").alias("declared"), "capture.payload_bytes",
        F.col("capture.computed_digest").alias("digest"), F.col("request").isNotNull().alias("has_request"),
        _field(F.get("metadata", F.lit(0))["block"], "page-id").alias("page")))
    first = (captures.where("record_type = 'response'")
             .select(F.col("capture_id").alias("r_id"), F.col("page").alias("r_page"),
                     F.col("payload_bytes").alias("r_bytes"), F.col("digest").alias("r_digest")))
    again = (captures.where("record_type = 'revisit'")
             .join(first, F.col("refers_id") == F.col("r_id"), "left")
             .select("page", F.col("r_bytes").alias("payload_bytes"), F.col("r_digest").alias("digest"),
                     "record_type", F.col("r_page").alias("refers"), "has_request"))
    own = captures.where("record_type = 'response'").select(
        "page", "payload_bytes", "digest", "record_type", F.lit(None).cast("string").alias("refers"), "has_request")
    return own.union(again).select(
        F.expr("try_cast(page as bigint)").alias("page_id"), "payload_bytes", F.col("digest").alias("payload_digest"),
        "record_type", F.expr("try_cast(refers as bigint)").alias("refers_to"), "has_request")
