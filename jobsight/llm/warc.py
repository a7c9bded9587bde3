"""WARC archives: written from crawled pages, read back, and assembled into one nested row per capture.

``write_archives`` turns every page into three records: a *response* (or a
*revisit*, where an equal payload of at least ``MIN_REVISIT`` bytes is already
the response of the page with the smallest id), the *request*, and *metadata*,
the latter two naming the first in ``WARC-Concurrent-To``. A record is text
with CRLF line ends and a payload of exactly ``Content-Length`` bytes; Spark's
text writer writes the files, gzip-compressed, through whatever file system
the folder is on. A file holds ``FILE_RECORDS`` records at most, and no more
than one scan split or shuffle partition of pages, so a reader can hold it.

``read_archives`` parses archives record by record by ``Content-Length`` (a
payload may hold anything, record headers included). ``assemble`` joins
request and metadata to their response or revisit through the concurrent-to
identifiers, and a revisit to the response it refers to.

Equal payloads are found by digest alone: per digest only the count and the
smallest id travel (map-side combined), and only (page, target) pairs of
revisits come back, so a payload that a third of all pages share costs a third
of the pages' ids, never their bytes, in one place.

A null payload is empty. Null page ids are allowed (no ``refers_to`` ever
points at one); rows repeated with one id are captures of their own. An empty
table gives an empty archive and no rows. Extra columns are ignored.
"""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsight.llm.common import mapped, read, saved, scratch_path

MIN_REVISIT = 100
FILE_RECORDS = 30_000
#: Version line and the profile name that public WARC 1.1 gives to identical payloads.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: The corpus has no crawl times; every record carries this one.
DATE = "2024-01-01T00:00:00Z"
RECORD = (
    "record_id string, type string, concurrent_to string, refers_to string, target_uri string, page_id long, "
    "payload_bytes long, payload_digest string, body_bytes long, body_digest string, body binary"
)


def _uuid(*parts) -> F.Column:
    """A urn:uuid made from the digest of its parts."""
    h = F.md5(F.concat_ws("|", *parts))
    return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(h, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"), F.lit(">"))


def _record(headers: list[tuple[str, F.Column]], body: F.Column) -> F.Column:
    """One record; the writer's line separator adds the last LF. Headers with a null value are left out."""
    eol = "\r\n"
    lines = [F.coalesce(F.concat(F.lit(f"{eol}{k}: "), v), F.lit("")) for k, v in headers]
    length = F.octet_length(body).cast("string")
    return F.concat(F.lit(VERSION), *lines, F.lit(f"{eol}Content-Length: "), length, F.lit(eol * 2), body, F.lit(eol + "\r"))


def write_archives(pages: DataFrame, path: str) -> None:
    """``pages`` (``page_id, url, html``) as gzip WARC files under ``path``."""
    own = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]+", " ").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    )
    own = own.withColumn("digest", F.sha2("html", 256)).withColumn("bytes", F.octet_length("html").cast("long"))
    ids = own.where(F.col("bytes") >= MIN_REVISIT).select("page_id", "digest")
    firsts = ids.groupBy("digest").agg(F.min("page_id").alias("target"), F.count("*").alias("n")).where("n > 1").drop("n")
    targets = (
        ids.join(firsts, "digest").where("page_id > target")
        .groupBy(F.col("page_id").alias("of_page"), F.col("digest").alias("of_digest")).agg(F.min("target").alias("target"))
    )
    same = (F.col("page_id") == F.col("of_page")) & (F.col("digest") == F.col("of_digest"))
    joined = own.join(targets, same, "left")
    # Rows repeated with one id differ in their place in the file, which is fixed once the file is written.
    rec = joined.withColumn("seq", F.monotonically_increasing_id().cast("string"))
    page = F.coalesce(F.col("page_id").cast("string"), F.lit("null"))
    first = F.col("target").isNull()
    main = _uuid(F.lit("capture"), page, "seq")
    # A response is named by its digest and page, so that a revisit can name it without another join.
    main = F.when(first, F.when(F.col("page_id").isNull() | (F.col("bytes") < MIN_REVISIT), main).otherwise(_uuid(F.lit("payload"), page, "digest"))).otherwise(main)
    refers = F.when(~first, _uuid(F.lit("payload"), F.col("target").cast("string"), "digest"))
    common = [("WARC-Date", F.lit(DATE)), ("WARC-Target-URI", F.col("url")), ("X-Page-Id", F.col("page_id").cast("string"))]
    http = F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n")
    main_record = _record(
        [
            ("WARC-Type", F.when(first, F.lit("response")).otherwise(F.lit("revisit"))), ("WARC-Record-ID", main), *common,
            ("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))), ("X-Payload-Length", F.col("bytes").cast("string")),
            ("WARC-Profile", F.when(~first, F.lit(PROFILE))), ("WARC-Refers-To", refers),
            ("Content-Type", F.lit("application/http; msgtype=response")),
        ],
        F.when(first, F.concat(http, F.col("html"))).otherwise(http),
    )
    request = _record(
        [
            ("WARC-Type", F.lit("request")), ("WARC-Record-ID", _uuid(F.lit("request"), page, "seq")), *common,
            ("WARC-Concurrent-To", main), ("Content-Type", F.lit("application/http; msgtype=request")),
        ],
        F.concat(F.lit("GET "), F.col("url"), F.lit(" HTTP/1.1\r\n\r\n")),
    )
    metadata = _record(
        [
            ("WARC-Type", F.lit("metadata")), ("WARC-Record-ID", _uuid(F.lit("metadata"), page, "seq")), *common,
            ("WARC-Concurrent-To", main), ("Content-Type", F.lit("application/warc-fields")),
        ],
        F.concat(F.lit("via: "), F.col("url"), F.lit("\r\n")),
    )
    rec.select(F.explode(F.array(main_record, request, metadata)).alias("value")).write.option("lineSep", "\n").option(
        "compression", "gzip"
    ).option("maxRecordsPerFile", FILE_RECORDS).text(path)


def _records(data: bytes):
    """(headers in lower case, body) of each record of one archive."""
    if data[:2] == b"\x1f\x8b":
        parts, rest = [], data
        while rest:  # one gzip member for the file, or one for each record
            z = zlib.decompressobj(31)
            parts.append(z.decompress(rest) + z.flush())
            rest = z.unused_data
        data = b"".join(parts)
    at, n = 0, len(data)
    while at < n:
        if data.startswith((b"\r", b"\n"), at):
            at += 1
            continue
        end = data.index(b"\r\n\r\n", at)
        version, *lines = data[at:end].split(b"\r\n")
        if not version.startswith(b"WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        head = {}
        for line in lines:
            k, _, v = line.partition(b":")
            head[k.strip().lower().decode()] = v.strip().decode("utf-8", "replace")
        size = int(head["content-length"])
        if end + 4 + size > n:
            raise ValueError(f"the record at byte {at} is cut short")
        yield head, data[end + 4 : end + 4 + size]
        at = end + 4 + size


def _payload(head: dict, body: bytes) -> bytes:
    if head.get("content-type", "").startswith("application/http"):
        return body[body.index(b"\r\n\r\n") + 4 :]
    return body


def _parse(batches, with_body: bool):
    import hashlib

    names = [c.split()[0] for c in RECORD.split(", ")]
    for b in batches:
        for data in b.column("content"):
            out = {k: [] for k in names}
            held = 0
            for head, body in _records(data.as_py()):
                payload = _payload(head, body)
                kind = head["warc-type"]
                row = {
                    "record_id": head["warc-record-id"], "type": kind, "concurrent_to": head.get("warc-concurrent-to"),
                    "refers_to": head.get("warc-refers-to"), "target_uri": head.get("warc-target-uri"),
                    "page_id": int(head["x-page-id"]) if head.get("x-page-id") else None,
                    "payload_bytes": int(head["x-payload-length"]) if "x-payload-length" in head else None,
                    "payload_digest": head.get("warc-payload-digest", "").partition(":")[2] or None,
                    "body_bytes": len(payload), "body_digest": hashlib.sha256(payload).hexdigest(),
                    "body": payload if with_body else None,
                }
                for k in names:
                    out[k].append(row[k])
                held += len(payload) if with_body else 200
                if held > 8 << 20:
                    yield out
                    out, held = {k: [] for k in names}, 0
            yield out


def read_archives(spark: SparkSession, path: str, with_body: bool = True) -> DataFrame:
    """One row per record of the archives under ``path`` (plain or gzip); ``with_body`` also returns payloads."""
    files = spark.read.format("binaryFile").load(path).select("content")
    return mapped(files, lambda it: _parse(it, with_body), RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: ``capture`` (response or revisit), ``request``, ``metadata``, ``original``.

    ``original`` is the response a revisit refers to; request, metadata or
    original missing from the archives are null.
    """
    def part(kind: str) -> DataFrame:
        rows = records.where(F.col("type") == kind)
        return rows.groupBy(F.col("concurrent_to").alias(f"{kind}_of")).agg(
            F.min(F.struct("record_id", "target_uri", "body_bytes", "body")).alias(kind)
        )

    captures = records.where(F.col("type").isin("response", "revisit")).select(
        "record_id", F.struct(*records.columns).alias("capture")
    )
    originals = records.where(F.col("type") == "response").groupBy(F.col("record_id").alias("original_id")).agg(
        F.min(F.struct("page_id", "target_uri", "body_bytes", "body_digest", "body")).alias("original")
    )
    request, metadata = part("request"), part("metadata")
    return (
        captures.join(request, F.col("record_id") == F.col("request_of"), "left")
        .join(metadata, F.col("record_id") == F.col("metadata_of"), "left")
        .join(originals, F.col("capture.refers_to") == F.col("original_id"), "left")
        .select("capture", "request", "metadata", "original")
    )


def op2_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's columns, and of the capture's nested parts: ``request_uri, metadata_bytes`` and how many there are."""
    path = scratch_path(spark, "warc")
    write_archives(read(spark, sf_dir, "pages"), path)
    c = assemble(saved(read_archives(spark, path, with_body=False), "warc-records"))  # four joins read it
    again = F.col("capture.type") == "revisit"
    parts = [F.col(p).isNotNull().cast("int") for p in ("request", "metadata", "original")]
    return c.select(
        F.col("capture.page_id").alias("page_id"),
        F.when(again, F.col("original.body_bytes")).otherwise(F.col("capture.body_bytes")).alias("payload_bytes"),
        F.when(again, F.col("original.body_digest")).otherwise(F.col("capture.body_digest")).alias("payload_digest"),
        F.col("capture.type").alias("record_type"),
        F.when(again, F.col("original.page_id")).alias("refers_to"),
        F.col("request.target_uri").alias("request_uri"), F.col("metadata.body_bytes").alias("metadata_bytes"),
        sum(parts, F.lit(1)).alias("n_records"),
    )


OP2_SQL = """
WITH p AS (
    SELECT page_id, regexp_replace(coalesce(url, ''), '[\r\n]+', ' ', 'g') AS uri, encode(coalesce(html, '')) AS payload FROM pages
), d AS (
    SELECT page_id, uri, octet_length(payload) AS payload_bytes, sha256(payload) AS payload_digest FROM p
), f AS (
    SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_page FROM d
), k AS (
    SELECT *, payload_bytes >= 100 AND page_id > first_page AS again FROM f
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN again THEN first_page END AS refers_to,
       trim(uri) AS request_uri, CAST(octet_length(encode('via: ' || uri)) + 2 AS BIGINT) AS metadata_bytes,
       CASE WHEN again THEN 4 ELSE 3 END AS n_records
FROM k
"""
