"""WARC archives with revisit records: written, read back and resolved."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.llm.base import map_batches
from riskloom.plans.materialize import new_path

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
GAP = "\r\n\r\n"
HEX32, BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def sha1_base32(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1 of a binary column."""
    digits = F.sha1(payload)
    part = [F.lpad(F.conv(F.substring(digits, 1 + 10 * k, 10), 16, 32), 8, "0") for k in range(4)]
    return F.translate(F.concat(*part), HEX32, BASE32)


def record_id(number: Column, digest: Column, copy: Column) -> Column:
    """A UUID URN made from what tells a record from others, so that a repeated task writes the same archive."""
    h = F.md5(F.concat_ws("|", F.lit("record"), number, digest, copy.cast("string")))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def deduplicate(pages: DataFrame, id: str = "page_id", url: str = "url", payload: str = "payload") -> DataFrame:
    """Each record with its digest and the number of the response that it revisits.

    Headers (number, digest) alone are shuffled by digest; a digest that a third of all records share is one partial row per
    task. The records then meet their decision by number. Of equal payloads the smallest number is the response and the others
    revisit it. Null numbers come last; of rows that repeat a number and a payload the first by url is the response.
    Columns: id, url, payload, payload_bytes, payload_digest, copy (0, 1, ... of such repeated rows), revisit, refers_to.
    """
    body = F.coalesce(F.col(payload), F.lit("").cast("binary"))
    rows = pages.select(F.col(id).alias("id"), F.col(url).alias("url"), body.alias("payload"))
    rows = rows.withColumn("payload_digest", sha1_base32(F.col("payload")))
    key = F.coalesce(F.col("id").cast("string"), F.lit(""))  # joins and windows on it agree on one partitioning
    heads = rows.select(key.alias("_key"), "payload_digest", "id")
    origin = heads.groupBy("payload_digest").agg(F.min("id").alias("origin"))
    decided = heads.select("_key", "payload_digest").distinct().join(origin, "payload_digest")
    met = rows.withColumn("_key", key).join(decided, ["_key", "payload_digest"])
    copy = F.row_number().over(Window.partitionBy("_key", "payload_digest").orderBy("url")) - 1
    met = met.withColumn("copy", copy).withColumn("revisit", (F.col("copy") > 0) | ~F.col("id").eqNullSafe(F.col("origin")))
    return met.select(
        "id", "url", "payload", F.length("payload").cast("long").alias("payload_bytes"), "payload_digest", "copy", "revisit",
        F.when(F.col("revisit"), F.col("origin")).alias("refers_to"),
    )


def records(rows: DataFrame, date: str) -> DataFrame:
    """One WARC 1.1 record per row of `deduplicate`, as a column `value` whose bytes are headers, blank line and block."""
    number = F.coalesce(F.col("id").cast("string"), F.lit(""))
    # raw bytes pass through a string column unchanged; nothing on the way looks at characters
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("payload_bytes").cast("string"), F.lit(GAP))
    target = F.regexp_replace(F.coalesce(F.col("url"), F.lit("")), r"[\x00-\x20]", "")
    own = record_id(number, F.col("payload_digest"), F.col("copy"))
    first = record_id(F.coalesce(F.col("refers_to").cast("string"), F.lit("")), F.col("payload_digest"), F.lit(0))
    revisit = F.col("revisit")
    block_bytes = F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("payload_bytes"))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: "), own, F.lit(f"\r\nWARC-Date: {date}\r\nWARC-Target-URI: "), target,
        F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("payload_digest"),
        F.when(revisit, F.concat(F.lit("\r\nWARC-Refers-To: "), first, F.lit(f"\r\nWARC-Profile: {PROFILE}"))).otherwise(""),
        F.lit("\r\nContent-Type: application/http;msgtype=response\r\nWARC-Source-Number: "), number,
        F.lit("\r\nContent-Length: "), block_bytes.cast("string"), F.lit(GAP),
    )
    return rows.select(F.concat(head, http, F.when(revisit, "").otherwise(F.col("payload").cast("string"))).alias("value"))


def write_archives(rows: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z", per_file: int = 20_000) -> None:
    """Write the records of `deduplicate` as gzipped archives of at most `per_file` records under `path`.

    Spark's text writer ends every record with the blank lines that WARC asks for, and commits whole files only, so a task that
    is run again leaves no half archive.
    """
    records(rows, date).write.option("lineSep", GAP).option("compression", "gzip").option("maxRecordsPerFile", per_file).text(path)


def read_archives(spark: SparkSession, path: str, pattern: str = "*.gz") -> DataFrame:
    """Records of all archives under `path`: record_id, type, target, number, digest, refers_to, payload.

    Bounds come from Content-Length alone, so a payload may hold anything. The payload is what follows the HTTP header; its
    digest is computed afresh for responses and a mismatch is an error. Files are read whole, one a task.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path).select("content")
    schema = "record_id string, type string, target string, number long, digest string, refers_to string, payload binary"
    return map_batches(files, _parse, schema)


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["record_id", "type", "target", "number", "digest", "refers_to", "payload"]
    types = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.binary()]

    def out(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types, strict=True)], names=names)

    for batch in batches:
        for content in batch.column("content"):
            stream = gzip.GzipFile(fileobj=io.BytesIO(content.as_buffer()))
            rows, held = [], 0
            while True:
                line = stream.readline()
                if not line:
                    break
                if not line.strip():
                    continue
                if not line.startswith(b"WARC/1."):
                    raise ValueError(f"no WARC record begins with {line[:40]!r}")
                head: dict[str, str] = {}
                while (line := stream.readline().rstrip(b"\r\n")):
                    name, _, value = line.decode("utf-8", "replace").partition(":")
                    head[name.lower()] = value.strip()
                block = stream.read(int(head["content-length"]))
                payload = block.partition(b"\r\n\r\n")[2]
                digest = head["warc-payload-digest"].removeprefix("sha1:")
                if head["warc-type"] == "response" and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                    raise ValueError(f"payload of {head['warc-record-id']} does not match its digest")
                number = head.get("warc-source-number")
                rows.append((head["warc-record-id"], head["warc-type"], head["warc-target-uri"], int(number) if number else None, digest, head.get("warc-refers-to"), payload))
                held += len(payload)
                if held > 4 << 20 or len(rows) == 4096:
                    yield out(rows)
                    rows, held = [], 0
            if rows:
                yield out(rows)


def resolve(archived: DataFrame) -> DataFrame:
    """Every record with its full payload's size: revisits are joined to the response that they refer to.

    Columns: number, record_type, payload_digest, payload_bytes, refers_to (number of the response, null for responses).
    """
    full = archived.where("type = 'response'").select(
        F.col("record_id").alias("_first"), F.octet_length("payload").cast("long").alias("_bytes"), F.col("number").alias("_number")
    )
    heads = archived.select("number", "type", "digest", "refers_to", F.octet_length("payload").cast("long").alias("bytes"))
    direct = heads.where("type = 'response'").select(
        "number", F.col("type").alias("record_type"), F.col("digest").alias("payload_digest"), F.col("bytes").alias("payload_bytes"),
        F.lit(None).cast("long").alias("refers_to"),
    )
    again = heads.where("type = 'revisit'").join(full, F.col("refers_to") == F.col("_first")).select(
        "number", F.col("type").alias("record_type"), F.col("digest").alias("payload_digest"), F.col("_bytes").alias("payload_bytes"),
        F.col("_number").alias("refers_to"),
    )
    return direct.unionAll(again)


def archive_and_resolve(pages: DataFrame, id: str = "page_id", url: str = "url", payload: str = "payload", path: str | None = None, **options) -> DataFrame:
    """Deduplicate, write archives, read them back and resolve the revisits.

    Archives go to `path`, a new folder in the shared folder by default. An empty table gives no archive and no row.
    """
    spark = pages.sparkSession
    path = path or new_path(spark, "warc")
    write_archives(deduplicate(pages, id, url, payload), path, **options)
    return resolve(read_archives(spark, path))
