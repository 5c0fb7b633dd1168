"""WARC archives: write page captures, read archives back, assemble transactions.

Every page becomes three WARC/1.1 records: a request, a response (or a revisit of an
equal payload) and a metadata record; request and metadata name the response's record
in WARC-Concurrent-To. Archives are gzip files of a bounded number of records in the
shared folder, written by Spark's text writer. Reading splits them at the version line
and puts a record whose payload holds such a line together again by Content-Length,
which is safe as a gzip file is read by one task in order.

Assembly joins requests and metadata to responses through the concurrent-to
identifiers, resolves revisits to the record they refer to, and gives one nested row
per capture. Only headers, lengths and digests are shuffled unless payloads are asked
for. Which payloads are equal is found on digests before writing: the least page_id of
a group is the response, so the html of a group held by many pages never meets in one
task.

Defined cases: a null html is an empty payload; a null url has no target header, line
breaks in one are escaped; a row repeated in full is one capture; rows that share a
page_id with other content are captures of their own; a null page_id sorts last; an
empty table gives no captures; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from branchbook.llm.common import scratch, stored

VERSION = "WARC/1.1\r\n"
MIN_REVISIT = 100
RECORDS_PER_FILE = 30_000
DATE = "2024-01-01T00:00:00Z"
RECORD_SCHEMA = ("record_id string, type string, concurrent_to string, refers_to string, target_uri string, declared_digest string, "
                 "payload_bytes bigint, payload_digest string, fields string, payload binary")
_RECORD = pa.schema([(c.split()[0], {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}[c.split()[1]]) for c in RECORD_SCHEMA.split(", ")])


def _uuid(capture: Column, role: str) -> Column:
    h = F.md5(F.concat(capture, F.lit(role)))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]), F.lit(">"))


def captures(pages: DataFrame) -> DataFrame:
    """page_id, url, html, capture id, payload digest and size, and the capture a revisit refers to."""
    src = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    key = F.md5(F.concat_ws("|", *[F.coalesce(F.concat(F.length(c), F.lit(":"), c), F.lit("-")) for c in (F.col("page_id").cast("string"), F.col("url"))], F.col("digest")))
    src = src.withColumn("digest", F.sha2("html", 256)).withColumns({"capture": key, "size": F.octet_length("html").cast("bigint")})
    small = src.select("page_id", "capture", "digest", "size").where(F.col("size") >= MIN_REVISIT)
    first = small.groupBy("digest").agg(F.min(F.struct(F.col("page_id").isNull().alias("no_id"), "page_id", "capture")).alias("first"))
    revisits = small.join(first, "digest").where("capture != first.capture").select("capture", F.col("first.capture").alias("refers")).distinct()
    return src.join(revisits.withColumnRenamed("capture", "__c"), F.col("capture") == F.col("__c"), "left").drop("__c")


def records(caps: DataFrame) -> DataFrame:
    """One column ``value``: the WARC records, without the last line break, three per capture and next to each other."""
    nl = "\r\n"
    url = F.regexp_replace(F.col("url"), r"[\x00-\x20\x7f]", "%20")
    target = F.coalesce(F.concat(F.lit("WARC-Target-URI: "), url, F.lit(nl)), F.lit(""))
    response = _uuid(F.col("capture"), "response")

    def record(kind: Column, rid: Column, extra: list[Column], content: str, block: Column) -> Column:
        head = [F.lit(VERSION + "WARC-Type: "), kind, F.lit(nl + "WARC-Record-ID: "), rid, F.lit(nl + f"WARC-Date: {DATE}" + nl), target, *extra]
        return F.concat(*head, F.lit(f"Content-Type: {content}{nl}Content-Length: "), F.octet_length(block).cast("string"), F.lit(nl + nl), block, F.lit(nl))

    beside = F.concat(F.lit("WARC-Concurrent-To: "), response, F.lit(nl))
    again = F.col("refers").isNotNull()
    digest = F.concat(F.lit("WARC-Payload-Digest: sha256:"), F.col("digest"), F.lit(nl))
    refers = F.when(again, F.concat(F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest" + nl + "WARC-Refers-To: "),
                                    _uuid(F.col("refers"), "response"), F.lit(nl))).otherwise(F.lit(""))
    http = F.lit("HTTP/1.1 200 OK" + nl + "Content-Type: text/html; charset=utf-8" + nl + nl)
    ask = F.concat(F.lit("GET "), F.coalesce(url, F.lit("/")), F.lit(" HTTP/1.1" + nl + nl))
    facts = F.concat(F.lit("page_id: "), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(nl))
    three = F.array(
        record(F.lit("request"), _uuid(F.col("capture"), "request"), [beside], "application/http;msgtype=request", ask),
        record(F.when(again, "revisit").otherwise("response"), response, [digest, refers], "application/http;msgtype=response",
               F.when(again, http).otherwise(F.concat(http, F.col("html")))),
        record(F.lit("metadata"), _uuid(F.col("capture"), "metadata"), [beside], "application/warc-fields", facts),
    )
    return caps.select(F.explode(three).alias("value"))


def write_archives(pages: DataFrame, path: str) -> None:
    """Gzip WARC files in the folder ``path``."""
    records(captures(pages)).write.option("lineSep", "\r\n").option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


def _parsed(batches: Iterator[pa.RecordBatch], with_payload: bool) -> Iterator[pa.RecordBatch]:
    pending = b""

    def fields(head: bytes) -> dict[str, str]:
        return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n")) if k}

    for batch in batches:
        out = []
        for value in batch.column(0).to_pylist():
            data = value.encode()
            if pending:
                data = pending + VERSION.encode() + data
            head, _, rest = data.partition(b"\r\n\r\n")
            if not data:
                continue  # before the first record of a file
            h = fields(head)
            n = int(h.get("content-length", 0))
            if len(rest) < n:
                pending = data
                continue
            pending = b""
            block, kind = rest[:n], h.get("warc-type")
            payload = block.partition(b"\r\n\r\n")[2] if kind == "response" else b""
            out.append((
                h.get("warc-record-id"), kind, h.get("warc-concurrent-to"), h.get("warc-refers-to"), h.get("warc-target-uri"),
                h.get("warc-payload-digest", "").removeprefix("sha256:") or None, len(payload), hashlib.sha256(payload).hexdigest() if kind == "response" else None,
                block.decode("utf-8", "replace") if kind != "response" else None, payload if with_payload and kind == "response" else None,
            ))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _RECORD.types)], schema=_RECORD)


def read_records(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """One row per WARC record of the gzip files under ``path``."""
    return spark.read.option("lineSep", VERSION).text(path).mapInArrow(lambda it: _parsed(it, with_payload), RECORD_SCHEMA)


def transactions(found: DataFrame) -> DataFrame:
    """One nested row per capture: its response or revisit with the request and metadata concurrent to it."""
    body = ["record_id", "target_uri", "fields"]
    answer = found.where("type in ('response', 'revisit')").dropDuplicates(["record_id"])
    asked = found.where("type = 'request'").dropDuplicates(["concurrent_to"]).select(F.col("concurrent_to").alias("q"), F.struct(*body).alias("request"))
    facts = found.where("type = 'metadata'").dropDuplicates(["concurrent_to"]).select(F.col("concurrent_to").alias("m"), F.struct(*body).alias("metadata"))
    whole = answer.select("record_id", "type", F.struct("record_id", "type", "target_uri", "refers_to", "declared_digest", "payload_bytes", "payload_digest", "payload").alias("response"))
    one = whole.join(asked, F.col("record_id") == F.col("q"), "left").join(facts, F.col("record_id") == F.col("m"), "left")
    return one.select("record_id", "request", "response", "metadata")


def page_id(metadata: str) -> Column:
    text = F.regexp_extract(F.col(f"{metadata}.fields"), r"page_id: (-?\d*)", 1)
    return F.when(text != "", text.cast("bigint"))


def round_trip(pages: DataFrame) -> DataFrame:
    """Write the pages, read the archives back: one row per capture with its payload's size and digest."""
    spark = pages.sparkSession
    path = scratch(spark, "warc")
    write_archives(pages, path)
    caps = transactions(stored(read_records(spark, path, with_payload=False), "records")).withColumn("page_id", page_id("metadata"))
    caps = stored(caps.select("page_id", "record_id", F.col("response.type").alias("record_type"), F.col("response.refers_to").alias("refers"),
                              F.col("response.payload_bytes").alias("bytes"), F.col("response.payload_digest").alias("digest")), "captures")
    original = caps.where("record_type = 'response'").select(F.col("record_id").alias("o"), F.col("page_id").alias("o_page"), F.col("bytes").alias("o_bytes"), F.col("digest").alias("o_digest"))
    plain = caps.where("record_type = 'response'").select("page_id", F.col("bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"), "record_type", F.lit(None).cast("bigint").alias("refers_to"))
    again = caps.where("record_type = 'revisit'").join(original, F.col("refers") == F.col("o")).select(
        "page_id", F.col("o_bytes").alias("payload_bytes"), F.col("o_digest").alias("payload_digest"), "record_type", F.col("o_page").alias("refers_to"))
    return plain.unionByName(again)
