"""Web archives with repeated payloads written once.

A WARC/1.1 file is text here: header block, CRLF CRLF, content block, CRLF CRLF. Spark's text
writer puts CRLF CRLF behind every row, so archives are written and read by Spark's own file
layer (any store, commit protocol, task retries) and no payload passes through Python.

Every record starts with ``WARC/1.1`` and an ``X-Record-Mark`` field that holds a random value
of the archive. The reader splits on that pair, as a MIME reader splits on its boundary, so a
payload that itself holds WARC records stays whole. Lengths are checked on reading.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dayplan.llm.shared import Scratch

_GAP = "\r\n\r\n"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_URN = "<urn:page:"


def payload_headers(pages: DataFrame, page_id: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """(page_id, url, bytes, digest) per row; a null payload is empty. No payload is kept."""
    body = F.coalesce(F.col(payload), F.lit("")).cast("binary")
    return pages.select(
        F.col(page_id).cast("bigint").alias("page_id"),
        F.regexp_replace(F.coalesce(F.col(url), F.lit("")), "[\\r\\n]", " ").alias("url"),
        F.octet_length(body).cast("bigint").alias("bytes"),
        F.sha1(body).alias("digest"),
    )


def find_revisits(headers: DataFrame, min_bytes: int = 1000) -> DataFrame:
    """Headers of rows that revisit the row with the largest page_id of their payload.

    Only headers are shuffled. The largest id is taken with map-side combine, so a payload that
    a third of all rows share is a few rows when it moves; digests that occur once end there.
    The join back is left to the adaptive planner, which splits a hot digest.
    Rows that share payload and largest id are all originals; a null id is below every id, and
    where a payload has null ids only, all its rows are originals.
    """
    large = headers.where(F.col("bytes") >= min_bytes)
    kept = (
        large.groupBy(F.col("digest").alias("d"), F.col("bytes").alias("b"))
        .agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n"))
        .where("n > 1 and refers_to is not null")
        .drop("n")
    )
    return (
        large.join(kept, (F.col("digest") == F.col("d")) & (F.col("bytes") == F.col("b")))
        .where(~F.col("page_id").eqNullSafe(F.col("refers_to")))
        .select("page_id", "url", "bytes", "digest", "refers_to")
    )


def _record(kind: str, mark: str, date: str, extra: Column, block: Column, block_bytes: Column) -> Column:
    name = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    return F.concat(
        F.lit(f"WARC/1.1\r\nX-Record-Mark: {mark}\r\nWARC-Type: {kind}\r\nWARC-Record-ID: {_URN}"), name,
        F.lit(">\r\nWARC-Target-URI: "), F.col("url"),
        F.lit(f"\r\nWARC-Date: {date}\r\nWARC-Payload-Digest: sha1:"), F.col("digest"),
        extra,
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        block_bytes.cast("string"), F.lit(_GAP), block,
    )


def write_archives(
    pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", payload: str = "html",
    min_bytes: int = 1000, date: str = "1970-01-01T00:00:00Z", compression: str = "gzip",
) -> str:
    """Write one record per row of ``pages`` under ``path``; returns the record mark.

    Revisit records come from headers alone. Originals are the rows that no revisit names: an
    anti join against a stored table, broadcast by the planner only when its measured size is
    small, else one shuffle of the payloads.
    """
    spark = pages.sparkSession
    mark = uuid.uuid4().hex
    revisits = Scratch(spark, "warc").write(
        find_revisits(payload_headers(pages, page_id, url, payload), min_bytes), "revisits"
    )
    http = F.concat(F.lit(_HTTP), F.col("bytes").cast("string"), F.lit(_GAP))
    body = F.coalesce(F.col(payload), F.lit(""))
    binary = body.cast("binary")
    gone = revisits.select(F.col("page_id").alias("gone"), F.col("digest").alias("gone_digest"))
    originals = (
        pages.select(
            F.col(page_id).cast("bigint").alias("page_id"),
            F.regexp_replace(F.coalesce(F.col(url), F.lit("")), "[\\r\\n]", " ").alias("url"),
            F.octet_length(binary).cast("bigint").alias("bytes"), F.sha1(binary).alias("digest"), body.alias("body"),
        )
        .join(gone, F.col("page_id").eqNullSafe(F.col("gone")) & (F.col("digest") == F.col("gone_digest")), "left_anti")
        .select(_record(
            "response", mark, date, F.lit(""), F.concat(http, F.col("body")), F.octet_length(http) + F.col("bytes"),
        ).alias("value"))
    )
    again = revisits.select(_record(
        "revisit", mark, date,
        F.concat(F.lit(f"\r\nWARC-Profile: {_PROFILE}\r\nWARC-Refers-To: {_URN}"), F.col("refers_to").cast("string"),
                 F.lit(">")),
        http, F.octet_length(http).cast("bigint"),
    ).alias("value"))
    originals.unionAll(again).write.option("lineSep", _GAP).option("compression", compression).text(path)
    return mark


def read_archives(spark: SparkSession, path: str, mark: str | None = None) -> DataFrame:
    """Records as (page_id, url, record_type, refers_to, digest, http, payload).

    Without ``mark``, records are split before every ``WARC/1.1`` line, which is right as long as
    no payload holds a record. A content block that is not as long as its header says is an error.
    """
    start = f"{_GAP}WARC/1.1\r\n" + (f"X-Record-Mark: {mark}\r\n" if mark else "")
    raw = spark.read.option("lineSep", start).text(path)

    def field(name: str) -> Column:
        return F.regexp_extract("head", f"(?:^|\\r\\n){name}: ([^\\r\\n]*)", 1)

    def number(text: Column) -> Column:
        return F.regexp_extract(text, "^<urn:page:(-?[0-9]+)>$", 1)

    parsed = raw.withColumn("head", F.substring_index("value", _GAP, 1)).select(
        "head", F.expr("substring(value, length(head) + 5)").alias("block"),
        field("Content-Length").cast("bigint").alias("declared"),
    )
    tail = F.expr("octet_length(block) = declared + 4") & F.col("block").endswith(_GAP)
    whole = parsed.withColumn(
        "block", F.when(tail, F.expr("substring(block, 1, length(block) - 4)")).otherwise(F.col("block"))
    ).withColumn(
        "block",
        F.when(F.octet_length("block") == F.col("declared"), F.col("block")).otherwise(
            F.raise_error(F.concat(F.lit("broken record: "), F.col("head")))
        ),
    )
    page, refers = number(field("WARC-Record-ID")), number(field("WARC-Refers-To"))
    return whole.select(
        F.when(page != "", page.cast("bigint")).alias("page_id"),
        field("WARC-Target-URI").alias("url"),
        field("WARC-Type").alias("record_type"),
        F.when(refers != "", refers.cast("bigint")).alias("refers_to"),
        F.regexp_extract("head", "(?:^|\\r\\n)WARC-Payload-Digest: sha1:([0-9a-f]*)", 1).alias("digest"),
        F.substring_index("block", _GAP, 1).alias("http"),
        F.expr("substring(block, length(substring_index(block, '\\r\\n\\r\\n', 1)) + 5)").alias("payload"),
    )


def resolve_revisits(records: DataFrame) -> DataFrame:
    """Payload size and digest of every record, a revisit's taken from its original response.

    ``records`` holds (page_id, record_type, refers_to, digest, payload_bytes, payload_digest), the last two measured on the payload read.
    A revisit whose original is missing gets nulls. Several originals with the same id and digest hold the same payload.
    """
    originals = (
        records.where("record_type = 'response'")
        .groupBy(F.col("page_id").alias("o_id"), F.col("digest").alias("o_digest"))
        .agg(F.max("payload_bytes").alias("o_bytes"), F.max("payload_digest").alias("o_sha1"))
    )
    again = (
        records.where("record_type = 'revisit'").drop("payload_bytes", "payload_digest")
        .join(originals, (F.col("refers_to") == F.col("o_id")) & (F.col("digest") == F.col("o_digest")), "left")
    )
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return records.where("record_type = 'response'").select(*columns).unionAll(
        again.select("page_id", F.col("o_bytes").alias("payload_bytes"), F.col("o_sha1").alias("payload_digest"),
                     "record_type", "refers_to")
    )


def archive_round_trip(pages: DataFrame, **names) -> DataFrame:
    """Write ``pages`` as archives in the shared folder, read them back and resolve all revisits."""
    spark = pages.sparkSession
    scratch = Scratch(spark, "archives")
    mark = write_archives(pages, f"{scratch.root}/warc", **names)
    body = F.col("payload").cast("binary")
    records = scratch.write(
        read_archives(spark, f"{scratch.root}/warc", mark).select(
            "page_id", "record_type", "refers_to", "digest",
            F.octet_length(body).cast("bigint").alias("payload_bytes"), F.sha1(body).alias("payload_digest"),
        ),
        "records",
    )
    return resolve_revisits(records)
