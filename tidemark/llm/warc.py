"""A content-addressed web archive: each payload is stored once under its SHA-256, record headers stand apart.

``write_archive`` makes two Parquet tables in a folder: ``records`` (the exact WARC and HTTP header text of each
record, with the address of its payload) and ``payloads`` (the bytes, once per address). ``read_records`` parses the
headers and checks every stored payload against its address; ``rebuild`` joins the tables to whole record bytes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CRLF = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _urn(key: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(key.cast("string"), F.lit("null")), F.lit(">"))


def _headers(kind: Column, key: Column, url: Column, refers: Column, sha1: Column, size: Column, date: str) -> Column:
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))
    http = F.when(
        kind == "response",
        F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}"), line("Content-Type", F.lit("text/html; charset=utf-8")),
                 line("Content-Length", size.cast("string")), F.lit(CRLF)),
    ).otherwise(F.lit(""))
    revisit = F.when(
        kind == "revisit", F.concat(line("WARC-Profile", F.lit(PROFILE)), line("WARC-Refers-To", _urn(refers)))
    ).otherwise(F.lit(""))
    length = F.octet_length(http) + F.when(kind == "response", size).otherwise(F.lit(0))
    one_line = F.regexp_replace(F.coalesce(url, F.lit("")), r"[\r\n]+", " ")
    return F.concat(
        F.lit(f"WARC/1.1{CRLF}"), line("WARC-Type", kind), line("WARC-Record-ID", _urn(key)),
        line("WARC-Date", F.lit(date)), line("WARC-Target-URI", one_line),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), sha1)), revisit,
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", length.cast("string")), F.lit(CRLF), http,
    )


def write_archive(
    pages: DataFrame, path: str, key: str = "page_id", url: str = "url", html: str = "html", least: int = 1000,
    date: str = "1970-01-01T00:00:00Z",
) -> None:
    """Writes one record per row of ``pages`` under ``path``.

    Of rows whose payloads are equal and have at least ``least`` bytes, the one with the largest key is the response
    and the others revisit it; smaller payloads are all responses. Rows that repeat the winning key are all responses.
    A null key counts as the smallest, a null payload is empty, a null url is blank. Other columns are ignored.

    Payload bytes move once: copies meet in the map-side part of one aggregation. The other shuffle carries digests.
    """
    spark = pages.sparkSession
    rows = pages.select(
        F.col(key).cast("bigint").alias("page_id"), F.col(url).cast("string").alias("url"),
        F.encode(F.coalesce(F.col(html), F.lit("")), "utf-8").alias("payload"),
    ).withColumn("sha256", F.sha2("payload", 256))
    rows.groupBy("sha256").agg(F.first("payload").alias("payload")).write.parquet(f"{path}/payloads")
    slim = rows.select("page_id", "url", "sha256", F.sha1("payload").alias("sha1"),
                       F.octet_length("payload").cast("bigint").alias("size"))
    winners = slim.groupBy("sha256").agg(F.max("page_id").alias("winner"))
    kind = F.when((F.col("size") < least) | F.col("page_id").eqNullSafe(F.col("winner")), "response").otherwise("revisit")
    records = slim.join(winners, "sha256").withColumn("kind", kind)
    records.select(
        "page_id", "sha256",
        _headers(F.col("kind"), F.col("page_id"), F.col("url"), F.col("winner"), F.col("sha1"), F.col("size"), date)
        .alias("header"),
    ).write.parquet(f"{path}/records")


def _tables(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    records = spark.read.schema("page_id bigint, sha256 string, header string").parquet(f"{path}/records")
    payloads = spark.read.schema("sha256 string, payload binary").parquet(f"{path}/payloads")
    return records, payloads


def _field(name: str) -> Column:
    return F.regexp_extract("header", rf"\r\n{name}: ([^\r]*)\r\n", 1)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` of each record.

    Sizes and digests are taken from the stored bytes, each payload once; bytes that do not match their address, and
    a header whose digest is not that of its payload, fail the job.
    """
    records, payloads = _tables(spark, path)
    stored = payloads.select(
        F.when(F.sha2("payload", 256) == F.col("sha256"), F.col("sha256"))
        .otherwise(F.raise_error(F.lit("a stored payload does not match its address"))).alias("sha256"),
        F.octet_length("payload").cast("bigint").alias("payload_bytes"), F.sha1("payload").alias("payload_digest"),
    )
    digest = F.when(
        _field("WARC-Payload-Digest") == F.concat(F.lit("sha1:"), F.col("payload_digest")), F.col("payload_digest")
    ).otherwise(F.raise_error(F.lit("a record's digest is not that of its payload")))
    refers = F.regexp_extract(_field("WARC-Refers-To"), r"<urn:page:(-?\d+)>", 1)
    return records.join(stored, "sha256").select(
        "page_id", "payload_bytes", digest.alias("payload_digest"), _field("WARC-Type").alias("record_type"),
        F.when(refers != "", refers.cast("bigint")).alias("refers_to"),
    )


def rebuild(spark: SparkSession, path: str) -> DataFrame:
    """``page_id, record``: the exact bytes of each WARC record, its payload joined in where the record holds one."""
    records, payloads = _tables(spark, path)
    body = F.when(_field("WARC-Type") == "response", F.col("payload")).otherwise(F.lit(b""))
    return records.join(payloads, "sha256").select(
        "page_id", F.concat(F.encode("header", "utf-8"), body, F.lit(b"\r\n\r\n")).alias("record")
    )
