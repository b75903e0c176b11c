"""Scans. Every reader has an explicit schema; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import map_values, strip
from tidemark.operators.fingerprint import table_fingerprint
from tidemark.sources.quoted import file_digests, read_quoted_csv

# Label words and codes of the three kinds of source.
CODE_LABELS = {0: "bearish", 1: "bullish", 2: "neutral"}
ANSWER_LABELS = {"positive": "bullish", "negative": "bearish", "neutral": "neutral"}
FEED_LABELS = {
    "Bullish": "bullish",
    "Somewhat-Bullish": "bullish",
    "Neutral": "neutral",
    "Somewhat-Bearish": "bearish",
    "Bearish": "bearish",
}

FEED_SCHEMA = "feed array<struct<title: string, overall_sentiment_label: string>>"
MESSAGES_SCHEMA = "messages array<struct<role: string, content: string>>"
SOFT_LABEL_SCHEMA = "text string, probs array<double>"
METRICS_SCHEMA = "test_f1 double, n_test bigint, metric string, base_rougeL double"


def read_coded_csv(
    spark: SparkSession, path: str, schema: str = "text string, label int", labels: dict | None = None
) -> DataFrame:
    """Labelled CSV with a header: text and an integer label. ``schema`` lists the file's columns."""
    raw = read_quoted_csv(spark, path, schema)
    return raw.select("text", map_values(F.col("label"), labels or CODE_LABELS).alias("label"))


def read_feed(spark: SparkSession, path: str) -> DataFrame:
    """Landed pages of a news feed: one row per article. A page without a feed gives no rows."""
    return articles(_pages(spark, path))


def bad_feed_pages(spark: SparkSession, path: str) -> DataFrame:
    """Pages without a feed (a rate-limit note, say), for the quarantine."""
    return _pages(spark, path).where("feed is null").select("page")


def _pages(spark: SparkSession, path: str) -> DataFrame:
    pages = spark.read.schema(FEED_SCHEMA).json(path, multiLine=True)
    return pages.select("feed", F.col("_metadata.file_path").alias("page"))


def articles(pages: DataFrame) -> DataFrame:
    return pages.select(F.explode("feed").alias("a")).select(
        F.col("a.title").alias("text"),
        map_values(F.col("a.overall_sentiment_label"), FEED_LABELS).alias("label"),
    )


def read_answers(spark: SparkSession, path: str) -> DataFrame:
    """Parquet table of a dataset hub: ``answer`` becomes the label."""
    raw = spark.read.parquet(path)
    return raw.select("text", map_values(F.col("answer"), ANSWER_LABELS).alias("label"))


def read_validated(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One JSON object per line; blank lines are skipped."""
    return spark.read.schema(schema).json(path)


def read_headlines_csv(spark: SparkSession, path: str) -> DataFrame:
    """Quoted CSV with the single column ``text``."""
    return read_quoted_csv(spark, path, "text string")


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """Directory of metric files, one JSON object each; the file path says which run wrote it."""
    raw = spark.read.schema(METRICS_SCHEMA).json(path, multiLine=True)
    return raw.select("*", F.col("_metadata.file_path").alias("path"))


def _stemmed(spark: SparkSession, root: str, folder: str, column: str) -> DataFrame:
    raw = spark.read.text(f"{root}/*/{folder}/*.txt", wholetext=True)
    place = F.col("_metadata.file_path")
    where = rf"/([^/]+)/{folder}/([^/]+)\.txt$"
    return raw.select(
        F.regexp_extract(place, where, 1).alias("split"),
        F.regexp_extract(place, where, 2).alias("id"),
        strip(F.col("value")).alias(column),
    )


def read_text_pairs(
    spark: SparkSession, root: str, left: str = "ects", right: str = "gt_summaries"
) -> tuple[DataFrame, DataFrame]:
    """Documents and summaries in sibling folders, paired by split and file stem.

    Gives the pairs ``(split, id, transcript, summary)`` and the orphans ``(split, id, missing)``.
    """
    texts = _stemmed(spark, root, left, "transcript")
    summaries = _stemmed(spark, root, right, "summary")
    return pair_by_key(texts, summaries, ["split", "id"])


def pair_by_key(left: DataFrame, right: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    pairs = left.join(right, keys)
    orphans = (
        left.join(right, keys, "left_anti").select(*keys, F.lit("right").alias("missing"))
        .unionByName(right.join(left, keys, "left_anti").select(*keys, F.lit("left").alias("missing")))
    )
    return pairs, orphans


def require_paired(orphans: DataFrame) -> None:
    """A missing partner is an error."""
    first = orphans.first()
    if first is not None:
        raise ValueError(f"no partner for {first.asDict()}")


def dataset_manifest(spark: SparkSession, path: str) -> DataFrame:
    """One row: number of files, total bytes and an order-free digest of names and contents."""
    root = path.rstrip("/") + "/"
    rel = F.substr(F.col("path"), F.instr("path", root) + len(root))
    files = file_digests(spark, path).select(rel.alias("name"), "length", "digest")
    totals = files.agg(F.count("*").alias("nfiles"), F.sum("length").alias("size"))
    whole = table_fingerprint(files, ["name", "length", "digest"]).select("digest")
    return totals.withColumn("digest", whole.scalar())
