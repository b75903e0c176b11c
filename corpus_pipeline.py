"""A corpus pipeline: five stages over ``documents``: quality rules, line de-duplication, near-duplicates by fingerprints
(``simhash``) and then by the Jaccard similarity of shingle sets (``shingle_sets``), decontamination and pieces, by the
operators of ``tidemark.llm``. The README says why near-duplicates take two steps.

Every stage takes ``(spark, docs, sf_dir)`` and works on all that its predecessor kept. All but the last return the
columns of ``docs``. ``run`` writes each stage's rows as Parquet in the shared folder and reads them for the next one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, line_dedup, pieces, quality, shingle_sets, simhash
from tidemark.llm.queries import MODEL
from tidemark.plans.registry import table
from tidemark.session import materialise


def _recount(docs: DataFrame) -> DataFrame:
    """``n_chars`` is that of the text as it is now; nulls stay null."""
    return docs.withColumn("n_chars", F.length("text").cast("bigint")) if "n_chars" in docs.columns else docs


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what the base limits or the learned rules reject; null and blank texts have no words and go."""
    slim, column = quality.statistics(docs.select("doc_id", "text"))
    stats = materialise(slim.select("doc_id", F.col(column).alias("stats")), "quality-stats")
    rules = quality.learn_rules(stats, "stats", table(spark, sf_dir, "labels"))
    measured, column = quality.statistics(docs)
    return measured.where(quality.keep(F.col(column), rules)).select(docs.columns)


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts lines that repeat an earlier one, exactly or within two edits; documents without any line left go."""
    return _recount(line_dedup.drop_repeated_lines(docs))


def fingerprints(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group that op5 makes: fingerprints of four-word shingles within four bits.

    Which document stays and what a row is are as in ``near_duplicates``.
    """
    return _first_of_each_group(docs, simhash.near_duplicates)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates, that of the smallest doc_id.

    Documents are linked whose sets of five-word shingles have a Jaccard similarity of 0.8 or more, whatever their
    fingerprints: at 0.8 those of 64 bits differ in about ten, too many to be found by distance without loss.
    A document without doc_id comes after all others. A row is known by its doc_id and its text, so rows of one doc_id
    with different texts are different documents; rows equal in both leave one.
    """
    return _first_of_each_group(docs, shingle_sets.near_duplicates)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``fingerprints``, then ``near_duplicates`` over all that it keeps."""
    return near_duplicates(spark, materialise(fingerprints(spark, docs, sf_dir), "one-of-fingerprints"), sf_dir)


def _first_of_each_group(docs: DataFrame, linked: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    known = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("text"))
    named = docs.withColumn("_known", known)
    groups = linked(named.select("_known", "text"), "_known")
    same = lambda c: [F.col(f"{c}.none").alias("_none"), F.coalesce(f"{c}.id", F.lit(0)).alias("_id"), F.col(f"{c}.text").alias("_text")]
    kept = groups.where("_known <=> component_id").select(*same("_known")).distinct()
    parts = ["_none", "_id", "_text"]
    return named.select(*docs.columns, *same("_known")).join(kept, parts, "left_semi").dropDuplicates(parts).select(docs.columns)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in which any window of ten words of a benchmark item occurs."""
    found, column = decontaminate.find_contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.where(F.col(column)["n_hit"] == 0).select(docs.columns)


def piece_ids(spark: SparkSession, docs: DataFrame, sf_dir: str, model_path: str = MODEL) -> DataFrame:
    """Adds ``piece_ids`` and ``n_pieces``, and ``decoded_sha256`` of the text that the ids decode to."""
    model = pieces.read_model(model_path)
    coded, ids = pieces.encode(docs, model)
    back, text = pieces.decode(coded, model, ids)
    return back.select(
        *docs.columns, F.col(ids).alias("piece_ids"), F.size(ids).cast("bigint").alias("n_pieces"),
        F.sha2(text, 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", repeated_lines),
    ("fingerprints", one_of_near_copies),
    ("decontamination", benchmark_free),
    ("sentencepiece", piece_ids),
]
#: SQL can express neither the learned rules nor the fingerprints; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
