"""Fault injection: broken copies of a clean batch, to show that validation rejects them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import hash_bucket

BAD_LABEL = "garbage"  # fixed value


def first_row(df: DataFrame, key: str) -> Column:
    """True on the row with the lowest key."""
    return F.col(key) == df.agg(F.min(key)).scalar()


def some_rows(key: str, per_mille: int, seed: int = 13) -> Column:
    """True on about the given share of rows, always the same ones."""
    return hash_bucket(F.col(key), 1000, seed) < per_mille


def corrupt_label(df: DataFrame, rows: Column) -> DataFrame:
    return df.withColumn("label", F.when(rows, F.lit(BAD_LABEL)).otherwise(F.col("label")))


def corrupt_null_text(df: DataFrame, rows: Column) -> DataFrame:
    return df.withColumn("text", F.when(~rows, F.col("text")))


def corrupt_drop_column(df: DataFrame) -> DataFrame:
    return df.drop("label")
