"""Reproducible splits that depend on row keys, never on row order or partitioning."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.text import hash_bucket
from tidemark.operators.blocked import join_with_nulls
from tidemark.session import materialise

PREFIX = 4  # hex digits: 65,536 buckets per class


def stratified_split(df: DataFrame, key: str, label: str, seed: int = 42) -> DataFrame:
    """Adds ``split``: 70/15/15 within each class, the rows of a class ranked by a keyed hash.

    Per class of n rows the holdout takes ``ceil(0.3 n)`` and the test split half of it, rounded up.
    Bucket counts locate the two cut ranks; only the buckets that hold a cut are sorted, and every
    other row is settled by comparing its hash with the cut. Rows without a label are a class of their own.
    """
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    hashed = df.withColumn("_h", digest).withColumn("_p", F.substring("_h", 1, PREFIX))
    keys = hashed.select(F.col(key).alias("_k"), F.col(label).alias("_c"), "_h", "_p")
    upto = Window.partitionBy("_c").orderBy("_p").rowsBetween(Window.unboundedPreceding, 0)
    counts = (
        keys.groupBy("_c", "_p").agg(F.count("*").alias("m"))
        .withColumn("cum", F.sum("m").over(upto))
        .withColumn("n", F.sum("m").over(Window.partitionBy("_c")))
        .withColumn("holdout", F.expr("(n * 30 + 99) div 100"))
        .withColumn("test", F.expr("(holdout + 1) div 2"))
    )
    # Two rows per class; written, so that the next join is broadcast by its real size.
    cuts = materialise(counts.select(
        "_c", "_p", F.expr("cum - m").alias("before"), "cum",
        F.explode(F.array(F.struct(F.lit("test").alias("cut"), F.col("test").alias("quota")),
                          F.struct(F.lit("val").alias("cut"), F.col("holdout").alias("quota")))).alias("q"),
    ).where("q.quota > before and q.quota <= cum").select(
        "_c", "_p", "q.cut", (F.col("q.quota") - F.col("before")).alias("rank")
    ), "split_cuts")
    buckets = cuts.select("_c", "_p").distinct()
    inside = Window.partitionBy("_c", "_p").orderBy("_h", "_k")
    ranked = join_with_nulls(keys, buckets, ["_c", "_p"], "left_semi").withColumn("rn", F.row_number().over(inside))
    last = join_with_nulls(ranked, cuts, ["_c", "_p"]).where("rn = rank")
    borders = materialise(
        last.groupBy("_c").agg(
            F.max(F.when(F.col("cut") == "test", F.struct("_h", "_k"))).alias("_test"),
            F.max(F.when(F.col("cut") == "val", F.struct("_h", "_k"))).alias("_val"),
        ),
        "split_borders",
    )
    here = F.struct(F.col("_h"), F.col(key).alias("_k"))
    return (
        hashed.join(borders, F.col(label).eqNullSafe(F.col("_c")))
        .withColumn(
            "split",
            F.when(here <= F.col("_test"), "test").when(here <= F.col("_val"), "val").otherwise("train"),
        )
        .drop("_h", "_p", "_c", "_test", "_val")
    )


def random_split(df: DataFrame, key: str, holdout_percent: int = 10, seed: int = 42) -> DataFrame:
    """Adds ``split``: ``val`` for about the given share of keys, else ``train``."""
    unit = hash_bucket(F.col(key), 1000, seed)
    return df.withColumn("split", F.when(unit < holdout_percent * 10, "val").otherwise("train"))


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Per class: its count and the balanced weight n / (k * n_c)."""
    counts = df.groupBy(label).agg(F.count("*").alias("n_class"))
    totals = counts.agg(F.struct(F.sum("n_class").alias("n"), F.count("*").alias("k")).alias("s"))
    return (
        counts.withColumn("_t", totals.scalar())
        .withColumn("weight", F.col("_t.n") / (F.col("_t.k") * F.col("n_class")))
        .drop("_t")
    )
