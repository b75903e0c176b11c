"""The headline pool: fan-in of many pulls, exact de-duplication, incremental merge, time windows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def text_hash(text: str = "text") -> Column:
    return F.sha2(F.col(text), 256).alias("text_hash")


def pool_texts(pulls: list[DataFrame], spark: SparkSession, key: str | None = None) -> DataFrame:
    """Union of all pulls without null texts, one row per distinct text: ``(text_hash, text)``.

    With a ``key`` column the copy with the lowest key is kept, together with its key. No pulls
    give an empty pool.
    """
    if not pulls:
        return spark.createDataFrame([], "text_hash string, text string")
    kept = [p.select("text", *([key] if key else [])) for p in pulls]
    rows = reduce(DataFrame.unionByName, kept).where("text is not null")
    hashed = rows.withColumn("text_hash", text_hash())
    if key is None:
        return hashed.groupBy("text_hash").agg(F.any_value("text").alias("text"))
    return hashed.groupBy("text_hash").agg(F.min(key).alias(key), F.min_by("text", key).alias("text"))


def new_texts(pool: DataFrame, stored: DataFrame) -> DataFrame:
    """Texts that the stored pool lacks; append them instead of writing the pool anew."""
    return pool.join(stored.select("text_hash"), "text_hash", "left_anti")


def time_windows(spark: SparkSession, end: Column, n: int = 25, days_each: int = 14) -> DataFrame:
    """Disjoint windows, newest first: ``(idx, time_from, time_to)`` as ``YYYYMMDDTHHMM``."""
    bounds = spark.range(n).select(F.col("id").alias("idx"), end.alias("now"))

    def stamp(steps: str) -> Column:
        return F.date_format(F.expr(f"now - make_dt_interval(int(({steps}) * {days_each}))"), "yyyyMMdd'T'HHmm")

    return bounds.select("idx", stamp("idx + 1").alias("time_from"), stamp("idx").alias("time_to"))


def window_index(ts: Column, end: Column, n: int = 25, days_each: int = 14) -> Column:
    """Index of the window that holds ``ts`` (its start excluded, its end included), else null."""
    age = F.unix_micros(end.cast("timestamp")) - F.unix_micros(ts.cast("timestamp"))
    idx = F.floor(age / F.lit(days_each * 86_400_000_000))
    return F.when((age >= 0) & (idx < n), idx)
