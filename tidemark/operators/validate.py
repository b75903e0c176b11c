"""Batch validation: rule breaches, quarantine, and the table-level quality checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.fingerprint import row_digest
from tidemark.schemas import TextSchema


class SchemaError(ValueError):
    """A batch broke its schema."""


def breach_counts(df: DataFrame, schema: TextSchema) -> DataFrame:
    """One row: the batch size and, per rule, how many rows break it; a single pass."""
    return df.agg(
        F.count("*").alias("n_rows"), *[F.count_if(c).alias(name) for name, c in schema.rules().items()]
    )


def with_breaches(df: DataFrame, schema: TextSchema) -> DataFrame:
    """Adds ``breaches``: the names of the rules each row breaks."""
    marks = [F.when(c, F.lit(name)) for name, c in schema.rules().items()]
    return df.withColumn("breaches", F.array_compact(F.array(*marks)))


def split_batch(df: DataFrame, schema: TextSchema) -> tuple[DataFrame, DataFrame]:
    """Good rows, and broken rows with their breaches. Missing or mistyped columns raise."""
    require_columns(df, schema)
    marked = with_breaches(df, schema)
    good = marked.where(F.size("breaches") == 0).drop("breaches")
    return good, marked.where(F.size("breaches") > 0)


def require_columns(df: DataFrame, schema: TextSchema) -> None:
    problems = schema.column_problems(df.schema)
    if problems:
        raise SchemaError(f"schema {schema.name}: {problems[0]}")


def require_valid(df: DataFrame, schema: TextSchema) -> int:
    """Raises on the first broken rule, else gives the number of rows."""
    require_columns(df, schema)
    counts = breach_counts(df, schema).first().asDict()
    for rule in schema.rules():
        if counts[rule]:
            raise SchemaError(f"schema {schema.name}: rule {rule} is broken by {counts[rule]} rows")
    return counts["n_rows"]


def null_fractions(df: DataFrame, columns: list[str], text: str = "text") -> DataFrame:
    """Share of nulls per column; the text column allows none, the others less than 1%."""
    shares = df.agg(*[F.avg(F.col(c).isNull().cast("int")).alias(c) for c in columns])
    pairs = ", ".join(f"'{c}', `{c}`" for c in columns)
    long = shares.select(F.expr(f"stack({len(columns)}, {pairs}) as (column_name, null_fraction)"))
    ok = F.when(F.col("column_name") == text, F.col("null_fraction") == 0).otherwise(
        F.col("null_fraction") < 0.01
    )
    return long.withColumn("ok", ok)


def duplicate_rate(df: DataFrame, columns: list[str], limit: float = 0.005) -> DataFrame:
    """Rows, distinct rows, and whether copies make up the limit or more of the batch."""
    copies = df.select(row_digest(columns).alias("h")).groupBy("h").agg(F.count("*").alias("n"))
    out = copies.agg(F.sum("n").alias("n_rows"), F.count("*").alias("n_distinct"))
    rate = (F.col("n_rows") - F.col("n_distinct")) / F.col("n_rows")
    return out.withColumn("duplicate_rate", rate).withColumn("dedupe", rate >= limit)


def in_length(text: Column, low: int = 10, high: int = 2000) -> Column:
    return F.length(text).between(low, high)


def length_report(df: DataFrame, text: str, *groups: str, limit: float = 0.02) -> DataFrame:
    """Rows kept and dropped by the length rule; a warning when more than 2% are dropped."""
    keep = F.coalesce(in_length(F.col(text)), F.lit(False))
    out = df.groupBy(*groups).agg(F.count_if(keep).alias("n_kept"), F.count_if(~keep).alias("n_dropped"))
    rate = F.col("n_dropped") / (F.col("n_kept") + F.col("n_dropped"))
    return out.withColumn("drop_rate", rate).withColumn("warn", rate > limit)


def volume_band(df: DataFrame, source: str, ts: str, batches: int = 7, width: float = 0.5) -> DataFrame:
    """Daily batch sizes per source, checked against the mean of the batches before them."""
    daily = df.groupBy(source, F.to_date(ts).alias("day")).agg(F.count("*").alias("n_rows"))
    before = Window.partitionBy(source).orderBy("day").rowsBetween(-batches, -1)
    mean = F.avg("n_rows").over(before)
    return daily.withColumn("trailing_mean", mean).withColumn(
        "alert", F.coalesce(F.abs(F.col("n_rows") - mean) > F.lit(width) * mean, F.lit(False))
    )


def class_balance(df: DataFrame, label: str, floor: float = 0.10) -> DataFrame:
    """Share of each class; a warning below the floor."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n"))
    return (
        counts.withColumn("share", F.col("n") / total.scalar())
        .withColumn("warn", F.col("share") < floor)
    )


def freshness(df: DataFrame, source: str, ts: str, now: Column, max_age_seconds: int) -> DataFrame:
    """Newest timestamp per source and whether it is older than allowed."""
    out = df.groupBy(source).agg(F.max(ts).alias("newest"))
    age = F.unix_timestamp(now) - F.unix_timestamp("newest")
    return out.withColumn("age_seconds", age).withColumn("stale", age > max_age_seconds)


def encoding_report(df: DataFrame, text: str, *groups: str) -> DataFrame:
    """Rows with invalid UTF-8, and rows that carry the replacement character."""
    return df.groupBy(*groups).agg(
        F.count("*").alias("n_rows"),
        F.count_if(~F.is_valid_utf8(F.col(text))).alias("n_invalid"),
        F.count_if(F.contains(F.col(text), F.lit("�"))).alias("n_replaced"),
    )
