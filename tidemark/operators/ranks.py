"""Exact order statistics per group without sorting a group in one task."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.blocked import join_with_nulls
from tidemark.session import materialise

ACCURACY = 10_000


def exact_ranks(
    df: DataFrame,
    groups: list[str],
    value: str,
    targets: dict[str, tuple[float, Callable[[Column], Column]]],
    accuracy: int = ACCURACY,
) -> DataFrame:
    """Values at given ranks: one row per group with its count ``n`` and a column per target.

    A target is a fraction and a function from the group's row count to the 0-based rank wanted near
    that fraction. A quantile sketch brackets each rank within a guaranteed error; one more pass
    counts the rows below each bracket and the distinct values inside it, and only those few values
    are ordered. Ties cost one row. Groups of at most ten rows per unit of accuracy are ordered as
    they are.
    """
    rows = df.where(F.col(value).isNotNull()).select(*groups, F.col(value).cast("double").alias("_v"))
    slack = 2.0 / accuracy
    names = list(targets)
    low = [max(0.0, targets[t][0] - slack) for t in names]
    high = [min(1.0, targets[t][0] + slack) for t in names]
    sketch = rows.groupBy(*groups).agg(
        F.count("*").alias("n"),
        F.min("_v").alias("_min"),
        F.max("_v").alias("_max"),
        F.percentile_approx("_v", low + high, accuracy).alias("_q"),
    )
    k = len(names)
    small = F.col("n") <= 10 * accuracy
    brackets = F.array(
        *[
            F.struct(
                F.lit(t).alias("target"),
                F.when(small | F.lit(low[i] == 0), F.col("_min")).otherwise(F.col("_q")[i]).alias("lo"),
                F.when(small | F.lit(high[i] == 1), F.col("_max")).otherwise(F.col("_q")[k + i]).alias("hi"),
                targets[t][1](F.col("n")).cast("bigint").alias("rank"),
            )
            for i, t in enumerate(names)
        ]
    )
    # Written, so that Catalyst broadcasts it by its real size instead of shuffling all rows by group.
    bounds = materialise(sketch.select(*groups, "n", brackets.alias("_b")), "rank_bounds")
    near = (
        join_with_nulls(rows, bounds, groups)
        .select(*groups, "n", "_v", F.explode(F.filter("_b", lambda b: F.col("_v") <= b["hi"])).alias("b"))
        .select(
            *groups, "n", "b.target", "b.rank",
            F.when(F.col("_v") >= F.col("b.lo"), F.col("_v")).alias("v"),
        )
        .groupBy(*groups, "n", "target", "rank", "v")
        .agg(F.count("*").alias("c"))
    )
    upto = (
        Window.partitionBy(*groups, "target")
        .orderBy(F.asc_nulls_first("v"))
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    hit = near.withColumn("cum", F.sum("c").over(upto)).where(
        (F.col("cum") > F.col("rank")) & (F.col("cum") - F.col("c") <= F.col("rank"))
    )
    # A null here would mean that the sketch broke its bound: fail rather than answer wrongly.
    checked = F.when(F.col("v").isNotNull(), F.col("v")).otherwise(
        F.raise_error(F.lit("rank lies outside its bracket")).cast("double")
    )
    return (
        hit.withColumn("v", checked)
        .groupBy(*groups, "n")
        .agg(*[F.max(F.when(F.col("target") == t, F.col("v"))).alias(t) for t in names])
    )


def floor_rank(p: float) -> tuple[float, Callable[[Column], Column]]:
    """The element ``sorted[int(p * (n - 1))]``."""
    return p, lambda n: F.floor(F.lit(p) * (n - 1))


def exact_median(df: DataFrame, groups: list[str], value: str, name: str = "median") -> DataFrame:
    """Mean of the two middle values (which coincide for an odd count)."""
    halves = {
        "_lower": (0.5, lambda n: F.floor((n - 1) / 2)),
        "_upper": (0.5, lambda n: F.floor(n / 2)),
    }
    out = exact_ranks(df, groups, value, halves)
    return out.withColumn(name, (F.col("_lower") + F.col("_upper")) / 2).drop("_lower", "_upper")
