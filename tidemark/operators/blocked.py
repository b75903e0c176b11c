"""Running aggregates over long ordered groups, cut into blocks.

A plain window sorts each group in one task. When a group may hold a large share of all rows, its
ordered rows are cut into blocks instead: each block is aggregated, the running value of the blocks
is taken on that much smaller table, and the full window runs inside a block only.

``block`` must grow with the order columns: a time slice for rows ordered by time, or the ranges that
``range_blocks`` cuts, whose number grows with the data.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import materialise


def time_block(ts: Column, seconds: int = 600) -> Column:
    """Index of the time slice that holds ``ts``."""
    return F.floor(F.unix_timestamp(ts) / F.lit(seconds))


def range_blocks(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """Writes ``df`` in ranges of ``order``, one per shuffle partition, and adds ``_block`` (ascending) and a unique ``_id``.

    Ranges are cut by a sample of the rows, so a busy second or a popular key is spread like any other.
    """
    return materialise(
        df.repartitionByRange(*order).withColumns(
            {"_block": F.spark_partition_id(), "_id": F.monotonically_increasing_id()}
        ),
        name,
    )


def join_with_nulls(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """An equi-join in which a null key meets a null key; the keys of ``left`` stay."""
    names = {k: f"_right_{i}" for i, k in enumerate(keys)}
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(n)) for k, n in names.items()])
    return left.join(right.withColumnsRenamed(names), same, how).drop(*names.values())


def running(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    block: str,
    sums: dict[str, Column] | None = None,
    maxima: dict[str, Column] | None = None,
) -> DataFrame:
    """Adds running sums (each row included) and running maxima (each row left out; null at first).

    A maximum over structs that begin with the order columns is the last such row, so it also serves
    as ``lag`` and, with nulls for rows to skip, as the last marked row. All columns share one carry
    table and one sort. Null keys are a group of their own.
    """
    sums, maxima = sums or {}, maxima or {}
    # Keys and block as one struct: equal where both have nulls, and the join and the window share its partitioning.
    df = df.withColumn("_cell", F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], F.col(block).alias("block")))
    groups = [f"_cell.k{i}" for i in range(len(keys))]
    before = Window.partitionBy(*groups).orderBy("_cell.block").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("_cell").orderBy(*order)
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    ahead = inside.rowsBetween(Window.unboundedPreceding, -1)
    parts = df.groupBy("_cell").agg(
        *[F.sum(v).alias(f"_part_{n}") for n, v in sums.items()],
        *[F.max(v).alias(f"_part_{n}") for n, v in maxima.items()],
    )
    carry = parts.select(
        "_cell",
        *[F.sum(f"_part_{n}").over(before).alias(f"_carry_{n}") for n in sums],
        *[F.max(f"_part_{n}").over(before).alias(f"_carry_{n}") for n in maxima],
    )
    added = {n: F.coalesce(f"_carry_{n}", F.lit(0)) + F.sum(v).over(upto) for n, v in sums.items()}
    added |= {n: F.greatest(f"_carry_{n}", F.max(v).over(ahead)) for n, v in maxima.items()}
    return df.join(carry, "_cell").withColumns(added).drop("_cell", *[f"_carry_{n}" for n in added])
