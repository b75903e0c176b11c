"""Small helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import ship_package


def free_name(df: DataFrame, base: str) -> str:
    """A column name like ``base`` that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name = f"_{name}"
    return name


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema) -> DataFrame:
    """``fn`` for each Arrow batch; batches of no rows are passed over."""
    ship_package(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = fn(batch)
                if out is not None:
                    yield out

    return df.mapInArrow(run, schema)


def bounded_sample(rows: DataFrame, key: str, most: int) -> DataFrame:
    """At most ``most`` rows, those with the smallest hash of ``key``; ties are taken in the order of all columns.

    A cut of the hash at 1.2 times the wanted share comes first, so that what tasks send to be ordered is about as
    bounded as the sample, whatever their number.
    """
    order = F.pmod(F.xxhash64(key), F.lit(1 << 40))
    share = min(1.0, 1.2 * most / max(1, rows.count()))
    near = rows.withColumn("_order", order).where(F.col("_order") <= int(share * (1 << 40)))
    return near.orderBy("_order", *rows.columns).limit(most).drop("_order")
