"""Sums and covariances of a table of vectors, gathered where the rows lie.

A vector is an array of numbers. Tasks turn their rows into matrices of bounded size and send partial sums only; those
are added by a shuffle on the position, so the driver receives one row for each position or pair of positions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import ship_package

#: Entries of one matrix in a task: 16 MB of doubles.
TILE = 1 << 21


def as_doubles(vec: str) -> Column:
    return F.col(vec).cast("array<double>")


def usable(vec: str, limit: float = float("inf")) -> Column:
    """True where the vector has entries and all of them are numbers of absolute value below ``limit``, never null."""
    # NaN is above every number in comparisons.
    inside = F.forall(as_doubles(vec), lambda x: F.coalesce(F.abs(x) < F.lit(limit), F.lit(False)))
    return F.coalesce(inside & (F.size(vec) > 0), F.lit(False))


def usual_length(df: DataFrame, vec: str) -> int:
    """The most frequent length of the vectors, the larger one of equally frequent ones; 0 without rows."""
    first = df.groupBy(F.size(vec).alias("len")).count().orderBy(F.desc("count"), F.desc("len")).first()
    return first["len"] if first else 0


def tiles(vectors: pa.Array, dim: int) -> Iterator[tuple[int, np.ndarray]]:
    """The vectors of a batch, all of length ``dim``, as matrices of doubles with the index of their first row."""
    step = max(1, TILE // dim)
    for at in range(0, len(vectors), step):
        flat = vectors.slice(at, step).flatten().to_numpy(zero_copy_only=False)
        yield at, np.asarray(flat, np.float64).reshape(-1, dim)


def _gather(df: DataFrame, vec: str, dim: int, part: Callable[[np.ndarray], np.ndarray], finish, kind: str) -> np.ndarray:
    """Sum over all rows of ``part(matrix)``; a task adds its own first. ``finish`` turns a partial sum into Arrow."""
    ship_package(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for _, matrix in tiles(batch.column(0), dim):
                one = part(matrix)
                total = one if total is None else total + one
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total)), pa.int32()), finish(total)], ["pos", "s"])

    rows = df.select(as_doubles(vec).alias("v")).mapInArrow(run, f"pos int, s {kind}")
    got = {r["pos"]: r["s"] for r in rows.groupBy("pos").agg(F.sum("s").alias("s")).collect()}
    return np.array([got[i] for i in range(len(got))], dtype=object if kind != "double" else np.float64)


def sums(df: DataFrame, vec: str, dim: int, change: Callable[[np.ndarray], np.ndarray] = lambda m: m) -> np.ndarray:
    """Per position, the sum of the changed entries, as doubles."""
    return _gather(df, vec, dim, lambda m: change(m).sum(0), lambda s: pa.array(s, pa.float64()), "double")


def whole_sums(df: DataFrame, vec: str, dim: int, change: Callable[[np.ndarray], np.ndarray]) -> list[int]:
    """Per position, the exact sum of the entries that ``change`` turns into 64-bit integers."""
    def part(matrix: np.ndarray) -> np.ndarray:
        x = change(matrix)
        return (x >> 20).sum(0).astype(object) * (1 << 20) + (x & ((1 << 20) - 1)).sum(0).astype(object)

    finish = lambda s: pa.array([Decimal(v) for v in s], pa.decimal128(28, 0))
    return [int(v) for v in _gather(df, vec, dim, part, finish, "decimal(28,0)")]


def scatter(df: DataFrame, vec: str, dim: int, centred: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum over all rows of the outer product of the centred vector with itself; only its upper half is shuffled."""
    upper = np.triu_indices(dim)

    def part(matrix: np.ndarray) -> np.ndarray:
        rows = centred(matrix)
        return (rows.T @ rows)[upper]

    flat = _gather(df, vec, dim, part, lambda s: pa.array(s, pa.float64()), "double")
    out = np.zeros((dim, dim))
    if len(flat):
        out[upper] = flat
        out.T[upper] = flat
    return out
