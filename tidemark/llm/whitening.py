"""Whitening of embeddings: projections on the leading eigenvectors of their covariance, each of variance one.

Entries become integers ``x = floor(1024 * c) + 100000``, so counts, sums and deviations are exact whatever the order in
which tasks end. The covariance is gathered in one pass of centred rows; its eigenvectors are those of ``eigen``:
single precision, refined by matrix products in higher precision. The driver holds the covariance, so memory there grows
with the square of the dimension and not with the rows.

Defined results. Rows are left out whose vector is null or empty, holds a null or an entry that is not finite (or too
large for a 64-bit integer), or is not of the most frequent length (the larger one of equally frequent ones). Keys may
be null or repeated: each row stands for itself. Components with no variance (all rows equal, say) are null. An empty
table gives no rows. Other columns are kept; new ones get free names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import moments
from tidemark.llm.eigen import eigenpairs
from tidemark.llm.frames import free_name
from tidemark.session import materialise, ship_package

STEPS, SHIFT = 1024, 100_000
#: Above it ``floor(1024 * c) + 100000`` leaves the integers that doubles and 64 bits both hold.
LIMIT = 2.0**52
DEVIATION = 10**38


def whole(matrix: np.ndarray) -> np.ndarray:
    return np.floor(STEPS * matrix).astype(np.int64) + SHIFT


@dataclass(frozen=True)
class Whitening:
    """Length, rows and exact sums of the fit list; the leading eigenvalues and eigenvectors; the trace."""

    dim: int
    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def live(self) -> int:
        """Number of components whose variance is above the rounding of the largest."""
        return int((self.values > self.dim * np.finfo(float).eps * max(self.values, default=0)).sum())

    def offsets(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``x - S/n`` as doubles, and its exact parts: ``x - S // n`` and the remainders of ``S / n``."""
        low = x - np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([s % self.n for s in self.sums], np.int64)
        return low - rest / self.n, low, rest


def _rows(df: DataFrame, vec: str, dim: int | None = None) -> DataFrame:
    good = df.where(moments.usable(vec, LIMIT))
    return good if dim is None else good.where(F.size(vec) == dim)


def fit(df: DataFrame, vec: str, most: int = 8) -> Whitening:
    """Eigenvectors of the covariance (divisor n) over all usable rows."""
    dim = moments.usual_length(_rows(df, vec), vec)
    if dim == 0:
        return Whitening(0, 0, [], np.zeros(0), np.zeros((0, 0)), 0.0)
    rows = _rows(df, vec, dim)
    n, *total = moments.whole_sums(
        rows.select(F.concat(F.array(F.lit(0.0)), moments.as_doubles(vec)).alias("v")), "v", dim + 1,
        lambda m: np.concatenate([np.ones((len(m), 1), np.int64), whole(m[:, 1:])], axis=1),
    )
    start = Whitening(dim, n, total, np.zeros(0), np.zeros((dim, 0)), 0.0)
    covariance = moments.scatter(rows, vec, dim, lambda m: start.offsets(whole(m))[0]) / n
    values, vectors = eigenpairs(covariance)
    return Whitening(dim, n, total, values[:most], vectors[:, :most], float(np.trace(covariance)))


def deviations(low: np.ndarray, rest: np.ndarray, n: int) -> list[int]:
    """Per row, the exact sum over the dimensions of ``(n * low - rest) ** 2``."""
    if np.abs(low).max(initial=0) >= 1 << 24:
        return ((low.astype(object) * n - rest.astype(object)) ** 2).sum(1).tolist()
    square = (low * low).sum(1).astype(object)
    mixed = (low @ (rest >> 20)).astype(object) * (1 << 20) + (low @ (rest & ((1 << 20) - 1))).astype(object)
    return (n * n * square - 2 * n * mixed + sum(int(r) ** 2 for r in rest)).tolist()


def whiten(df: DataFrame, vec: str, model: Whitening) -> tuple[DataFrame, str, str]:
    """The usable rows with two new columns, and their names: the whitened array, and the exact deviation.

    The array has an entry for each component of the model, null where the component has no variance. The deviation
    is the squared distance from the mean times ``n * n``, null where it has more than 38 digits.
    """
    ship_package(df.sparkSession)
    white = free_name(df, "whitened")
    far = free_name(df.withColumn(white, F.lit(0)), "deviation")
    given = free_name(df, "_vector")
    schema = df.withColumns({white: F.lit(None).cast("array<double>"), far: F.lit(None).cast("decimal(38,0)")}).schema
    live, width = model.live, len(model.values)
    turn = model.vectors[:, :live] / np.sqrt(model.values[:live])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, matrix in moments.tiles(batch.column(batch.num_columns - 1), model.dim):
                centred, low, rest = model.offsets(whole(matrix))
                out = np.zeros((len(matrix), width))
                out[:, :live] = centred @ turn
                dead = np.tile(np.arange(width) >= live, len(matrix))
                ends = pa.array(np.arange(len(matrix) + 1) * width, pa.int32())
                arrays = pa.ListArray.from_arrays(ends, pa.array(out.ravel(), pa.float64(), mask=dead))
                exact = [Decimal(v) if v < DEVIATION else None for v in deviations(low, rest, model.n)]
                kept = batch.slice(at, len(matrix)).columns[:-1]
                yield pa.RecordBatch.from_arrays(
                    [*kept, arrays, pa.array(exact, pa.decimal128(38, 0))], names=schema.names
                )

    rows = _rows(df, vec, model.dim).withColumn(given, moments.as_doubles(vec))
    return rows.mapInArrow(run, schema), white, far


def identity_error(whitened: DataFrame, column: str, live: int) -> float | None:
    """Largest absolute entry of the covariance of the first ``live`` whitened entries minus the identity."""
    if live == 0:
        return None
    rows = whitened.select(F.slice(column, 1, live).alias("v"))
    n = rows.count()
    mean = moments.sums(rows, "v", live) / n
    covariance = moments.scatter(rows, "v", live, lambda m: m - mean) / n
    return float(np.abs(covariance - np.eye(live)).max())


def whitened_components(df: DataFrame, key: str, vec: str, most: int = 8) -> DataFrame:
    """One row per usable row and component: ``key, component, n, deviation, whitened, explained, identity_error``.

    ``deviation`` is a decimal of 38 digits. The whitened rows are written once and measured as written.
    """
    model = fit(df.select(vec), vec, most)
    rows, white, far = whiten(df.select(key, vec), vec, model)
    rows = materialise(rows.select(F.col(key).alias("_key"), F.col(far).alias("_far"), F.col(white).alias("_white")), "whitened")
    error = identity_error(rows, "_white", model.live)
    shares = [float(v) / model.trace if model.trace > 0 else None for v in model.values]
    parts = F.posexplode(F.arrays_zip(F.col("_white").alias("w"), F.array(*[F.lit(s) for s in shares]).alias("s")))
    flat = rows.select("_key", "_far", parts.alias("_at", "_one"))
    return flat.select(
        F.col("_key").alias(key), (F.col("_at") + 1).alias("component"), F.lit(model.n).cast("bigint").alias("n"),
        F.col("_far").alias("deviation"), F.col("_one.w").alias("whitened"),
        F.col("_one.s").cast("double").alias("explained"), F.lit(error).cast("double").alias("identity_error"),
    )
