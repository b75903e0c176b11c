"""Multinomial logistic regression over sparse rows, with memory that depends on the model and not on the rows.

The objective is that of Spark's ``LogisticRegression``: mean weighted loss and a penalty on the weights as they are, with free
intercepts. Three things differ. Rows are kept as blocks of plain arrays, which tasks read one at a time. Columns that are
equal in all rows have equal weights at every point of the search, so each such group is one coordinate, scaled so that
lengths and angles stay. And the search is in the weights themselves; Spark's divides columns by their spread, which makes the
penalty of rare tokens steep and the search long.
"""

from __future__ import annotations

import pickle
import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.common import _py2java
from pyspark.ml.linalg import DenseMatrix, DenseVector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import ship_package

ENTRIES = 1 << 20  # of a block, so that a task holds a few dozen MB of rows
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = 500  # rows of long texts have thousands of entries each
COLLECTED = 32 << 20  # bytes that all tasks together may send to the driver; more are summed in tasks first
HISTORY = 10  # steps that the search remembers
IN_MEMORY = 64 << 20  # bytes of these steps that the driver holds in memory; more go to a file


def _rows(batch: pa.RecordBatch, size: int) -> tuple[np.ndarray, ...]:
    """Lengths, indices and values of the rows' features, and the weight of each class; dense rows give all their places."""
    vector = batch.column(0)
    dense = vector.field(0).to_numpy(zero_copy_only=False) == 1
    weights = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
    values = vector.field(3)
    lengths = values.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    at = vector.field(2)
    if not dense.any():
        return lengths, at.flatten().to_numpy(zero_copy_only=False), values.flatten().to_numpy(zero_copy_only=False), weights
    every = [np.arange(size, dtype=np.int32) if d else at[i].values.to_numpy(zero_copy_only=False) for i, d in enumerate(dense)]
    return lengths, np.concatenate(every), values.flatten().to_numpy(zero_copy_only=False), weights


def _blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[np.ndarray, ...]]:
    """The rows in blocks of about ``ENTRIES`` entries, without those that weigh nothing."""
    held, n = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(_rows(batch, size))
            n += len(held[-1][1])
        if n >= ENTRIES:
            yield tuple(map(np.concatenate, zip(*held)))
            held, n = [], 0
    if held:
        yield tuple(map(np.concatenate, zip(*held)))


def _mixed(x: np.ndarray) -> np.ndarray:
    """64-bit words well mixed (the last step of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _added(into: np.ndarray, at: np.ndarray, what: np.ndarray) -> None:
    """Adds up words, modulo 2^64, by halves that a sum of doubles holds exactly."""
    low, high = what & np.uint64(0xFFFFFFFF), what >> np.uint64(32)
    into += np.bincount(at, low.astype(float), len(into)).astype(np.uint64)
    into += np.bincount(at, high.astype(float), len(into)).astype(np.uint64) << np.uint64(32)


def _statistics(batches: Iterator[pa.RecordBatch], size: int, classes: int, task: int) -> list[np.ndarray]:
    """By column the sums of two hashes of (row, value); the classes' weights; the number of rows."""
    marks, total, n = (np.zeros(size, np.uint64), np.zeros(size, np.uint64)), np.zeros(classes), 0
    for lengths, at, x, t in _blocks(batches, size):
        row = np.repeat(np.arange(n, n + len(lengths), dtype=np.uint64) + (np.uint64(task + 1) << np.uint64(40)), lengths)
        bits, there = (x + 0.0).view(np.uint64), x != 0
        for k, mark in enumerate(marks):
            _added(mark, at[there], _mixed(_mixed(row + np.uint64(0x9E3779B97F4A7C15 + k)) ^ bits)[there])
        total += t.sum(axis=0)
        n += len(lengths)
    return [*marks, total, np.array([float(n)])]


def _gradient(blocks: Iterator[tuple], weights: np.ndarray, offset: np.ndarray) -> tuple[np.ndarray, ...]:
    """Loss and its derivatives by class score summed over the rows; the columns that occur; the derivatives by their weights.

    Blocks number columns in the order in which their task meets them and bring those that are new.
    """
    classes, columns = weights.shape
    held, slopes, met, m = np.empty((classes, columns)), np.zeros((classes, columns)), [], 0
    sums = np.zeros(classes + 1)
    for new, lengths, at, x, t in blocks:
        met.append(new)
        held[:, m : m + len(new)] = weights[:, new]
        m += len(new)
        at, x = at.astype(np.int64), x.astype(float)
        full = lengths > 0
        starts = np.concatenate([[0], np.cumsum(lengths[full], dtype=np.int64)])[:-1]
        z = np.zeros((classes, len(lengths)))
        for k in range(classes):
            if len(starts):
                z[k, full] = np.add.reduceat(held[k, :m].take(at) * x, starts)
            z[k] += offset[k]
        top = z.max(axis=0)
        e = np.exp(z - top)
        total = e.sum(axis=0)
        s = t.sum(axis=1)
        sums[-1] += float((s * (np.log(total) + top)).sum() - (t.T * z).sum())
        slope = e / total * s - t.T
        sums[:-1] += slope.sum(axis=1)
        for k in range(classes):
            slopes[k, :m] += np.bincount(at, np.repeat(slope[k], lengths) * x, m)
    return sums, np.concatenate([np.zeros(0, np.int32), *met]), slopes[:, :m]


def _summed(rdd, task: Callable[[int, Iterator], list[np.ndarray]]) -> list[np.ndarray]:
    """Element by element sums of the arrays that every task gives, summed by pieces in tasks and then gathered."""
    tasks = rdd.getNumPartitions()

    def cut(i, rows):
        for a, array in enumerate(task(i, rows)):
            pieces = np.array_split(array, tasks) if len(array) >= 1024 else [array]
            for p, piece in enumerate(pieces):
                yield (a, p), piece

    def added(rows):
        sums = {}
        for key, piece in rows:
            if key in sums:
                sums[key] += piece
            else:
                sums[key] = piece.copy()
        return list(sums.items())

    dealt = rdd.mapPartitionsWithIndex(cut).partitionBy(tasks, lambda key: key[1])
    pieces = dict(dealt.mapPartitions(added).collect())
    # Else the files of every evaluation stay until the driver happens to collect its garbage.
    shuffled = dealt._jrdd.rdd().dependencies().apply(0).rdd().dependencies().apply(0)
    rdd.context._jsc.sc().cleaner().get().doCleanupShuffle(shuffled.shuffleId(), True)
    arrays = range(1 + max(a for a, _ in pieces))
    return [np.concatenate([pieces.pop((a, p)) for p in range(tasks) if (a, p) in pieces]) for a in arrays]


class Examples:
    """Rows ready to be fitted, any number of times, until ``free`` is called.

    ``data``: ``features``, vectors of one length, and ``t``, the weight of each class for the row. A missing weight is an error.
    """

    def __init__(self, data: DataFrame) -> None:
        spark = data.sparkSession
        ship_package(spark)
        self.context, self.data = spark.sparkContext, data
        before = spark.conf.get(BATCH)
        spark.conf.set(BATCH, str(BATCH_ROWS))
        try:
            self._prepare(data.select(F.unwrap_udt("features").alias("features"), F.col("t").cast("array<double>").alias("t")))
        finally:
            spark.conf.set(BATCH, before)

    def _prepare(self, rows: DataFrame) -> None:
        first = self.data.select("features", F.size("t").alias("k")).first()
        self.size, classes = (first["features"].size, first["k"]) if first else (0, 0)
        if not first:
            raise ValueError("no rows to fit")
        size = self.size

        def measured(batches):
            from pyspark import TaskContext

            yield pa.RecordBatch.from_pylist([{"b": pickle.dumps(x, 5)} for x in _statistics(batches, size, classes, TaskContext.get().partitionId())])

        parts = rows.mapInArrow(measured, "b binary").rdd
        a, b, self.per_class, n = _summed(parts, lambda _, rows: [pickle.loads(r[0]) for r in rows])
        self.n, self.weight = int(n[0]), float(self.per_class.sum())
        self.classes = int(np.flatnonzero(self.per_class)[-1]) + 1 if self.per_class.any() else 0
        # Columns without a value have no weight.
        self.live = np.flatnonzero(a | b)
        marks = np.stack([a, b], axis=1)[self.live].view([("a", np.uint64), ("b", np.uint64)]).ravel()
        _, first, self.group, times = np.unique(marks, return_index=True, return_inverse=True, return_counts=True)
        self.scale = np.sqrt(times)
        place = np.full(size, -1, np.int32)
        place[self.live[first]] = np.arange(len(first), dtype=np.int32)
        self.shared = shared = self.context.broadcast((place, self.scale))
        classes = self.classes

        def built(batches):
            place, scale = shared.value
            number, m = np.full(len(scale), -1, np.int32), 0
            for lengths, at, x, t in _blocks(batches, size):
                column = place[at]
                kept = (column >= 0) & (x != 0)
                row = np.repeat(np.arange(len(lengths)), lengths)[kept]
                column = column[kept]
                new = np.unique(column)
                new = new[number[new] < 0]
                number[new] = np.arange(m, m + len(new), dtype=np.int32)
                m += len(new)
                block = new, np.bincount(row, minlength=len(lengths)), number[column], x[kept] * scale[column], np.ascontiguousarray(t[:, :classes])
                yield pa.RecordBatch.from_pylist([{"b": pickle.dumps(block, 5)}])

        # Blocks are larger than a batch of the picklers, so they come one at a time; what memory can't hold goes to disk.
        blocks = rows.mapInArrow(built, "b binary").rdd.mapPartitions(lambda rows: (pickle.loads(r[0]) for r in rows))
        self.rows = blocks.persist(StorageLevel.MEMORY_AND_DISK)

    def loss(self, penalty: float) -> Callable[[np.ndarray], tuple[float, np.ndarray]]:
        """Value and gradient at a point: the weights, class by class, then the intercepts."""
        k, columns = self.classes, len(self.scale)

        def at(point: np.ndarray) -> tuple[float, np.ndarray]:
            weights = point[:-k].reshape(k, columns)
            shared = self.context.broadcast((weights, point[-k:]))
            out = np.zeros(len(point))
            slopes = out[:-k].reshape(k, columns)
            if 8 * len(point) * self.rows.getNumPartitions() <= COLLECTED:
                sums = np.zeros(k + 1)
                for own, met, part in self.rows.mapPartitions(lambda rows: [_gradient(rows, *shared.value)]).collect():
                    sums += own
                    for i in range(k):
                        slopes[i, met] += part[i]
            else:

                def spread(_, rows):
                    own, met, part = _gradient(rows, *shared.value)
                    for i in range(k):
                        row = np.zeros(columns)
                        row[met] = part[i]
                        yield row
                    yield own

                *parts, sums = _summed(self.rows, spread)
                for i in range(k):
                    slopes[i] = parts[i]
            shared.destroy()
            out[-k:] = sums[:-1]
            out /= self.weight
            for i in range(k):
                slopes[i] += penalty * weights[i]
            return float(sums[-1]) / self.weight + 0.5 * penalty * float(point[:-k] @ point[:-k]), out

        return at

    def free(self) -> None:
        self.rows.unpersist()
        self.shared.destroy()


class Regression:
    """An estimator of ``Examples``, or of the table that they are made of."""

    def __init__(self, penalty: float, max_iter: int, tol: float) -> None:
        self.penalty, self.max_iter, self.tol = penalty, max_iter, tol

    def fit(self, data: DataFrame | Examples) -> LogisticRegressionModel:
        examples = data if isinstance(data, Examples) else Examples(data)
        try:
            return self._fit(examples)
        finally:
            if examples is not data:
                examples.free()

    def _fit(self, examples: Examples) -> LogisticRegressionModel:
        k, columns = examples.classes, len(examples.scale)
        if np.count_nonzero(examples.per_class) == 1:
            # One class only: nothing to weigh, and it is certain.
            intercepts = np.zeros(k)
            intercepts[-1] = np.inf
            return self._model(examples, np.zeros((k, examples.size)), intercepts)
        start = np.zeros(k * columns + k)
        logs = np.log1p(examples.per_class[:k])
        start[-k:] = logs - logs.mean()
        point = minimum(examples.loss(self.penalty), start, self.max_iter, self.tol)
        out = np.zeros((k, examples.size))
        for i, weights in enumerate(point[:-k].reshape(k, columns)):
            out[i, examples.live] = (weights / examples.scale)[examples.group]
        return self._model(examples, out, point[-k:] - point[-k:].mean())

    def _model(self, examples: Examples, weights: np.ndarray, intercepts: np.ndarray) -> LogisticRegressionModel:
        context, k = examples.context, examples.classes
        jvm = context._jvm
        matrix = _py2java(context, DenseMatrix(k, examples.size, weights.ravel(order="F"))).compressed()
        made = jvm.org.apache.spark.ml.classification.LogisticRegressionModel(
            jvm.org.apache.spark.ml.util.Identifiable.randomUID("logreg"), matrix, _py2java(context, DenseVector(intercepts)), k, True
        )
        return LogisticRegressionModel(made)


class SearchFailed(Exception):
    """No step along a direction that is good enough."""


def minimum(loss: Callable[[np.ndarray], tuple[float, np.ndarray]], start: np.ndarray, max_iter: int, tol: float) -> np.ndarray:
    """The point that L-BFGS comes to.

    It stops after ``max_iter`` steps, when twenty steps gain less than ``tol`` of the first value, or when the gradient is
    no longer than a hundredth of ``tol`` of the value. A line search that fails forgets the steps; one that fails again ends the search.
    """
    point, (value, slope) = start, loss(start)
    first, recent, steps, failed, n = value, [np.inf], _Steps(len(start)), False, 0
    while n != max_iter or max_iter < 0:
        if abs(value - max(recent)) <= tol * abs(first):
            break
        if np.linalg.norm(slope) <= max(0.01 * tol * abs(value), 1e-8):
            break
        try:
            way = steps.direction(slope)
            length, value_new, point_new, slope_new = _searched(loss, point, value, slope, way, 1.0 / np.linalg.norm(way) if n == 0 else 1.0)
            if length * np.linalg.norm(slope) < 1e-10:
                raise SearchFailed("the step is too short")
        except SearchFailed:
            if failed:
                break
            failed = True
            steps.forget()
            continue
        failed = False
        np.subtract(point_new, point, out=point)
        slope *= -1.0
        slope += slope_new
        steps.add(point, slope)
        point, value, slope, n = point_new, value_new, slope_new, n + 1
        recent = [*recent, value][-20:]
    return point


class _Steps:
    """The last steps and changes of the gradient; in a file of the driver's temporary folder when they are large."""

    def __init__(self, size: int) -> None:
        shape = (2 * HISTORY, size)
        if 16 * HISTORY * size <= IN_MEMORY:
            self.kept = np.zeros(shape)
        else:
            self.file = tempfile.TemporaryFile()  # noqa: SIM115
            self.kept = np.memmap(self.file, float, "w+", shape=shape)
        self.products = np.zeros((2 * HISTORY, 2 * HISTORY))
        self.order: list[int] = []  # newest first

    def forget(self) -> None:
        self.order = []

    def add(self, step: np.ndarray, change: np.ndarray) -> None:
        at = self.order.pop() if len(self.order) == HISTORY else len(self.order)
        self.order.insert(0, at)
        for i, row in ((at, step), (at + HISTORY, change)):
            self.kept[i] = row
            self.products[i] = self.products[:, i] = self.kept @ row

    def direction(self, slope: np.ndarray) -> np.ndarray:
        """The recursion over the steps, on products of the kept rows, so that each row is read twice."""
        if not self.order:
            return -slope
        new, g, p = self.order[0], self.kept @ slope, self.products
        along = p[new, new + HISTORY]
        if along <= 0 or np.isnan(along):
            raise SearchFailed("the steps are no use")
        scale = along / p[new + HISTORY, new + HISTORY]
        shares = np.zeros(2 * HISTORY)  # of the rows in the direction
        for i in self.order:
            shares[i + HISTORY] = -(g[i] + p[i] @ shares) / p[i, i + HISTORY]
        along = scale * (g + p @ shares)
        lost = shares * scale
        for i in reversed(self.order):
            lost[i] -= shares[i + HISTORY] + (along[i + HISTORY] + p[i + HISTORY, :HISTORY] @ lost[:HISTORY]) / p[i, i + HISTORY]
        out = lost @ self.kept
        out += scale * slope
        out *= -1.0
        return out


def _searched(loss, point, value, slope, way, t) -> tuple[float, float, np.ndarray, np.ndarray]:
    """Length, value, point and gradient of a step that meets the strong Wolfe conditions (cubic interpolation)."""
    steep = float(slope @ way)
    if steep > 0:
        raise SearchFailed("the direction does not descend")
    last = None

    def tried(t: float) -> tuple[float, float, float]:
        nonlocal last
        there = way * t
        there += point
        f, g = loss(there)
        last = t, f, there, g
        return t, float(g @ way), f

    def between(a, b) -> float:
        (at, ad, af), (bt, bd, bf) = a, b
        d1 = ad + bd - 3 * (af - bf) / (at - bt)
        d2 = np.sqrt(max(d1 * d1 - ad * bd, 0.0)) if d1 * d1 >= ad * bd else np.nan
        t = bt - (bt - at) * (bd + d2 - d1) / (bd - ad + 2 * d2)
        low, high = at + 0.1 * (bt - at), at + 0.9 * (bt - at)
        return low if t < low else high if t > high else t

    def zoomed(low, high):
        for _ in range(10):
            c = tried(between(high, low) if low[0] > high[0] else between(low, high))
            if c[2] > value + 1e-4 * c[0] * steep or c[2] >= low[2]:
                high = c
            else:
                if abs(c[1]) <= 0.9 * abs(steep):
                    return last
                if c[1] * (high[0] - low[0]) >= 0:
                    high = low
                low = c
        raise SearchFailed("no step was found between two others")

    low = 0.0, steep, value
    for i in range(10):
        c = tried(t)
        if not np.isfinite(c[2]):
            t /= 2.0
            continue
        if c[2] > value + 1e-4 * t * steep or (c[2] >= low[2] and i > 0):
            return zoomed(low, c)
        if abs(c[1]) <= 0.9 * abs(steep):
            return last
        if c[1] >= 0:
            return zoomed(c, low)
        low = c
        t *= 1.5
    raise SearchFailed("no step is long enough")
