"""Near-duplicate embeddings by cosine: vectors in the order of their principal components, compared tile by tile.

Unit vectors are centred on their mean and turned onto the eigenvectors of their covariance (over all rows), leading
ones first. Cosine follows from the distance of the turned vectors, so a pair is settled as soon as the product over
the leading dimensions, plus the product of the norms of what is left of both, cannot reach the threshold. Pairs that
are left after the last stage are decided by the cosine of the given vectors in double precision.

Which tiles meet is decided by the same order: vectors of a label are cut into cells along the leading components, and
a vector visits the other cells that a vector within reach could lie in. A cell with more vectors than a tile is cut
into tiles that its visitors meet one by one, so a task holds one tile and a batch of visitors, however large a label is.
Equal vectors of a label are one vector with a count. Tasks send counts of links and the edges of a spanning star for each
component that they see, not pairs.

Within a cell and its neighbours every pair is still looked at in its leading dimensions: the work grows with the square
of the largest label unless its vectors spread along the leading components.

Defined results. A vector links with nothing if it or its label is null, if it is empty, all zero, or holds a null or an
entry that is not finite; vectors of different length never link. Rows may repeat: each is another vector. Keys may be
null or repeated; a component is named by its smallest key that is not null (null if there is none) and a row is kept
if its key is that name. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import moments
from tidemark.llm.components import components
from tidemark.session import materialise, ship_package

#: What rounding may take from a bound: pairs this close below it go on to the exact cosine.
SLACK = 1e-9
#: Pairs whose next dimensions are gathered at a time.
PAIRS = 1 << 15


def unit(matrix: np.ndarray) -> np.ndarray:
    """Rows divided by their norms; the largest entry is taken out first, so no square leaves the doubles."""
    scaled = matrix / np.abs(matrix).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


@dataclass(frozen=True)
class Turn:
    """The mean of the unit vectors of one length, their principal axes (columns) and the spread along each."""

    mean: np.ndarray
    axes: np.ndarray
    spread: np.ndarray

    def __call__(self, units: np.ndarray) -> np.ndarray:
        """Vectors of another length are left as they are."""
        return (units - self.mean) @ self.axes if units.shape[1] == len(self.mean) else units

    def cuts(self, length: int, bits: int) -> list[np.ndarray]:
        """Where the leading axes are cut so that about ``2 ** bits`` cells of equal content arise.

        Each bit halves the bins of the axis whose bins are widest; bins are quantiles of a normal distribution.
        Only the work depends on how well it fits. Vectors of another length are not cut.
        """
        if length != len(self.mean):
            return []
        halved = np.zeros(length, int)
        for _ in range(bits):
            halved[np.argmax(self.spread / 2.0**halved)] += 1
        normal = NormalDist()
        steps = {k: np.array([normal.inv_cdf(i / 2**k) for i in range(1, 2**k)]) for k in set(halved.tolist())}
        last = int(np.flatnonzero(halved)[-1]) + 1 if bits else 0
        return [self.spread[i] * steps[int(halved[i])] for i in range(last)]


def fit_turn(df: DataFrame, vec: str) -> Turn:
    dim = moments.usual_length(df, vec)
    rows = df.where(F.size(vec) == dim)
    if dim == 0:
        return Turn(np.zeros(0), np.zeros((0, 0)), np.zeros(0))
    n = rows.count()
    mean = moments.sums(rows, vec, dim, unit) / n
    values, axes = np.linalg.eigh(moments.scatter(rows, vec, dim, lambda m: unit(m) - mean) / n)
    return Turn(mean, axes[:, ::-1], np.sqrt(np.maximum(values[::-1], 0)))


def cells(turned: np.ndarray, cuts: list[np.ndarray], reach: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The cell of each vector; and, as rows and cells, the cells with a higher number within ``reach`` of it."""
    n = len(turned)
    home, row, met, far = np.zeros(n, np.int64), np.arange(n), np.zeros(n, np.int64), np.zeros(n)
    for axis, edges in enumerate(cuts):
        low, high = np.concatenate([[-np.inf], edges]), np.concatenate([edges, [np.inf]])
        at = turned[:, axis]
        home = home * len(low) + np.searchsorted(edges, at, side="right")
        gaps = np.maximum(0, np.maximum(low[None, :] - at[row][:, None], at[row][:, None] - high[None, :]))
        total = far[:, None] + gaps * gaps
        which, bin_ = np.nonzero(total <= reach * reach + SLACK)
        row, met, far = row[which], met[which] * len(low) + bin_, total[which, bin_]
    above = met > home[row]
    return home, row[above], met[above]


def _placed(groups: DataFrame, turn: Turn, reach: float, tile: int) -> DataFrame:
    """Adds the vector's ``cell`` and the array ``met`` of higher cells that it visits."""
    ship_package(groups.sparkSession)
    schema = groups.withColumns({"cell": F.lit(0).cast("bigint"), "met": F.array(F.lit(0).cast("bigint"))}).drop("_n").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("len").to_numpy()
            bits = np.ceil(np.log2(np.maximum(1, batch.column("_n").to_numpy() / tile))).astype(int)
            for dim, bit in set(zip(length.tolist(), bits.tolist(), strict=True)):
                part = batch.filter(pa.array((length == dim) & (bits == bit)))
                cuts = turn.cuts(dim, bit)
                for at, matrix in moments.tiles(part.column("vec"), dim):
                    home, row, met = cells(turn(unit(matrix)), cuts, reach)
                    order = np.argsort(row, kind="stable")
                    ends = np.searchsorted(row[order], np.arange(len(matrix) + 1))
                    lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(met[order]))
                    kept = [part.column(c).slice(at, len(matrix)) for c in schema.names[:-2]]
                    yield pa.RecordBatch.from_arrays([*kept, pa.array(home), lists], names=schema.names)

    # A label may hold most rows: the table of label sizes is written, so its measured size decides how it is joined.
    sizes = materialise(groups.groupBy("label", "len").agg(F.count("*").alias("_n")), "embedding-labels")
    return groups.join(sizes, ["label", "len"]).mapInArrow(run, schema)


class _Side:
    """Vectors on one side of a comparison, with all that the stages need of them."""

    def __init__(self, vectors: np.ndarray, nodes: pa.Array, counts: np.ndarray, turn: Turn, stages: list[int]):
        self.vectors, self.nodes, self.counts = vectors, nodes, counts
        scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
        self.scaled, self.norms = scaled, np.sqrt((scaled * scaled).sum(1))
        self.turned = turn(scaled / self.norms[:, None])
        square = np.cumsum((self.turned * self.turned)[:, ::-1], axis=1)[:, ::-1]
        self.square = square[:, 0]
        self.rest = {s: np.sqrt(square[:, s]) if s < square.shape[1] else np.zeros(len(square)) for s in stages}
        self.degree = np.zeros(len(vectors), np.int64)


def _stages(dim: int) -> list[int]:
    """Numbers of leading dimensions after which pairs are given up: 8, 16, 32 and so on, at last all."""
    return [s for s in (8 << i for i in range(dim.bit_length())) if s < dim] + [dim]


def close_pairs(home: _Side, guest: _Side, rows: slice, least: float, stages: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Indices of pairs of ``home`` and ``guest[rows]`` whose cosine is at least ``least``."""
    # cos = 1 - |a - b|^2 / 2 for unit vectors, so a.b has to reach this.
    needed = least - SLACK - 1 + (home.square[:, None] + guest.square[None, rows]) / 2
    first = stages[0]
    product = home.turned[:, :first] @ guest.turned[rows, :first].T
    i, j = np.nonzero(product + home.rest[first][:, None] * guest.rest[first][None, rows] >= needed)
    found = []
    for at in range(0, len(i), PAIRS):
        a, b = i[at: at + PAIRS], j[at: at + PAIRS]
        part, b = product[a, b], b + (rows.start or 0)
        for low, high in zip(stages, stages[1:], strict=False):
            part = part + np.einsum("ij,ij->i", home.turned[a, low:high], guest.turned[b, low:high])
            bound = least - SLACK - 1 + (home.square[a] + guest.square[b]) / 2
            open_ = part + home.rest[high][a] * guest.rest[high][b] >= bound
            a, b, part = a[open_], b[open_], part[open_]
        cosine = np.einsum("ij,ij->i", home.scaled[a], guest.scaled[b]) / (home.norms[a] * guest.norms[b])
        found.append((a[cosine >= least], b[cosine >= least]))
    if not found:
        return i, j
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def stars(a: np.ndarray, b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges from each index below ``n`` that has a link to the smallest index it reaches over the links ``a, b``."""
    low = np.arange(n)
    while True:
        least = np.minimum(low[a], low[b])
        new = low.copy()
        for side in (a, b, low[a], low[b]):
            np.minimum.at(new, side, least)
        new = new[new]
        if (new == low).all():
            break
        low = new
    moved = np.flatnonzero(low != np.arange(n))
    return moved, low[moved]


def _met(turn: Turn, least: float, schema, wide: int = 1 << 19):
    """Counts of links and star edges for each run of equal (label, len, cell, tile); rows come sorted, homes first."""

    def edges(home: _Side, guest: _Side, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch | None:
        if home is guest:
            src, dst = stars(a, b, len(home.counts))
            nodes = home.nodes
        else:
            src, dst = stars(a, b + len(home.counts), len(home.counts) + len(guest.counts))
            nodes = pa.concat_arrays([home.nodes, guest.nodes])
        if not len(src):
            return None
        return pa.RecordBatch.from_arrays(
            [nodes.take(pa.array(src)), nodes.take(pa.array(dst)), pa.array(np.zeros(len(src), np.int64))], names=schema.names
        )

    def compare(home: _Side, guest: _Side) -> Iterator[pa.RecordBatch]:
        stages, step = _stages(home.vectors.shape[1]), max(1, wide // len(home.counts))
        for at in range(0, len(guest.counts), step):
            a, b = close_pairs(home, guest, slice(at, at + step), least, stages)
            if home is guest:
                a, b = a[a < b], b[a < b]
            np.add.at(home.degree, a, guest.counts[b])
            np.add.at(guest.degree, b, home.counts[a])
            out = edges(home, guest, a, b)
            if out is not None:
                yield out

    def degrees(side: _Side) -> Iterator[pa.RecordBatch]:
        some = np.flatnonzero(side.degree)
        if len(some):
            nodes = side.nodes.take(pa.array(some))
            yield pa.RecordBatch.from_arrays(
                [nodes, pa.nulls(len(some), nodes.type), pa.array(side.degree[some])], names=schema.names
            )

    def settle(home: _Side | None) -> Iterator[pa.RecordBatch]:
        """A tile that all its visitors have met: its vectors among themselves, and their counts."""
        if home is not None:
            yield from compare(home, home)
            yield from degrees(home)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, parts, home = None, [], None

        def _side(batch: pa.RecordBatch) -> _Side:
            dim = batch.column("len")[0].as_py()
            matrix = np.concatenate([m for _, m in moments.tiles(batch.column("vec"), dim)])
            return _Side(matrix, batch.column("node"), batch.column("n").to_numpy(), turn, _stages(dim))

        def at_home() -> _Side | None:
            """The vectors of a tile whose last home has come; a tile may have visitors only."""
            return _side(pa.Table.from_batches(parts).combine_chunks().to_batches()[0]) if parts else None

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy() for c in ("_label", "len", "cell", "tile")])
            cut = np.flatnonzero((np.diff(keys) != 0).any(0)) + 1
            guest = batch.column("guest").to_numpy(zero_copy_only=False)
            for a, b in zip([0, *cut.tolist()], [*cut.tolist(), batch.num_rows], strict=True):
                now = tuple(keys[:, a].tolist())
                if now != group:
                    yield from settle(home or at_home())
                    group, parts, home = now, [], None
                split = a + int(np.searchsorted(guest[a:b], 1))
                if split > a:
                    parts.append(batch.slice(a, split - a))
                if b > split:
                    home = home or at_home()
                    if home is not None:
                        visitors = _side(batch.slice(split, b - split))
                        yield from compare(home, visitors)
                        yield from degrees(visitors)
        yield from settle(home or at_home())

    return run


def links(groups: DataFrame, turn: Turn, threshold: float = 0.98, tile: int = 2048) -> DataFrame:
    """Rows ``a, b, n``: links of ``a`` (``b`` null, ``n`` counts them in part), or an edge of a component (``n`` 0).

    ``groups``: ``label, len, vec, node, n`` with each vector of a label once. ``tile`` is the number of vectors that
    a task holds at a time, about.
    """
    reach = float(np.sqrt(max(0.0, 2 - 2 * threshold)))
    placed = materialise(_placed(groups, turn, reach, tile), "embedding-cells")
    spot = ["label", "len", "cell"]
    sizes = materialise(
        placed.groupBy(*spot).agg(F.ceil(F.count("*") / tile).cast("int").alias("_tiles")), "embedding-tiles"
    )
    own = F.pmod(F.xxhash64("node"), F.col("_tiles")).cast("int")
    kept = ["_tiles", *spot, "vec", "node", "n"]
    home = placed.join(sizes, spot).select(*kept, own.alias("tile"), F.lit(0).alias("guest"))
    # Within a cell, a vector visits the tiles after its own.
    beside = home.withColumn("tile", F.explode(F.filter(F.sequence(F.lit(0), F.col("_tiles")), lambda t: (t > F.col("tile")) & (t < F.col("_tiles")))))
    away = placed.select("label", "len", F.explode("met").alias("cell"), "vec", "node", "n").join(sizes, spot)
    away = away.select(*kept, F.explode(F.sequence(F.lit(0), F.col("_tiles") - 1)).alias("tile"))
    guests = beside.drop("guest").unionByName(away).withColumn("guest", F.lit(1))
    every = home.unionByName(guests).drop("_tiles")
    where = ["label", "len", "cell", "tile"]
    dealt = every.repartition(*where).sortWithinPartitions(*where, "guest")
    # Labels may be of any type: within a task a run is known by the label's hash beside its neighbours in the sort.
    slim = dealt.select(F.xxhash64("label").alias("_label"), "len", "cell", "tile", "guest", "vec", "node", "n")
    schema = groups.select(F.col("node").alias("a"), F.col("node").alias("b"), "n").schema
    return slim.mapInArrow(_met(turn, threshold, schema), schema)


def near_duplicates(
    df: DataFrame, key: str = "vec_id", vec: str = "embedding", label: str = "label", threshold: float = 0.98, tile: int = 2048
) -> DataFrame:
    """``key, n_links, component_id, kept``, one row per row of ``df``."""
    rows = df.select(F.col(key).alias("_key"), moments.as_doubles(vec).alias("vec"), F.col(label).alias("label"))
    compared = moments.usable("vec") & F.col("label").isNotNull() & F.exists("vec", lambda x: x != 0)
    first = F.min(F.struct(F.col("_key").isNull().alias("none"), F.col("_key").alias("id")))
    groups = rows.where(compared).groupBy("label", "vec").agg(F.count("*").alias("n"), first.alias("_first"))
    # A node sorts by its smallest key; the number tells vectors of equal keys apart.
    node = F.struct("_first.none", "_first.id", F.monotonically_increasing_id().alias("at"))
    groups = materialise(groups.select("label", F.size("vec").alias("len"), "vec", "n", node.alias("node")), "embedding-groups")
    found = materialise(links(groups, fit_turn(groups, "vec"), threshold, tile), "embedding-links")
    named = components(found.where("b is not null").select("a", "b"), "a", "b")
    degree = found.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("_links"))
    known = groups.join(degree, "node", "left").join(named, "node", "left").select(
        "label", "vec", (F.coalesce("_links", F.lit(0)) + F.col("n") - 1).alias("_links"),
        F.coalesce("component", "node")["id"].alias("_component"), F.lit(True).alias("_known"),
    )
    out = rows.where(compared).join(known, ["label", "vec"]).select("_key", "_links", "_component")
    alone = rows.where(~compared).select("_key", F.lit(0).cast("bigint").alias("_links"), F.col("_key").alias("_component"))
    return out.unionByName(alone).select(
        F.col("_key").alias(key), F.col("_links").alias("n_links"), F.col("_component").alias("component_id"),
        F.col("_key").eqNullSafe(F.col("_component")).alias("kept"),
    )
