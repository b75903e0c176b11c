"""Near-duplicates by the sets of word shingles: all pairs whose Jaccard similarity reaches a limit.

A text is the set of its ``width``-word shingles, as hashes. Texts of equal sets are one. Candidates come from min-hash
bands: 40 bands of 5 values, so a pair at 0.8 shares no band with probability (1 - 0.8^5)^40 = 1.2e-7, whatever its
length, and nearer pairs less often. Candidates are linked only if the exact Jaccard of their sets reaches the limit.

In a band many near copies may share they are first compared along two random orders, a few comparisons for each.
Only where a band then still holds several components are their members compared across components, tile by tile.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.frames import map_batches
from tidemark.llm.simhash import SEED, shingle_hashes
from tidemark.session import materialise, ship_package

BANDS, ROWS = 40, 5
TILE = 2000  # members of a band that are put in order by one task
TILE_HASHES = 1 << 19  # shingle hashes that a task holds of the members it compares others with: 4 MB
_random = np.random.default_rng(SEED)
_FACTORS = _random.integers(0, 2**64, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)
_TERMS = _random.integers(0, 2**64, BANDS * ROWS, dtype=np.uint64)
_MIX = _random.integers(0, 2**64, (BANDS, ROWS), dtype=np.uint64) | np.uint64(1)


def shingle_set(text: str | None, width: int) -> np.ndarray:
    return np.unique(shingle_hashes(text, width))


def bands(own: np.ndarray, slice_rows: int = 1024) -> np.ndarray:
    """The band keys of a set; an empty one has none."""
    if not len(own):
        return np.empty(0, np.int64)
    low = np.full(BANDS * ROWS, np.uint64(2**64 - 1))
    for at in range(0, len(own), slice_rows):
        low = np.minimum(low, (own[at: at + slice_rows, None] * _FACTORS + _TERMS).min(axis=0))
    keys = ((low.reshape(BANDS, ROWS) ^ (low.reshape(BANDS, ROWS) >> np.uint64(31))) * _MIX).sum(axis=1, dtype=np.uint64)
    return (keys ^ (keys >> np.uint64(29))).view(np.int64)


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Of two sorted sets without repeats; two empty sets are equal."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    union = len(a) + len(b) - both
    return both / union if union else 1.0


def _digest(own: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(own.tobytes())).view(np.int64))


def _sketches(texts: DataFrame, key: str, text: str, width: int) -> DataFrame:
    """``key, set, size, bands`` of each row."""

    def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
        names, sizes, keys = [], [], []
        for value in batch.column(1):
            own = shingle_set(value.as_py(), width)
            names.append(_digest(own))
            sizes.append(len(own))
            keys.append(bands(own))
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(names, pa.int64()), pa.array(sizes, pa.int64()), pa.array(keys, pa.list_(pa.int64()))],
            [key, "set", "size", "bands"],
        )

    kind = texts.schema[key].dataType.simpleString()
    rows = texts.select(F.col(key), F.col(text).cast("string"))
    return map_batches(rows, fn, f"`{key}` {kind}, set bigint, size bigint, bands array<bigint>")


def _members(texts: DataFrame, width: int) -> DataFrame:
    """``set, hashes``: the sets of ``texts``, which have one column."""

    def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [shingle_set(value.as_py(), width) for value in batch.column(0)]
        return pa.RecordBatch.from_arrays(
            [pa.array([_digest(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())],
            ["set", "hashes"],
        )

    return map_batches(texts, fn, "set bigint, hashes binary")


def _verified(pairs: DataFrame, members: DataFrame, least: float) -> DataFrame:
    """The pairs ``a, b`` of sets whose exact Jaccard is ``least`` or more."""

    def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
        near = [
            jaccard(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)) >= least
            for x, y in zip(batch.column(2), batch.column(3), strict=True)
        ]
        return batch.select(["a", "b"]).filter(pa.array(near))

    sides = [members.select(F.col("set").alias(c), F.col("hashes").alias(f"_{c}")) for c in "ab"]
    return map_batches(
        pairs.join(sides[0], "a").join(sides[1], "b").select("a", "b", "_a", "_b"), fn, "a bigint, b bigint"
    )


def _labelled(rows: DataFrame, links: DataFrame) -> DataFrame:
    """``rows`` with the component of each set by the links so far."""
    groups = components(links, "a", "b").withColumnRenamed("node", "set")
    return rows.join(groups, "set", "left").withColumn("component", F.coalesce("component", "set"))


def _open(rows: DataFrame) -> DataFrame:
    """The rows of bands that hold several components, with ``main``, the most frequent of them."""
    several = rows.groupBy("band").agg(
        F.mode("component").alias("main"), F.min("component").alias("_low"), F.max("component").alias("_high")
    )
    return rows.join(several.where("_low < _high").select("band", "main"), "band")


def _along(rows: DataFrame, least: float, seed: int) -> DataFrame:
    """Pairs of neighbours ``a < b`` in one random order of each band, the same order in all bands."""
    order = F.pmod(F.xxhash64("set", F.lit(seed)), F.lit(1 << 40))
    tiles = rows.groupBy("band").agg(F.ceil(F.count("*") / TILE).alias("_tiles"))
    tiled = rows.withColumn("_order", order).join(tiles, "band").withColumn(
        "_tile", F.floor(F.col("_order") * F.col("_tiles") / F.lit(1 << 40))
    )
    at = Window.partitionBy("band", "_tile").orderBy("_order", "set")
    near = tiled.select("set", "size", F.lag("set").over(at).alias("_set"), F.lag("size").over(at).alias("_size"))
    fits = near.where(F.least("size", "_size") / F.greatest("size", "_size") >= least)
    return fits.where("_set IS NOT NULL").select(F.least("set", "_set").alias("a"), F.greatest("set", "_set").alias("b")).distinct()


def _across(rows: DataFrame, members: DataFrame, least: float) -> DataFrame:
    """Links ``a, b`` that join all components of a band between which any pair of sets reaches ``least``.

    The members outside the main component are cut into tiles by the size of their sets; every member of the band meets
    every tile. A task holds one tile and reads the members one after the other. It compares sets of different components
    only, and two components are one for it from their first link on, so a member is seldom compared more than a few times.
    No row is made for a pair that is not a link.
    """
    other = rows.where("component != main")
    tiles = other.groupBy("band").agg(F.ceil(F.sum("size") / TILE_HASHES).cast("int").alias("_tiles"))
    kept = ["band", "tile", "guest", "set", "component"]
    home = other.join(tiles, "band").select(
        "band", F.pmod(F.xxhash64("set"), "_tiles").cast("int").alias("tile"), F.lit(0).alias("guest"), "set", "component"
    )
    guest = rows.join(tiles, "band").select(
        "band", F.explode(F.sequence(F.lit(0), F.col("_tiles") - 1)).alias("tile"), F.lit(1).alias("guest"), "set", "component"
    )
    dealt = home.unionByName(guest.select(kept)).join(members, "set").repartition("band", "tile")
    dealt = dealt.sortWithinPartitions("band", "tile", "guest", "set")

    def run(batches):
        place, held, forest = None, {}, {}

        def root(x):
            while forest.get(x, x) != x:
                x = forest[x]
            return x

        for batch in batches:
            found = []
            columns = [batch.column(c).to_pylist() for c in (*kept, "hashes")]
            for band, tile, guest, name, component, hashes in zip(*columns, strict=True):
                if place != (band, tile):
                    place, held, forest = (band, tile), {}, {}
                own = np.frombuffer(hashes, np.uint64)
                if not guest:
                    held.setdefault(component, []).append((name, own))
                    continue
                for group in [g for g in held if root(g) != root(component)]:
                    for there, set_ in held[group]:
                        near = min(len(own), len(set_)) >= least * max(len(own), len(set_))
                        if near and jaccard(own, set_) >= least:
                            found.append((min(name, there), max(name, there)))
                            forest[root(group)] = root(component)
                            break
            if found:
                a, b = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    ship_package(rows.sparkSession)
    return dealt.select(*kept, "hashes").mapInArrow(run, "a bigint, b bigint").distinct()


def links(texts: DataFrame, sketches: DataFrame, key: str, text: str, width: int, least: float) -> DataFrame:
    """Edges ``a, b`` between sets that connect all pairs of at least ``least``; ``key`` names the texts."""
    sets = sketches.groupBy("set").agg(F.min(key).alias("_name"), F.first("size").alias("size"), F.first("bands").alias("bands"))
    rows = sets.select("set", "_name", "size", F.explode("bands").alias("band"))
    shared = rows.groupBy("band").agg(F.count("*").alias("_n")).where("_n > 1").select("band")
    rows = materialise(rows.join(shared, "band"), "band-rows")
    wanted = rows.select(F.col("_name").alias(key)).distinct()
    chosen = texts.join(wanted, key, "left_semi").dropDuplicates([key]).select(F.col(text).cast("string"))
    members = materialise(_members(chosen, width), "shingle-sets")
    rows = rows.drop("_name")
    found = tried = None
    for seed in (1, 2):
        if found is None:
            pairs = _along(rows, least, seed)
        else:
            pairs = _along(_open(_labelled(rows, found)), least, seed).join(tried, ["a", "b"], "left_anti")
        pairs = materialise(pairs, "band-pairs")
        near = materialise(_verified(pairs, members, least), "shingle-links")
        found, tried = (near, pairs) if found is None else (found.unionByName(near), tried.unionByName(pairs))
    still = materialise(_open(_labelled(rows, found)), "open-bands")
    return found.unionByName(materialise(_across(still, members, least), "shingle-links"))


def near_duplicates(docs: DataFrame, key: str, text: str = "text", width: int = 5, least: float = 0.8) -> DataFrame:
    """``key, component_id`` of each row; the component is the smallest key reachable over links.

    Every row is in a component, alone if need be; null and blank texts have the empty set and are one. Other columns
    are ignored.
    """
    named = docs.select(F.col(key), F.col(text), F.xxhash64(F.coalesce(text, F.lit(""))).alias("_text"))
    sketches = materialise(_sketches(named.dropDuplicates(["_text"]), "_text", text, width), "sketches")
    near = materialise(links(named, sketches, "_text", text, width, least), "set-links")
    groups = _labelled(sketches.select("_text", "set"), near).select("_text", "component")
    rows = materialise(named.select(key, "_text").join(groups, "_text").select(key, "component"), "set-components")
    return rows.join(rows.groupBy("component").agg(F.min(key).alias("component_id")), "component").select(key, "component_id")
