"""SimHash near-duplicates by anchor-point covering.

A fingerprint is cut into blocks; if two fingerprints differ in at most t bits, some block of theirs differs in at
most t // blocks. Each block has a covering code: the binary Hamming code of length 2^r - 1 (covering radius 1), whose
words, with the block's other bits, are the anchors. A fingerprint is at home at the anchor nearest to each block and
visits every anchor within the covering radius plus the block's threshold, so two linked fingerprints meet at the home
of either. Copies of a fingerprint are one row before they are replicated. At an anchor visitors are compared with
those at home, and only the edges of a spanning forest leave it, never all pairs of a group.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.frames import map_batches
from tidemark.session import materialise, ship_package

SEED = 42


def shingle_hashes(text: str | None, width: int) -> np.ndarray:
    """XXH64 of every ``width``-word shingle of a text; bytes.split cuts at exactly space and \\t to \\r."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(words) <= width:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], np.uint64)
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(words) - width + 1].tolist()
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], SEED) for a, b in zip(starts, ends[width - 1:].tolist(), strict=True)], np.uint64)


def simhash(hashes: np.ndarray, slice_rows: int = 1 << 16) -> int:
    """A bit is set where over half of the hashes have it; zero for none."""
    count = np.zeros(64, np.int64)
    for at in range(0, len(hashes), slice_rows):
        part = np.ascontiguousarray(hashes[at: at + slice_rows].astype(">u8")).view(np.uint8).reshape(-1, 8)
        count += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    bits = count * 2 > len(hashes)
    return int.from_bytes(np.packbits(bits).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 4) -> DataFrame:
    """``key, fingerprint`` (64 bits as a signed long) of each row; null and blank texts have fingerprint zero."""

    def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
        prints = [simhash(shingle_hashes(t.as_py(), width)) for t in batch.column(1)]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints, pa.int64())], [key, "fingerprint"])

    kind = docs.schema[key].dataType.simpleString()
    return map_batches(
        docs.select(F.col(key), F.col(text).cast("string")), fn, f"`{key}` {kind}, fingerprint bigint"
    )


@lru_cache
def _masks(r: int, reach: int) -> tuple[np.ndarray, ...]:
    """By syndrome, the masks of at most ``reach`` flips that lead from a word of that syndrome to a code word.

    Bit i of a word of 2^r - 1 bits has syndrome i + 1.
    """
    found: list[list[int]] = [[] for _ in range(1 << r)]
    for size in range(reach + 1):
        for places in combinations(range((1 << r) - 1), size):
            syndrome = 0
            for i in places:
                syndrome ^= i + 1
            found[syndrome].append(sum(1 << i for i in places))
    return tuple(np.array(m, np.int64) for m in found)


def _words(prints: np.ndarray, block: int, blocks: int, r: int) -> tuple[np.ndarray, np.ndarray]:
    """The coded bits of one block (its low 2^r - 1 bits) and their syndrome."""
    size = (1 << r) - 1
    word = (prints.view(np.uint64) >> np.uint64(block * (64 // blocks))).astype(np.int64) & ((1 << size) - 1)
    syndrome = np.zeros(len(word), np.int64)
    for i in range(size):
        syndrome ^= np.where(word >> i & 1, i + 1, 0)
    return word, syndrome


def homes(prints: np.ndarray, block: int, blocks: int, r: int) -> np.ndarray:
    """The code word at distance 0 or 1 of each block."""
    word, syndrome = _words(prints, block, blocks, r)
    return np.where(syndrome > 0, word ^ (np.int64(1) << np.maximum(syndrome - 1, 0)), word)


def visits(prints: np.ndarray, block: int, blocks: int, r: int, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, anchor) of every code word within ``reach`` bits of each block."""
    word, syndrome = _words(prints, block, blocks, r)
    rows, anchors = [], []
    for s, masks in enumerate(_masks(r, reach)):
        here = np.flatnonzero(syndrome == s)
        rows.append(np.repeat(here, len(masks)))
        anchors.append((word[here][:, None] ^ masks[None, :]).ravel())
    return np.concatenate(rows), np.concatenate(anchors)


def _roles(prints: DataFrame, blocks: int, r: int, bits: int, home: bool) -> DataFrame:
    """``anchor, fingerprint`` for the homes or the visits of each fingerprint; an anchor's low digit is its block."""
    reach = 1 + bits // blocks

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every = batch.column(0).to_numpy(zero_copy_only=False)
            for at in range(0, len(every), 2000):
                part = every[at: at + 2000]
                for block in range(blocks):
                    if home:
                        rows, anchor = np.arange(len(part)), homes(part, block, blocks, r)
                    else:
                        rows, anchor = visits(part, block, blocks, r, reach)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(anchor * blocks + block), pa.array(part[rows])], ["anchor", "fingerprint"]
                    )

    return prints.mapInArrow(run, "anchor bigint, fingerprint bigint")


class _Forest:
    """Union-find over the fingerprints met at one anchor."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        parent = self.parent
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    def join(self, x: int, y: int) -> bool:
        a, b = self.root(x), self.root(y)
        self.parent[max(a, b)] = min(a, b)
        return a != b


def _compare(bits: int, wide: int = 1 << 22):
    """Edges between visitors and those at home, per run of equal (anchor, tile); rows come sorted, homes first."""

    def edges(home: np.ndarray, visitors: np.ndarray, forest: _Forest) -> list[tuple[int, int]]:
        out = []
        step = max(1, wide // max(1, len(home)))
        for at in range(0, len(visitors), step):
            part = visitors[at: at + step]
            apart = np.bitwise_count(part.view(np.uint64)[:, None] ^ home.view(np.uint64)[None, :])
            rows, cols = np.nonzero((apart <= bits) & (apart > 0))
            out += [(v, h) for v, h in zip(part[rows].tolist(), home[cols].tolist(), strict=True) if forest.join(v, h)]
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, home, forest = None, np.empty(0, np.int64), _Forest()
        for batch in batches:
            if not batch.num_rows:
                continue
            anchor, tile, visitor, print_ = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            cut = np.flatnonzero((np.diff(anchor) != 0) | (np.diff(tile) != 0)) + 1
            found = []
            for a, b in zip([0, *cut.tolist()], [*cut.tolist(), len(anchor)], strict=True):
                if group != (anchor[a], tile[a]):
                    group, home, forest = (anchor[a], tile[a]), np.empty(0, np.int64), _Forest()
                here, split = print_[a:b], a + int(np.searchsorted(visitor[a:b], 1))
                if split > a:
                    home = np.concatenate([home, here[: split - a]])
                if b > split and (b - split > 1 or len(home) > 1 or print_[split] != home[0]):
                    found += edges(home, print_[split:b], forest)
            if found:
                src, dst = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(src, pa.int64()), pa.array(dst, pa.int64())], ["src", "dst"])

    return run


def links(prints: DataFrame, bits: int = 4, blocks: int = 2, r: int = 5, tile: int = 20_000) -> DataFrame:
    """Edges ``src, dst`` between distinct fingerprints that connect all pairs within ``bits`` bits.

    ``prints`` has one column ``fingerprint``, each value once. ``blocks`` and ``r`` choose the code: the default cuts
    64 bits into two halves of 31 coded bits, 2^26 anchors each. An anchor with more than ``tile`` at home is split
    into tiles that all its visitors meet in turn, so no task holds more than about ``tile`` fingerprints.
    """
    if not 0 < (1 << r) - 1 <= 64 // blocks:
        raise ValueError("the code does not fit the block")
    ship_package(prints.sparkSession)
    home = _roles(prints, blocks, r, bits, home=True)
    counts = home.groupBy("anchor").agg((F.count("*") / tile).cast("bigint").alias("_tiles"))
    visitors = _roles(prints, blocks, r, bits, home=False).join(counts.hint("shuffle_hash"), "anchor")
    met = visitors.select(
        "anchor", F.explode(F.sequence(F.lit(0), F.col("_tiles"))).alias("tile"), F.lit(1).alias("visitor"), "fingerprint"
    )
    tiled = home.join(counts.hint("shuffle_hash"), "anchor").select(
        "anchor", F.pmod(F.xxhash64("fingerprint"), F.col("_tiles") + 1).alias("tile"), F.lit(0).alias("visitor"),
        "fingerprint",
    )
    sides = tiled.unionByName(met)
    dealt = sides.repartition("anchor", "tile").sortWithinPartitions("anchor", "tile", "visitor", "fingerprint")
    return dealt.mapInArrow(_compare(bits), "src bigint, dst bigint")


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 4, bits: int = 4, blocks: int = 2, r: int = 5
) -> DataFrame:
    """``key, fingerprint, component_id`` of each row; the component is the smallest key reachable over links.

    Every row is in a component, alone if need be; rows of equal fingerprint are linked, blank texts among them. A null
    key never names a component unless all keys of it are null. Other columns are ignored.
    """
    prints = materialise(fingerprints(docs, key, text, width), "fingerprints")
    # Some hundred rows grow from each: a fixed number of partitions, which adaptive execution leaves as they are.
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    distinct = prints.select("fingerprint").distinct().repartition(parts, "fingerprint")
    near = materialise(links(distinct, bits, blocks, r), "simhash-links")
    groups = components(near, "src", "dst")
    firsts = prints.groupBy("fingerprint").agg(F.min(key).alias("_first"))
    labelled = firsts.join(groups.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").withColumn(
        "component", F.coalesce("component", "fingerprint")
    )
    ids = labelled.groupBy("component").agg(F.min("_first").alias("component_id"))
    names = labelled.join(ids, "component").select("fingerprint", "component_id")
    return prints.join(names, "fingerprint").select(key, "fingerprint", "component_id")


def hex16(fingerprint: Column) -> Column:
    return F.lpad(F.lower(F.hex(fingerprint)), 16, "0")
