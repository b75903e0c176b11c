"""Exact substring de-duplication with suffix arrays.

A byte of a document is removed if a string of ``length`` bytes that covers it also starts in a document with a smaller
key. Every window of ``length`` bytes has one anchor, the gram in it with the smallest hash, so equal windows have
equal anchors, and windows in a row that share an anchor make one segment. Segments are dealt by anchor:

1. ``segments``: anchors, content hashes and places of all segments, from one scan of the texts.
2. ``_settle``: an anchor seen in one document only is done. Where a segment occurs again in a larger document, the
   copy is removed whole. What is left are the first documents of different segments that share an anchor.
3. Their bytes are cut from the texts, and shards of whole anchors get a suffix array by induced sorting and its
   permuted common prefixes; a window is removed where a suffix equal to ``length`` bytes has a smaller key. An anchor
   with more bytes than a shard is not sorted: its windows are dealt singly, by a hash of their bytes.
4. Removed windows meet their documents once more and are merged into byte runs.

Copies thus never meet in pairs, and a suffix array holds each different segment of an anchor once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import free_name, map_batches
from tidemark.llm.suffixes import common_prefixes, suffix_array
from tidemark.session import materialise, ship_package

GRAM = 20
SLICE = 1 << 19  # bytes handled at a time
LAST = 2**63 - 1


def gram_hashes(text: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the GRAM = 20 bytes at every position; needs four bytes beyond the last gram."""
    eights = np.ndarray((len(text) - 7,), "<u8", text, strides=(1,))
    n = len(text) - GRAM + 1
    h = eights[:n] * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h += eights[8: n + 8]
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(31)
    h += eights[12: n + 12]
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(30)
    return h


def anchor_runs(text: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, first window, windows) of each run of windows that share their anchor; for at most SLICE windows."""
    grams = length - GRAM + 1
    mask = np.uint64((1 << 20) - 1)
    best = gram_hashes(text)
    best &= ~mask
    best |= np.arange(len(best), dtype=np.uint64)
    size = 1
    while size * 2 <= grams:
        best = np.minimum(best[:-size], best[size:])
        size *= 2
    if size < grams:
        best = np.minimum(best[: len(best) - (grams - size)], best[grams - size:])
    first = np.concatenate([[0], np.flatnonzero(best[1:] != best[:-1]) + 1])
    return (best[first] >> np.uint64(20)).astype(np.int64), first, np.diff(np.append(first, len(best)))


def copies_within(anchor: np.ndarray, segment: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Whether the segment of a row is also that of a smaller document among these rows."""
    order = np.lexsort((doc, segment, anchor))
    a, s, d = anchor[order], segment[order], doc[order]
    new = np.ones(len(order), bool)
    new[1:] = (a[1:] != a[:-1]) | (s[1:] != s[:-1])
    out = np.empty(len(order), bool)
    out[order] = d != d[new][np.cumsum(new) - 1]
    return out


def segments(texts: DataFrame, length: int) -> DataFrame:
    """``anchor, segment, doc, place, done`` of each segment; ``place`` is 64 times its first byte plus its windows.

    A run of windows never has more than ``length - GRAM + 1`` windows, since its anchor lies in all of them. ``done``
    marks segments that a smaller document of the same batch holds too: those are removed whatever other batches hold,
    so a passage that very many documents share reaches its anchor about once per batch.
    """
    digest = xxhash.xxh3_64_intdigest

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts: list[list[np.ndarray]] = [[], [], [], []]
            for doc, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                raw = memoryview(value.as_buffer())
                if len(raw) < length:
                    continue
                text = np.frombuffer(raw, np.uint8)
                for at in range(0, len(text) - length + 1, SLICE):
                    piece = text[at: at + SLICE + length - 1]
                    anchor, first, n = anchor_runs(piece, length)
                    part = raw[at:]
                    ends = (first + n + (length - 1)).tolist()
                    content = [digest(part[a:b]) for a, b in zip(first.tolist(), ends, strict=True)]
                    parts[0].append(anchor)
                    parts[1].append(np.array(content, np.uint64).view(np.int64))
                    parts[2].append(np.full(len(first), doc, np.int64))
                    parts[3].append((first + at) * 64 + n)
            if parts[0]:
                rows = [np.concatenate(p) for p in parts]
                rows.append(copies_within(*rows[:3]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(p) for p in rows], ["anchor", "segment", "doc", "place", "done"]
                )

    return texts.mapInArrow(run, "anchor bigint, segment bigint, doc bigint, place bigint, done boolean")


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by (anchor, segment, doc). Gives ``anchor, doc, places, done``: a settled row has a place whose
    windows are removed, any other the places of a segment in its first document. Rows that are done pass through.

    Of the anchor a batch ends in, only rows of first documents are carried over: one per different segment, and its
    repeats within that document.
    """

    def out(rows: np.ndarray, done: bool) -> pa.RecordBatch:
        """One row per run of equal (anchor, segment, doc)."""
        new = np.ones(len(rows), bool)
        new[1:] = (rows[1:, :3] != rows[:-1, :3]).any(axis=1)
        starts = np.flatnonzero(new)
        places = pa.ListArray.from_arrays(
            pa.array(np.append(starts, len(rows)).astype(np.int32)), pa.array(np.ascontiguousarray(rows[:, 3]))
        )
        return pa.RecordBatch.from_arrays(
            [pa.array(np.ascontiguousarray(rows[starts, 0])), pa.array(np.ascontiguousarray(rows[starts, 2])), places,
             pa.array(np.full(len(starts), done))], ["anchor", "doc", "places", "done"],
        )

    def split(rows: np.ndarray, last: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Copies to remove, rows left open, rows carried over."""
        anchor = rows[:, 0]
        new_anchor = np.ones(len(rows), bool)
        new_anchor[1:] = anchor[1:] != anchor[:-1]
        new_segment = new_anchor.copy()
        new_segment[1:] |= rows[1:, 1] != rows[:-1, 1]
        leaders = np.flatnonzero(new_segment)
        first = rows[leaders, 2][np.cumsum(new_segment) - 1]
        copies = rows[:, 2] != first
        heads = np.flatnonzero(new_anchor)
        per_anchor = np.add.reduceat(new_segment, heads, dtype=np.int64)
        lowest, highest = np.minimum.reduceat(rows[:, 2], heads), np.maximum.reduceat(rows[:, 2], heads)
        group = np.cumsum(new_anchor) - 1
        left = ~copies & (per_anchor > 1)[group] & (lowest < highest)[group]
        carried = np.zeros(len(rows), bool)
        if not last:
            carried[heads[-1]:] = ~copies[heads[-1]:]
            left &= ~carried
        return rows[copies], rows[left], rows[carried]

    held = np.empty((0, 4), np.int64)
    for batch in batches:
        if batch.num_rows:
            new = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns[:4]])
            done = batch.column(4).to_numpy(zero_copy_only=False)
            if done.any():
                yield out(new[done], True)
                new = new[~done]
            if not len(new):
                continue
            copies, left, held = split(np.concatenate([held, new]), False)
            if len(copies):
                yield out(copies, True)
            if len(left):
                yield out(left, False)
    if len(held):
        _, left, _ = split(held, True)
        if len(left):
            yield out(left, False)


def _cut(batch: pa.RecordBatch, length: int) -> pa.RecordBatch:
    """The bytes of each wanted segment of a text: ``anchor, doc, places, bytes``."""
    anchors, docs, places, cuts = [], [], [], []
    for doc, value, wanted in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
        raw = memoryview(value.as_buffer())
        for w in wanted:
            place, n = divmod(w["places"][0], 64)
            anchors.append(w["anchor"])
            docs.append(doc)
            places.append(w["places"])
            cuts.append(bytes(raw[place: place + n + length - 1]))
    return pa.RecordBatch.from_arrays(
        [pa.array(anchors, pa.int64()), pa.array(docs, pa.int64()), pa.array(places, pa.list_(pa.int64())),
         pa.array(cuts, pa.binary())], ["anchor", "doc", "places", "bytes"],
    )


def _windows(batch: pa.RecordBatch, length: int) -> pa.RecordBatch:
    """``window, doc, places``: each window of the segments of ``_cut`` on its own, by a hash of its bytes."""
    digest = xxhash.xxh3_64_intdigest
    hashes, docs, places = [], [], []
    for doc, own, raw in zip(*(batch.column(c).to_pylist() for c in ("doc", "places", "bytes")), strict=True):
        for at in range(len(raw) - length + 1):
            hashes.append(digest(raw[at: at + length]))
            docs.append(doc)
            places.append([(p // 64 + at) * 64 + 1 for p in own])
    return pa.RecordBatch.from_arrays(
        [pa.array(np.array(hashes, np.uint64).view(np.int64)), pa.array(docs, pa.int64()), pa.array(places, pa.list_(pa.int64()))],
        ["window", "doc", "places"],
    )


def shard_windows(anchors: np.ndarray, docs: np.ndarray, cuts: list[bytes], length: int) -> list[tuple[int, int, int]]:
    """(row, first window, windows) of the windows of each segment that an equal window with a smaller key removes.

    Works on one suffix array over all segments of a shard; a separator byte stands after each.
    """
    sizes = np.fromiter(map(len, cuts), np.int64, len(cuts)) + 1
    starts = np.cumsum(sizes) - sizes
    joined = b"\0".join(cuts) + b"\0"
    text = np.frombuffer(joined, np.uint8)
    string = text.astype(np.int32) + 2
    string[starts + sizes - 1] = 1
    array = suffix_array(np.append(string, 0), length)[1:]
    owner = np.repeat(np.arange(len(cuts)), sizes)
    whole = np.arange(len(text)) + length < (starts + sizes)[owner]
    shared = common_prefixes(np.concatenate([text, np.zeros(length + 16, np.uint8)]), array, length)
    array = array[whole[array]]
    if not len(array):
        return []
    group = np.flatnonzero(np.concatenate([[True], shared[array[1:]] < length]))
    least = np.repeat(np.minimum.reduceat(docs[owner[array]], group), np.diff(np.append(group, len(array))))
    gone = np.zeros(len(text) + 1, bool)
    gone[array] = least < docs[owner[array]]
    edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8)])))
    return [(int(owner[a]), int(a - starts[owner[a]]), int(b - a)) for a, b in zip(edges[::2], edges[1::2], strict=True)]


def _shards(length: int, shard_bytes: int):
    """Suffix arrays over runs of whole anchors; gives ``doc, place`` of removed windows."""

    def settle(rows: list[tuple]) -> pa.RecordBatch | None:
        anchors, docs, places, cuts = zip(*rows, strict=True)
        found = shard_windows(np.array(anchors), np.array(docs), list(cuts), length)
        doc, place = [], []
        for row, first, n in found:
            for p in places[row]:
                doc.append(docs[row])
                place.append((p // 64 + first) * 64 + n)
        return pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(place, pa.int64())], ["doc", "place"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        size = 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if size >= shard_bytes and row[0] != rows[-1][0]:
                    yield settle(rows)
                    rows, size = [], 0
                rows.append(row)
                size += len(row[3]) + 1
        if rows:
            yield settle(rows)

    return run


def _merge(batch: pa.RecordBatch, length: int, keep_text: bool) -> pa.RecordBatch:
    """Byte runs, counts and what is kept, from a text and its removed windows."""
    bytes_, removed, spans, kept, digests = [], [], [], [], []
    for value, windows in zip(batch.column(1), batch.column(2).to_pylist(), strict=True):
        raw = memoryview(value.as_buffer()) if value.is_valid else memoryview(b"")
        runs: list[list[int]] = []
        for w in sorted(windows or ()):
            first, n = divmod(w, 64)
            if runs and first <= runs[-1][1]:
                runs[-1][1] = max(runs[-1][1], first + n + length - 1)
            else:
                runs.append([first, first + n + length - 1])
        left = b"".join(raw[a:b] for a, b in zip([0, *(r[1] for r in runs)], [*(r[0] for r in runs), len(raw)], strict=True))
        bytes_.append(len(raw))
        removed.append(len(raw) - len(left))
        spans.append([{"start": a, "end": b} for a, b in runs])
        digests.append(hashlib.sha256(left).hexdigest())
        kept.append(left if keep_text else None)
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    return pa.RecordBatch.from_arrays(
        [batch.column(0), pa.array(bytes_, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, kind),
         pa.array(digests), pa.array(kept, pa.binary())],
        ["key", "n_bytes", "n_removed", "spans", "kept_sha256", "kept"],
    )


def remove_repeats(
    docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = 50, shard_bytes: int = 2 << 20,
    keep_text: bool = True,
) -> DataFrame:
    """``key, n_bytes, n_removed, spans, kept_sha256, kept`` of each row.

    ``spans`` are the maximal removed byte runs (end exclusive), ``kept`` the other bytes (null unless ``keep_text``).
    A null text is empty. A null key counts as the largest; rows of one key, and of null, are one document and never
    remove each other's bytes, but a run found in one of them is cut from each, so such rows must not differ. Other
    columns are ignored.
    """
    if not GRAM <= length < GRAM + 63:
        raise ValueError(f"length must be from {GRAM} to {GRAM + 62}")
    ship_package(docs.sparkSession)
    own = free_name(docs, "_key")
    texts = docs.select(
        F.coalesce(F.col(key).cast("bigint"), F.lit(LAST)).alias(own),
        F.encode(F.coalesce(F.col(text).cast("string"), F.lit("")), "utf-8").alias("bytes"),
    )
    lane = F.when(F.col("done"), F.xxhash64("doc", "place")).otherwise(F.col("anchor"))
    dealt = segments(texts, length).repartition(lane).sortWithinPartitions("done", "anchor", "segment", "doc")
    settled = materialise(dealt.mapInArrow(_settle, "anchor bigint, doc bigint, places array<bigint>, done boolean"), "repeats")
    left = settled.where("NOT done")
    size = F.pmod(F.col("places")[0], F.lit(64)) + length
    large = materialise(
        left.groupBy("anchor").agg(F.sum(size).alias("size")).where(F.col("size") > shard_bytes).select("anchor"), "large-anchors"
    )
    wanted = (
        left.groupBy(F.col("doc").alias(own))
        .agg(F.collect_list(F.struct("anchor", "places")).alias("wanted"))
    )
    cut = map_batches(
        texts.join(wanted.hint("shuffle_hash"), own), lambda b: _cut(b, length),
        "anchor bigint, doc bigint, places array<bigint>, bytes binary",
    )
    cut = materialise(cut, "segments")
    shards = cut.join(large, "anchor", "left_anti").repartition("anchor").sortWithinPartitions("anchor")
    found = shards.mapInArrow(_shards(length, shard_bytes), "doc bigint, place bigint")
    singly = map_batches(
        cut.join(large, "anchor", "left_semi"), lambda b: _windows(b, length), "window bigint, doc bigint, places array<bigint>"
    )
    firsts = singly.groupBy("window").agg(F.min("doc").alias("_first"))
    again = singly.join(firsts, "window").where("doc > _first").select("doc", F.explode("places").alias("place"))
    found = found.unionByName(again)
    copies = settled.where("done").select("doc", F.explode("places").alias("place"))
    windows = copies.unionByName(found).groupBy(F.col("doc").alias(own)).agg(F.collect_list("place").alias("windows"))
    merged = map_batches(
        texts.join(windows.hint("shuffle_hash"), own, "left"), lambda b: _merge(b, length, keep_text),
        "key bigint, n_bytes bigint, n_removed bigint, spans array<struct<start:bigint,end:bigint>>, kept_sha256 string,"
        " kept binary",
    )
    return merged.select(F.nullif(F.col("key"), F.lit(LAST)).alias(key), *merged.columns[1:])
