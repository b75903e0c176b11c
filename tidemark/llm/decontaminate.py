"""Benchmark decontamination: Wu-Manber multi-pattern search for benchmark windows in documents.

Texts are normalised to bytes `` w1 w2 ... wn `` (lower-case words, one space around each), so a window of words is one
byte string that starts and ends with a space. Windows are cut into classes by length; a class has a shift table over
blocks of bytes, which lets the scan jump over every position where no window can end, and buckets of windows under
the block that ends their first m bytes, where m is the shortest length of the class. Candidates are compared byte by
byte. Many stretches of a batch are scanned in step with numpy. Benchmarks larger than ``block_windows`` windows are
searched block by block, each with one scan, so the tables sent to tasks stay bounded.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.frames import free_name, map_batches
from tidemark.session import materialise

# Word characters are digits, lower-case letters and all bytes from 0x80; A-Z become a-z, other bytes a space.
_TABLE = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20
    for c in range(256)
)
BITS = 20  # of the hash of a block
STRETCH = 4096  # positions a lane scans


def normalise(text: str | None) -> bytes:
    words = (text or "").encode().translate(_TABLE).split()
    return b" " + b" ".join(words) + b" " if words else b""


def windows(text: str | None, width: int) -> set[bytes]:
    """All windows of ``width`` consecutive words; a text of fewer words, but not none, is one window."""
    words = normalise(text).split()
    return {
        b" " + b" ".join(words[i: i + width]) + b" " for i in range(max(1, len(words) - width + 1)) if words
    }


def _hash(values: np.ndarray) -> np.ndarray:
    return (values * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS)


class _Class:
    """Shift table and suffix buckets of the windows of one length class."""

    def __init__(self, patterns: dict[bytes, tuple[str, ...]]):
        self.m = min(map(len, patterns))
        self.block = min(8, max(2, self.m // 2))
        self.mask = np.uint64((1 << 8 * self.block) - 1)
        self.shift = np.full(1 << BITS, self.m - self.block + 1, np.int32)
        self.buckets: dict[int, list[tuple[bytes, int, tuple[str, ...]]]] = defaultdict(list)
        heads = {p[: self.m] for p in patterns}
        rows = np.frombuffer(b"".join(h + bytes(8) for h in heads), np.uint8).reshape(len(heads), self.m + 8)
        for end in range(self.block, self.m + 1):
            at = end - self.block
            values = np.ascontiguousarray(rows[:, at: at + 8]).view("<u8")[:, 0] & self.mask
            np.minimum.at(self.shift, _hash(values), self.m - end)
        for p, items in patterns.items():
            self.buckets[int.from_bytes(p[self.m - self.block: self.m], "little")].append((p, p.count(b" ") - 1, items))

    def candidates(self, text: np.ndarray, words: np.ndarray) -> np.ndarray:
        """Positions whose block at the end of the first m bytes is that of some window, in no order."""
        last = len(text) - 8 - self.m
        if last < 0:
            return np.empty(0, np.int64)
        at = np.arange(0, last + 1, STRETCH)
        ends = np.minimum(at + STRETCH, last + 1)
        found = []
        while len(at):
            step = self.shift[_hash(words[at + (self.m - self.block)] & self.mask)]
            hit = step == 0
            if hit.any():
                found.append(at[hit])
            at = at + np.maximum(step, 1)
            live = at < ends
            if not live.all():
                at, ends = at[live], ends[live]
        every = np.concatenate(found) if found else np.empty(0, np.int64)
        return every[text[every] == 0x20]


class Searcher:
    def __init__(self, patterns: dict[bytes, tuple[str, ...]]):
        classes: dict[int, dict[bytes, tuple[str, ...]]] = defaultdict(dict)
        for p, items in patterns.items():
            classes[min(len(p).bit_length(), 6)][p] = items
        self.classes = [_Class(c) for c in classes.values()]

    def occurrences(self, buffer: bytes) -> Iterator[tuple[int, int, tuple[str, ...]]]:
        """(position, words, items) of every window in a buffer that ends with eight zero bytes."""
        text = np.frombuffer(buffer, np.uint8)
        eights = np.ndarray((max(0, len(buffer) - 7),), "<u8", buffer, strides=(1,))
        for c in self.classes:
            for at in c.candidates(text, eights).tolist():
                value = int.from_bytes(buffer[at + c.m - c.block: at + c.m], "little")
                for pattern, n, items in c.buckets.get(value, ()):
                    if buffer.startswith(pattern, at):
                        yield at, n, items


def search_batch(searcher: Searcher, texts: list[str | None]) -> list[tuple[int, list[dict], set[str]]]:
    """For each text its number of words, the (first word, words) of each occurrence, and the items found."""
    parts = [normalise(t) for t in texts]
    lengths = np.fromiter((len(p) + 1 for p in parts), np.int64, len(parts))
    starts = np.concatenate([[0], np.cumsum(lengths)])
    buffer = b"\n".join(parts) + b"\n" + bytes(8)
    out = [(max(0, p.count(b" ") - 1), [], set()) for p in parts]
    hits = list(searcher.occurrences(buffer))
    if hits:
        places = np.array([h[0] for h in hits])
        owners = np.searchsorted(starts, places, side="right") - 1
        spaces = np.flatnonzero(np.frombuffer(buffer, np.uint8) == 0x20)
        words = np.searchsorted(spaces, places) - np.searchsorted(spaces, starts[owners])
        for (_, n, items), doc, word in zip(hits, owners.tolist(), words.tolist(), strict=True):
            out[doc][1].append({"first": word, "n": n})
            out[doc][2].update(items)
    return out


def _blocks(benchmark: DataFrame, item: str, text: str, width: int, block_windows: int) -> Iterator[dict]:
    """The windows of the benchmark with their items, a bounded number at a time."""
    block: dict[bytes, set[str]] = defaultdict(set)
    rows = benchmark.select(F.coalesce(F.col(item).cast("string"), F.lit("")), F.col(text).cast("string"))
    for name, value in rows.toLocalIterator():
        for w in windows(value, width):
            block[w].add(name)
        if len(block) >= block_windows:
            yield {w: tuple(sorted(n)) for w, n in block.items()}
            block.clear()
    yield {w: tuple(sorted(n)) for w, n in block.items()}


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text",
    width: int = 10, block_windows: int = 1 << 18, column: str = "contamination",
) -> tuple[DataFrame, str]:
    """``docs`` with one more column, and its name: ``struct(n_words, n_hit, items)``.

    ``n_hit`` counts the words inside any occurrence of a window, ``items`` names the items with occurring windows,
    sorted as strings. Null and blank texts have no words; null item names are blank. Rows, also repeated ones, and
    other columns stay as they are; if ``column`` is taken the new name gets underscores in front.
    """
    name = free_name(docs, column)
    found_type = "struct<n_words:bigint,spans:array<struct<first:bigint,n:bigint>>,items:array<string>>"
    span = pa.struct([("first", pa.int64()), ("n", pa.int64())])
    arrow = pa.struct([("n_words", pa.int64()), ("spans", pa.list_(span)), ("items", pa.list_(pa.string()))])
    place = docs.columns.index(text)
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T._parse_datatype_string(found_type))])
    out = docs
    blocks = _blocks(benchmark, item, item_text, width, block_windows)
    patterns = next(blocks)
    while True:
        tables = docs.sparkSession.sparkContext.broadcast(patterns)
        first = name not in out.columns

        def fn(batch: pa.RecordBatch, tables=tables, first=first) -> pa.RecordBatch:
            found = search_batch(_searcher(tables), batch.column(place).cast(pa.string()).to_pylist())
            before = [None] * batch.num_rows if first else batch.column(batch.num_columns - 1).to_pylist()
            merged = [
                {"n_words": n, "spans": spans + (b["spans"] if b else []), "items": sorted(items | set(b["items"] if b else ()))}
                for (n, spans, items), b in zip(found, before, strict=True)
            ]
            columns = batch.columns[: len(schema) - 1]
            return pa.RecordBatch.from_arrays([*columns, pa.array(merged, arrow)], names=schema.names)

        out = map_batches(out, fn, schema)
        patterns = next(blocks, None)
        if patterns is None:
            break
        out = materialise(out, "contamination")
    return out.withColumn(name, F.struct(
        F.col(name)["n_words"].alias("n_words"), _covered(F.col(name)["spans"]).alias("n_hit"),
        F.col(name)["items"].alias("items"),
    )), name


def _covered(spans: Column) -> Column:
    """Words in the union of (first, n) spans."""
    zero = F.lit(0).cast("bigint")
    return F.aggregate(
        F.array_sort(spans), F.struct(zero.alias("total"), zero.alias("end")),
        lambda a, s: F.struct(
            (a["total"] + F.greatest(zero, s["first"] + s["n"] - F.greatest(s["first"], a["end"]))).alias("total"),
            F.greatest(a["end"], s["first"] + s["n"]).alias("end"),
        ),
        lambda a: a["total"],
    )


_ready: list = [None, None]


def _searcher(tables) -> Searcher:
    """The search tables of a broadcast, built once per worker process; only the latest are held."""
    if _ready[0] is not tables:
        _ready[:] = [tables, Searcher(tables.value)]
    return _ready[1]
