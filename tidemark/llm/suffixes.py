"""Suffix arrays by induced sorting, and permuted common prefixes, with numpy.

All comparisons stop after ``depth`` bytes: suffixes that agree so far may stand in any order.
"""

from __future__ import annotations

import numpy as np


def classify(s: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one; the last, a sentinel below all others, is."""
    n = len(s)
    step = np.zeros(n, np.int8)
    step[:-1] = np.sign(s[1:].astype(np.int32) - s[:-1])
    step[-1] = 1
    decided = np.where(step != 0, np.arange(n), n - 1)
    ahead = np.minimum.accumulate(decided[::-1])[::-1]
    return step[ahead] > 0


class _Buckets:
    """Where the suffixes of each first byte lie in the array."""

    def __init__(self, s: np.ndarray):
        self.counts = np.bincount(s, minlength=int(s.max()) + 1)
        self.ends = np.cumsum(self.counts)
        self.heads = self.ends - self.counts
        self.bytes = np.flatnonzero(self.counts).tolist()


def _deal(firsts: np.ndarray, items: np.ndarray, array: np.ndarray, fill: np.ndarray, back: bool) -> None:
    """Appends items in order to the buckets of their first bytes; ``back`` fills buckets from their end down."""
    order = np.argsort(firsts, kind="stable")
    sorted_firsts = firsts[order]
    counts = np.bincount(sorted_firsts, minlength=len(fill))
    rank = np.arange(len(items)) - np.repeat(np.cumsum(counts) - counts, counts)
    at = fill[sorted_firsts]
    array[at - rank if back else at + rank] = items[order]
    fill += -counts if back else counts


def induce(s: np.ndarray, small: np.ndarray, lms: np.ndarray, buckets: _Buckets) -> np.ndarray:
    """The order of all suffixes that follows from the order of the leftmost-smaller ones ``lms``.

    Buckets are passed upwards for larger suffixes and downwards for smaller ones. What a bucket adds to itself is
    dealt in waves, as many as its byte repeats in a row.
    """
    n = len(s)
    array = np.full(n, -1, np.int64)
    low, high = buckets.heads.copy(), buckets.ends - 1
    by_first = np.argsort(s[lms], kind="stable")
    seeds, cuts = lms[by_first], np.searchsorted(s[lms][by_first], np.arange(len(buckets.counts) + 1))
    for c in buckets.bytes:
        at = buckets.heads[c]
        waiting = seeds[cuts[c]: cuts[c + 1]]
        while True:
            wave = array[at: low[c]]
            at = low[c]
            last = not len(wave)
            before = (waiting if last else wave) - 1
            before = before[before >= 0]
            before = before[~small[before]]
            _deal(s[before], before, array, low, back=False)
            if last:
                break
    array[0] = n - 1
    for c in reversed(buckets.bytes):
        at = buckets.ends[c] - 1
        large = array[buckets.heads[c]: low[c]]
        while True:
            wave = array[high[c] + 1: at + 1][::-1]
            at = high[c]
            last = not len(wave)
            before = (large[::-1] if last else wave) - 1
            before = before[before >= 0]
            before = before[small[before]]
            _deal(s[before], before, array, high, back=True)
            if last:
                break
    return array


def _name(s: np.ndarray, lms: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Names of the leftmost-smaller substrings in text order: equal substrings share one, names keep the order."""
    slot = np.zeros(len(s) + 1, np.int64)
    slot[lms] = np.append(np.diff(lms), 1) + 1
    size = slot[order]
    differs = np.ones(len(order), bool)
    differs[1:] = size[1:] != size[:-1]
    pairs = np.flatnonzero(~differs)
    k = 0
    while len(pairs):
        apart = s[order[pairs] + k] != s[order[pairs - 1] + k]
        differs[pairs[apart]] = True
        pairs = pairs[~apart]
        k += 1
        pairs = pairs[size[pairs] > k]
    slot[order] = np.cumsum(differs) - 1
    return slot[lms]


def _sort_names(names: np.ndarray, symbols: int) -> np.ndarray:
    """The order of the suffixes of the reduced string by ``symbols`` names, doubling ranks."""
    order, rank, k = np.argsort(names, kind="stable"), names.astype(np.int64), 1
    while k < symbols and rank.max() + 1 < len(rank):
        then = np.zeros(len(rank), np.int64)
        then[:-k] = rank[k:] + 1
        key = rank * (len(rank) + 1) + then
        order = np.argsort(key, kind="stable")
        rank = np.empty(len(key), np.int64)
        rank[order] = np.cumsum(np.concatenate([[0], np.diff(key[order]) != 0]))
        k *= 2
    return order


def suffix_array(s: np.ndarray, depth: int) -> np.ndarray:
    """The suffix array of ``s``, whose last element is a sentinel below all others, to ``depth`` elements.

    Leftmost-smaller substrings are sorted by induction and named. The string of names is the reduced problem; its
    alphabet is as large as itself, which suits no loop over buckets, so its suffixes are ranked by doubling, to as
    many names as cover ``depth``. Their order induces the order of all suffixes.
    """
    small = classify(s)
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    if len(lms) < 2:
        return induce(s, small, lms, _Buckets(s))
    buckets = _Buckets(s)
    rough = induce(s, small, lms, buckets)
    marked = np.zeros(len(s), bool)
    marked[lms] = True
    names = _name(s, lms, rough[marked[rough]])
    return induce(s, small, lms[_sort_names(names, depth)], buckets)


def common_prefixes(text: np.ndarray, array: np.ndarray, depth: int) -> np.ndarray:
    """By text position, the bytes its suffix shares with the one before it in the array, at most ``depth``.

    Eight bytes are compared at a time; ``text`` is followed by at least ``depth`` + 8 bytes that count as its own.
    """
    before = np.empty(len(array), np.int64)
    before[array[1:]] = array[:-1]
    before[array[0]] = array[0]
    eights = np.ndarray((len(text) - 7,), "<u8", np.ascontiguousarray(text), strides=(1,))
    shared = np.zeros(len(array), np.int64)
    live = np.arange(len(array))
    for k in range(0, depth, 8):
        apart = eights[live + k] ^ eights[before[live] + k]
        low = apart & (~apart + np.uint64(1))
        equal = np.where(apart == 0, 8, np.bitwise_count(low - np.uint64(1)).astype(np.int64) // 8)
        shared[live] += equal
        live = live[equal == 8]
    shared[array[0]] = 0
    return np.minimum(shared, depth)
