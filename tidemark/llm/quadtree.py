"""A K-squared tree (k = 2) over a sparse matrix, and two of them walked together."""

from __future__ import annotations

import numpy as np

#: The tree ends in leaves of 8 x 8 cells, which are kept as they are.
BITS = 3
SIDE = 1 << BITS
#: Leaf pairs that are spread out at a time: 512 products each.
WIDE = 4096


def _code(row: np.ndarray, col: np.ndarray) -> np.ndarray:
    return (row << 32) | col


class Quadtree:
    """Levels of sorted codes of the quadrants that hold any cell, from the leaves up, and the leaves' cells.

    ``rows`` and ``cols`` number the cells from 0, each cell once; ``empty`` has the value of a row where it has no cell.
    """

    def __init__(self, rows: np.ndarray, cols: np.ndarray, values: np.ndarray, empty: np.ndarray, height: int):
        code = _code(rows >> BITS, cols >> BITS)
        order = np.argsort(code, kind="stable")
        self.rows, self.cols, self.values, self.empty = rows[order], cols[order], values[order], empty
        leaves, starts = np.unique(code[order], return_index=True)
        self.starts = np.append(starts, len(order))
        self.levels = [leaves]
        for _ in range(height):
            below = self.levels[-1]
            self.levels.append(np.unique(_code(below >> 33, (below & 0xFFFFFFFF) >> 1)))

    def find(self, level: int, row: np.ndarray, col: np.ndarray) -> np.ndarray:
        """Index of each quadrant in its level, -1 for one without cells."""
        codes = self.levels[level]
        if not len(codes):
            return np.full(len(row), -1)
        wanted = _code(row, col)
        at = np.minimum(np.searchsorted(codes, wanted), len(codes) - 1)
        return np.where(codes[at] == wanted, at, -1)

    def spread(self, row: np.ndarray, col: np.ndarray) -> np.ndarray:
        """The leaves as full blocks; rows beyond the matrix repeat its last one and are of no use."""
        rows = np.minimum(row[:, None] * SIDE + np.arange(SIDE), len(self.empty) - 1)
        out = np.repeat(self.empty[rows][:, :, None], SIDE, axis=2)
        at = self.find(0, row, col)
        held = np.flatnonzero(at >= 0)
        counts = self.starts[at[held] + 1] - self.starts[at[held]]
        block = np.repeat(held, counts)
        cell = np.arange(counts.sum()) + np.repeat(self.starts[at[held]] - np.cumsum(counts) + counts, counts)
        out[block, self.rows[cell] & (SIDE - 1), self.cols[cell] & (SIDE - 1)] = self.values[cell]
        return out


def height(rows: int, cols: int) -> int:
    """Levels above the leaves of a tree whose root holds the whole matrix."""
    return max(0, (max(rows, cols, 1) - 1).bit_length() - BITS)


def gap(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


def joint_sums(left: Quadtree, right: Quadtree, cols: int) -> np.ndarray:
    """For each row of ``left`` and each of ``right``, the sum of ``gap`` over the columns below ``cols``.

    Both trees are walked from the root at once: a pair of row quadrants goes down at a column quadrant as long as one
    of the two holds a cell there. Where neither does, all its columns have the same price, that of the two empty
    values, so they are only counted. Leaves that remain are priced cell by cell.
    """
    n, m, same = len(left.empty), len(right.empty), left is right
    total = np.zeros((n, m), np.int64)
    uniform = np.zeros((n, m), np.int64)
    a, b, c = (np.zeros(1, np.int64) for _ in range(3))
    for level in range(len(left.levels) - 1, -1, -1):
        side = SIDE << level
        inside = (a * side < n) & (b * side < m) & (c * side < cols)
        inside &= (a <= b) | (not same)
        a, b, c = a[inside], b[inside], c[inside]
        held = (left.find(level, a, c) >= 0) | (right.find(level, b, c) >= 0)
        counted = np.zeros((-(-n // side), -(-m // side)), np.int64)
        np.add.at(counted, (a[~held], b[~held]), np.minimum(cols, (c[~held] + 1) * side) - c[~held] * side)
        uniform += counted[np.ix_(np.arange(n) // side, np.arange(m) // side)]
        a, b, c = a[held], b[held], c[held]
        if level:
            halves = np.arange(8)
            a, b, c = ((x[:, None] * 2 + (halves >> k & 1)).ravel() for k, x in enumerate((a, b, c)))
    blocks = np.zeros((-(-n // SIDE), -(-m // SIDE), SIDE, SIDE), np.int64)
    spare = np.zeros(blocks.shape[:2], np.int64)
    for at in range(0, len(a), WIDE):
        i, j, k = a[at: at + WIDE], b[at: at + WIDE], c[at: at + WIDE]
        priced = gap(left.spread(i, k)[:, :, None, :], right.spread(j, k)[:, None, :, :]).sum(3)
        np.add.at(blocks, (i, j), priced)
        # Columns of the last leaf that the matrix does not have were priced as empty ones.
        np.add.at(spare, (i, j), np.maximum(0, (k + 1) * SIDE - cols))
    total += blocks.transpose(0, 2, 1, 3).reshape(blocks.shape[0] * SIDE, -1)[:n, :m]
    uniform -= spare[np.ix_(np.arange(n) // SIDE, np.arange(m) // SIDE)]
    return total + uniform * gap(left.empty[:, None], right.empty[None, :])
