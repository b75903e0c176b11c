"""Eigenvectors of a symmetric matrix: single precision first, then refined by matrix products in higher precision.

After T. Ogita and K. Aishima, "Iterative refinement for symmetric eigenvalue decomposition" (2018) and its second part
on clustered eigenvalues (2019).
"""

from __future__ import annotations

import numpy as np


def _correct(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, float, float]:
    """One refinement: better vectors, their values, the distance below which values count as clustered, and the change."""
    lack = np.eye(len(a), dtype=a.dtype) - x.T @ x
    inner = x.T @ (a @ x)
    values = np.diag(inner) / (1 - np.diag(lack))
    norm = lambda m: np.sqrt((m * m).sum())
    # The norms of the whole matrices stand for the spectral norms, which they bound.
    near = 2 * (norm(inner - np.diag(values)) + norm(a) * norm(lack))
    # Closer values would turn the rounding of the products into changes that are not small any more.
    near = max(near, np.sqrt(np.finfo(a.dtype).eps) * norm(a))
    gap = values[None, :] - values[:, None]
    apart = np.abs(gap) > near
    change = np.where(apart, (inner + values[None, :] * lack) / np.where(apart, gap, 1), lack / 2)
    return x + x @ change, values, near, np.abs(change).max()


def _clusters(values: np.ndarray, near: float) -> list[np.ndarray]:
    """Index sets of two or more values in which each is within ``near`` of the next."""
    order = np.argsort(values)
    cuts = np.flatnonzero(np.diff(values[order]) > near) + 1
    return [c for c in np.split(order, cuts) if len(c) > 1]


def _resolve(a: np.ndarray, x: np.ndarray, cluster: np.ndarray) -> np.ndarray:
    """The vectors of a cluster, turned within the space they span by a small eigenproblem of their own.

    The mean value is taken off first, so the small matrix holds the differences within the cluster only and resolves
    them to its own scale.
    """
    span = x[:, cluster]
    inner = span.T @ (a @ span)
    small = inner - (np.trace(inner) / len(cluster)) * (span.T @ span)
    small = (small + small.T) / 2
    scale = np.abs(small).max()
    if scale == 0:
        return span
    _, turn = np.linalg.eigh((small / scale).astype(np.float64))
    return span @ turn.astype(a.dtype)


def _refine(a: np.ndarray, x: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    goal = 4 * np.finfo(a.dtype).eps * len(a)
    for _ in range(most):
        x, values, near, change = _correct(a, x)
        for cluster in _clusters(values, near):
            x[:, cluster] = _resolve(a, x, cluster)
        if change <= goal:
            break
    return _correct(a, x)[:2]


def eigenpairs(matrix: np.ndarray, most: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Falling eigenvalues and the unit eigenvectors (columns) of a symmetric matrix, to double precision.

    The first vectors are those of the matrix in single precision. They are refined in double and then in extended
    precision, each until the change is at the rounding level or ``most`` times; a refinement about doubles the right
    digits. Values closer together than the present error allows to separate form a cluster, whose vectors are
    resolved by an eigenproblem of the cluster's size before the next refinement. Vectors of equal values are any
    orthonormal basis of their space.
    """
    size = np.abs(matrix).max() if matrix.size else 0.0
    if size == 0:
        return np.zeros(len(matrix)), np.eye(len(matrix))
    scaled = matrix / size
    _, x = np.linalg.eigh(scaled.astype(np.float32))
    for kind in (np.float64, np.longdouble):
        x, values = _refine(scaled.astype(kind), x.astype(kind), most)
    order = np.argsort(-values, kind="stable")
    x = x[:, order] / np.sqrt((x[:, order] ** 2).sum(0))
    return (values[order] * size).astype(np.float64), x.astype(np.float64)
