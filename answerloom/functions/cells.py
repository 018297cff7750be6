"""Numpy kernels of learned cells: nearest centroid, caps around centroids, and short codes with a bound on their error."""

from __future__ import annotations

import numpy as np

from answerloom.functions.vectors import product_error

#: Scores are rounded to six digits before they are ranked; bounds leave room for that.
MARGIN = 2e-6
_TILE = 4_000_000
_LEVELS = 127
#: Unit roundoff of the 32-bit products of queries and codes.
_ROUNDOFF = 6e-8


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; a row of zeros becomes the first axis."""
    length = np.linalg.norm(rows, axis=1, keepdims=True)
    out = rows / np.where(length == 0, 1, length)
    out[length[:, 0] == 0, :1] = 1
    return out


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Number of the centroid with the best score; the smaller one of equal ones.

    By products of 32 bits, where these leave one centroid only; the other rows are scored with 64 bits.
    """
    out = np.zeros(len(vectors), np.int32)
    step = max(1, _TILE // len(centroids))
    with np.errstate(over="ignore", invalid="ignore"):
        slack, rough = 2 * product_error(vectors, centroids) + 1e-8, centroids.astype(np.float32).T
    for start in range(0, len(vectors), step):
        some = vectors[start : start + step]
        with np.errstate(over="ignore", invalid="ignore"):
            scores = some.astype(np.float32) @ rough
            best = scores.argmax(axis=1)
            least = scores[np.arange(len(some)), best] - slack[start : start + step]
            near = np.count_nonzero(scores >= least.astype(np.float32)[:, None], axis=1)
        out[start : start + step] = best
        open_rows = np.flatnonzero((near != 1) | ~np.isfinite(least))
        if len(open_rows):
            out[start + open_rows] = np.round(some[open_rows] @ centroids.T, 9).argmax(axis=1)
    return out


def cell_sums(vectors: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cells that occur, their rows and the sums of their vectors."""
    order = np.argsort(own, kind="stable")
    cells, first, counts = np.unique(own[order], return_index=True, return_counts=True)
    return cells, counts, np.add.reduceat(vectors[order], first, axis=0)


def caps(vectors: np.ndarray, own: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, ...]:
    """For each cell that occurs: rows, least cosine to the centroid, least and greatest length."""
    length = np.linalg.norm(vectors, axis=1)
    cosine = (vectors * centroids[own]).sum(axis=1) / np.where(length == 0, 1, length)
    cosine = np.where(length == 0, 1, cosine)  # no direction: the lengths bound it
    order = np.argsort(own, kind="stable")
    cells, first, counts = np.unique(own[order], return_index=True, return_counts=True)
    least = [np.minimum.reduceat(x[order], first) for x in (cosine, length)]
    return cells, counts, least[0], least[1], np.maximum.reduceat(length[order], first)


def cap_bounds(queries: np.ndarray, centroids: np.ndarray, cap: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The best score that any vector of each cell can have, query by cell.

    A vector at an angle of at most `b` from the centroid, which is `a` away from the query, is at least `a - b` away.
    """
    length = np.linalg.norm(queries, axis=1)
    cosine = np.clip(queries @ centroids.T / np.where(length == 0, 1, length)[:, None], -1, 1)
    cap = np.clip(cap, -1, 1)
    best = np.where(cosine >= cap, 1.0, cosine * cap + np.sqrt(1 - cosine**2) * np.sqrt(1 - cap**2))
    return length[:, None] * np.where(best >= 0, high, low) * best + MARGIN


def encode(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One signed byte a dimension, the scale of each row, and a bound on the distance between row and code."""
    scale = (np.abs(vectors).max(axis=1, initial=0) / _LEVELS).astype(np.float32)
    scale[scale == 0] = 1
    codes = np.clip(np.rint(vectors / scale[:, None].astype(np.float64)), -_LEVELS, _LEVELS).astype(np.int8)
    error = np.linalg.norm(vectors - codes * scale[:, None].astype(np.float64), axis=1)
    return codes, scale, np.nextafter((error * (1 + 1e-6)).astype(np.float32), np.float32(np.inf))


def code_scores(queries: np.ndarray, codes: np.ndarray, scale: np.ndarray, error: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Scores by codes, and how far the true ones may be from them, query by row."""
    length = np.linalg.norm(queries, axis=1)[:, None]
    plain = codes.astype(np.float32)
    scores = (queries.astype(np.float32) @ plain.T) * scale
    rounding = 2 * _ROUNDOFF * (codes.shape[1] + 4) * np.linalg.norm(plain, axis=1) * scale
    return scores, length * (error + rounding) + MARGIN


def first_twins(twins: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Which rows are among the first k of their equal vectors; no other can be among the k best of anything."""
    order = np.lexsort((ids, twins))
    new = np.ones(len(order), bool)
    new[1:] = twins[order][1:] != twins[order][:-1]
    start = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    out = np.zeros(len(order), bool)
    out[order] = np.arange(len(order)) - start < k
    return out


def candidates(scores: np.ndarray, slack: np.ndarray, least: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows may be among the k best of each query, whose k-th best score is `least` or more; and `least` raised by
    what these rows show."""
    lower = scores - slack
    if scores.shape[1] >= k:
        kth = -np.partition(-lower, k - 1, axis=1)[:, k - 1]
        least = np.maximum(least, kth)
    return scores + slack >= least[:, None] - MARGIN, least
