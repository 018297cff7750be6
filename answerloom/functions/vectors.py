"""Numpy kernels for blocks of vectors, called inside Arrow tasks.

Each works on one bounded block. Spark decides which rows meet in a block.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

SCORE_DIGITS = 6
_TILE_CELLS = 1_000_000
TILE_COLUMNS = 1024
#: Unit roundoff of 32-bit numbers.
_ROUNDOFF = 6e-8


def matrix(column: pa.Array | pa.ChunkedArray, plain: bool = False) -> np.ndarray:
    """A list column as a float64 matrix, one row per vector; with ``plain`` 32-bit numbers stay as they are."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks)
    if len(column) == 0:
        return np.zeros((0, 0))
    if column.null_count:
        raise ValueError("vectors must not be null")
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if flat.size % len(column):
        raise ValueError("vectors must all have the same length")
    rows = flat.reshape(len(column), -1)
    return rows if plain and rows.dtype == np.float32 else rows.astype(np.float64)


def keys(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Row keys as a sortable numpy array."""
    if pa.types.is_integer(column.type):
        return column.to_numpy() if isinstance(column, pa.ChunkedArray) else column.to_numpy(zero_copy_only=False)
    return np.array(column.to_pylist(), dtype=str)


def best_of_block(queries: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int):
    """Scores and ids of the k best vectors per query, best first.

    Scores are rounded before ranking and ties go to the smaller id, so that the
    outcome does not depend on how rows were spread over blocks.
    """
    order = np.argsort(ids, kind="stable")
    _, columns, scores, _ = leading(queries, vectors[order], k)
    width = min(k, len(vectors))
    return scores.reshape(len(queries), width), ids[order][columns].reshape(len(queries), width)


def product_error(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """For each query, how far a 32-bit product with any of the vectors may be from the true one."""
    longest = np.linalg.norm(vectors, axis=1).max(initial=0)
    return 2 * _ROUNDOFF * (vectors.shape[1] + 4) * np.linalg.norm(queries, axis=1).astype(np.float64) * float(longest)


@np.errstate(over="ignore", invalid="ignore")
def leading(queries: np.ndarray, vectors: np.ndarray, k: int, least: np.ndarray | None = None, width: int = TILE_COLUMNS):
    """Row, column and rounded score of the k best vectors of each query, best first and equal ones by column; and for each
    query the number of scores worked out in full.

    With ``least``, only vectors of that score or more are wanted. Products are made with 32 bits, tile by tile. What lies
    below the k-th best so far by more than their error is out, the rest is scored with 64 bits. A tile in which a query
    has very many such vectors, as equal ones are, is scored with 64 bits for this query.
    """
    n, checked = len(queries), np.zeros(len(queries), np.int64)
    if n == 0 or len(vectors) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), checked
    least = np.full(n, -np.inf) if least is None else least
    margin = product_error(queries, vectors) + 10.0**-SCORE_DIGITS
    rough, rows32 = queries.astype(np.float32, copy=False), vectors.astype(np.float32, copy=False)
    broad = ~np.isfinite(margin)  # too large for 32 bits
    margin[broad] = np.inf
    most, parts = 4 * k + 16, []
    step = max(1, _TILE_CELLS // min(width, len(vectors)))
    # one place for the products of all tiles: fresh memory for each costs as much as the comparison
    room = np.empty(min(step, n) * min(width, len(vectors)), np.float32)
    flags = np.empty(-(-len(room) // 8) * 8, bool)
    for start in range(0, n, step):
        own = slice(start, min(n, start + step))
        floor, best = least[own] - margin[own], np.full((own.stop - start, k), -np.inf, np.float32)
        found = []
        for left in range(0, len(vectors), width):
            tile = rows32[left : left + width]
            shape = (own.stop - start, len(tile))
            scores = np.matmul(rough[own], tile.T, out=room[: shape[0] * shape[1]].reshape(shape))
            if left == 0 and len(tile) > k:
                head = scores[:, : max(512, 16 * k)]
                kth = np.partition(head, head.shape[1] - k, axis=1)[:, head.shape[1] - k]
                floor = np.fmax(floor, kth - 2 * margin[own])
            above = flags[: scores.size].reshape(shape)
            np.greater_equal(scores, np.nextafter(floor.astype(np.float32), np.float32(-np.inf))[:, None], out=above)
            rows, columns = np.divmod(_set_places(flags, above.size), len(tile))
            crowded = np.flatnonzero((np.bincount(rows, minlength=shape[0]) > most) | broad[own])
            if len(crowded):
                others = ~np.isin(rows, crowded)
                rows, columns = rows[others], columns[others]
                for some in np.array_split(crowded, -(-len(crowded) * len(tile) // _TILE_CELLS)):
                    exact = np.round(queries[own][some].astype(np.float64) @ vectors[left : left + width].astype(np.float64).T, SCORE_DIGITS)
                    if len(tile) > k:
                        chosen = _leading_columns(exact, k)
                    else:
                        chosen = np.broadcast_to(np.arange(len(tile)), exact.shape)
                    found.append((np.repeat(some, chosen.shape[1]), left + chosen.ravel(), np.full(chosen.size, np.inf, np.float32)))
                    best[some] = _kth_first(best[some], np.take_along_axis(exact, chosen, 1).astype(np.float32), k)
            if len(rows):
                values = scores[rows, columns]
                found.append((rows, left + columns, values))
                order = np.lexsort((-values, rows))
                some, place = _places(rows[order])
                grid = np.full((len(some), k), -np.inf, np.float32)
                inside = place[1] < k
                grid[place[0][inside], place[1][inside]] = values[order][inside]
                best[some] = _kth_first(best[some], grid, k)
            if len(rows) or len(crowded):
                floor = np.fmax(floor, best[:, k - 1] - 2 * margin[own])
        if not found:
            continue
        rows, columns, values = (np.concatenate(x) for x in zip(*found))
        maybe = values >= floor[rows]
        rows, columns = rows[maybe] + start, columns[maybe]
        exact = np.empty(len(rows))
        for at in range(0, len(rows), 16_384):
            some = slice(at, at + 16_384)
            exact[some] = np.einsum("ij,ij->i", queries[rows[some]].astype(np.float64), vectors[columns[some]].astype(np.float64))
        exact = np.round(exact, SCORE_DIGITS)
        checked += np.bincount(rows, minlength=n)
        enough = ~(exact < least[rows])
        rows, columns, exact = rows[enough], columns[enough], exact[enough]
        order = np.lexsort((columns, -exact, rows))
        rows, columns, exact = rows[order], columns[order], exact[order]
        first = _places(rows)[1][1] < k
        parts.append((rows[first], columns[first], exact[first]))
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), checked
    return *(np.concatenate(x) for x in zip(*parts)), checked


def _set_places(flags: np.ndarray, n: int) -> np.ndarray:
    """Which of the first `n` flags are set, few of them as a rule; looked for eight at a time."""
    end = -(-n // 8) * 8
    flags[n:end] = False
    some = np.flatnonzero(flags[:end].view(np.uint64) != 0)
    word, place = np.nonzero(flags[:end].reshape(-1, 8)[some])
    return 8 * some[word] + place


def _places(rows: np.ndarray) -> tuple[np.ndarray, tuple[np.ndarray, np.ndarray]]:
    """Of sorted row numbers: the distinct ones; and for each entry the number of its row among them and its place in it."""
    some, first, counts = np.unique(rows, return_index=True, return_counts=True)
    return some, (np.repeat(np.arange(len(some)), counts), np.arange(len(rows)) - np.repeat(first, counts))


def _kth_first(a: np.ndarray, b: np.ndarray, k: int) -> np.ndarray:
    """The k best of two lists of scores by row, best first."""
    return -np.sort(-np.concatenate([a, b], axis=1), axis=1)[:, :k]


def _leading_columns(scores: np.ndarray, k: int) -> np.ndarray:
    """Column numbers of the k best scores per row; equal scores keep the leftmost columns."""
    threshold = -np.partition(-scores, k - 1, axis=1)[:, k - 1:k]
    above = scores > threshold
    room = k - above.sum(axis=1, keepdims=True)
    level = scores == threshold
    chosen = above | (level & (np.cumsum(level, axis=1) <= room))
    return np.nonzero(chosen)[1].reshape(len(scores), k)


def merge_best(scores_a, ids_a, scores_b, ids_b, k: int):
    """The k best of two candidate lists per query, by score and then by id."""
    scores = np.concatenate([scores_a, scores_b], axis=1)
    ids = np.concatenate([ids_a, ids_b], axis=1)
    by_id = np.argsort(ids, axis=1, kind="stable")
    scores, ids = np.take_along_axis(scores, by_id, 1), np.take_along_axis(ids, by_id, 1)
    by_score = np.argsort(-scores, axis=1, kind="stable")[:, :k]
    return np.take_along_axis(scores, by_score, 1), np.take_along_axis(ids, by_score, 1)


def sign_planes(dim: int, planes: int) -> np.ndarray:
    """Orthonormal directions: rows 1..planes of a Hadamard matrix, cut from a rule.

    Entry (i, j) is +1 or -1 by the parity of the common bits of i and j. A vector
    whose length is no power of two is taken as padded with zeros.
    """
    width = 1 << max(1, (dim - 1).bit_length())
    if planes >= width:
        raise ValueError("fewer planes than vector dimensions are needed")
    common = np.arange(1, planes + 1)[:, None] & np.arange(dim)[None, :]
    parity = np.zeros_like(common)
    while common.any():
        parity ^= common & 1
        common = common >> 1
    return (1.0 - 2.0 * parity) / np.sqrt(width)


def margins(vectors: np.ndarray, planes: int) -> np.ndarray:
    """Signed distance of each vector to each plane; rounded, so that a zero is a zero everywhere."""
    if len(vectors) == 0:
        return np.zeros((0, planes))
    return np.round(vectors @ sign_planes(vectors.shape[1], planes).T, 9) + 0.0


def cells(vectors: np.ndarray, planes: int) -> np.ndarray:
    """Cell number of each vector: one bit per plane, set on the non-negative side."""
    return (margins(vectors, planes) >= 0) @ (1 << np.arange(planes))


def nearest_cells(vectors: np.ndarray, planes: int, probes: int):
    """The cells to probe per query, and the best score any other cell could still hold.

    The planes are orthonormal, so a unit vector on the other side of a set of
    planes scores at most sqrt(|q|^2 - sum of the squared margins to those planes).
    """
    gap = margins(vectors, planes)
    home = (gap >= 0).astype(np.int64)
    every = (np.arange(1 << planes)[:, None] >> np.arange(planes)) & 1
    squared = gap**2
    # Cost of a cell: squared margins of the planes on which it differs from home.
    cost = np.round(_flip_cost(squared, home, every), 9)
    ranked = np.argsort(cost, axis=1, kind="stable")
    chosen = ranked[:, :probes]
    if probes >= 1 << planes:
        bound = np.full(len(vectors), -1.0)
    else:
        next_cost = np.take_along_axis(cost, ranked[:, probes:probes + 1], 1)[:, 0]
        norm = (vectors**2).sum(axis=1)
        bound = np.sqrt(np.maximum(norm - next_cost, 0.0))
    return chosen, bound


def _flip_cost(squared: np.ndarray, home: np.ndarray, every: np.ndarray) -> np.ndarray:
    """Sum of squared margins over the planes where a cell's bit differs from the home bit."""
    set_at_home = squared * home
    clear_at_home = squared * (1 - home)
    return set_at_home @ (1 - every).T + clear_at_home @ every.T
