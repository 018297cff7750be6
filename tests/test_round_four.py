"""Large query batches."""

import tracemalloc

import numpy as np

from answerloom.functions import vectors as V


def test_products_of_all_tiles_share_their_memory():
    rng = np.random.default_rng(5)
    queries, vectors = (rng.normal(size=(n, 16)).astype(np.float32) for n in (976, 20_480))
    least = np.sort(queries.astype(float) @ vectors.T.astype(float), axis=1)[:, -5]
    tracemalloc.start()
    rows, columns, scores, _ = V.leading(queries, vectors, 5, np.round(least, 6))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 12_000_000  # a tile has a million products; 15 MB with fresh memory for each
    expected = np.argsort(-(queries.astype(float) @ vectors.T.astype(float)), axis=1)[:, :5]
    assert np.array_equal(columns.reshape(-1, 5), expected)


def test_set_places_at_all_lengths():
    rng = np.random.default_rng(6)
    for n in (0, 1, 7, 8, 9, 1000, 1023):
        flags = np.ones(-(-n // 8) * 8, bool)
        flags[:n] = rng.random(n) < 0.1
        expected = np.flatnonzero(flags[:n])
        assert np.array_equal(V._set_places(flags, n), expected)
