import numpy as np
import pytest
from pyspark.sql import functions as F

from answerloom.functions import cells as C
from answerloom.functions import vectors as V
from answerloom.operators import cells, retrieve


def unit_rows(n, dim, seed):
    x = np.random.default_rng(seed).normal(size=(n, dim))
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)


def frame(spark, rows, prefix, key):
    return spark.createDataFrame(
        [(f"{prefix}{i:04d}", [float(v) for v in r]) for i, r in enumerate(rows)], f"{key} string, embedding array<float>")


def plain_best(queries, vectors, k):
    scores = np.round(queries.astype(np.float64) @ vectors.astype(np.float64).T, 6)
    return [[(j, row[j]) for j in sorted(range(len(vectors)), key=lambda j: (-row[j], j))[:k]] for row in scores]


@pytest.mark.parametrize("queries, vectors", [
    (unit_rows(40, 8, 1), unit_rows(3000, 8, 2)),
    (np.zeros((3, 8), np.float32), unit_rows(2000, 8, 3)),  # all scores equal
    (unit_rows(5, 4, 4), np.repeat(unit_rows(3, 4, 5), 700, axis=0)),  # many copies
    (unit_rows(4, 4, 6), unit_rows(2, 4, 7)),  # fewer vectors than k
    (unit_rows(4, 4, 8).astype(np.float64) * 1e25, unit_rows(50, 4, 9).astype(np.float64) * 1e-25),
])
def test_leading_vectors_are_those_of_the_full_products(queries, vectors):
    rows, columns, scores, checked = V.leading(queries, vectors, 5, width=256)
    found = [[(c, s) for r, c, s in zip(rows, columns, scores) if r == i] for i in range(len(queries))]
    assert [[c for c, _ in f] for f in found] == [[c for c, _ in f] for f in plain_best(queries, vectors, 5)]
    assert np.allclose([s for f in found for _, s in f], [s for f in plain_best(queries, vectors, 5) for _, s in f], atol=1e-9)
    assert (checked <= 4 * 5 * 16 + 16 * len(vectors) // 256 * 5).all()


def test_scores_below_the_bound_are_left_out():
    queries, vectors = unit_rows(6, 8, 1), unit_rows(500, 8, 2)
    want = plain_best(queries, vectors, 3)
    least = np.array([w[1][1] for w in want])
    rows, columns, _, _ = V.leading(queries, vectors, 3, least)
    assert [c for r, c in zip(rows, columns) if r == 2] == [c for c, s in want[2] if s >= least[2]]


def test_nearest_centroid_of_equal_ones_is_the_first():
    vectors = unit_rows(200, 6, 3).astype(np.float64)
    centroids = C.unit(np.concatenate([unit_rows(5, 6, 4), unit_rows(5, 6, 4)]))
    assert (C.nearest(vectors, centroids) == np.round(vectors @ centroids.T, 9).argmax(axis=1)).all()


def _exchanged(df):
    """Rows that the shuffles of the plan move, by its text: no side is repeated for the blocks of the other."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("explode(")


def test_large_batches_do_not_repeat_either_side(spark):
    queries, vectors = frame(spark, unit_rows(60, 8, 1), "q", "query_id"), frame(spark, unit_rows(300, 8, 2), "x", "chunk_id")
    blocks = retrieve.knn_blocks(queries, vectors, 3, query_block=7, vector_block=11)
    by_cells = retrieve.knn_cells(queries, vectors, 3, planes=3, probes=2, broadcast_bytes=1, query_block=7)
    assert _exchanged(blocks) == 0 and _exchanged(by_cells) == 0
    assert blocks.count() == 180


def test_large_batch_in_learned_cells_is_one_search(spark, monkeypatch):
    q, x = unit_rows(60, 8, 1), unit_rows(400, 8, 2)
    x[9] = x[4]
    queries, vectors = frame(spark, q, "q", "query_id"), frame(spark, x, "x", "chunk_id")
    index = cells.cells_over(vectors, 6)
    small = cells.search_cells(queries, index, 3, probes=2)
    monkeypatch.setattr(cells, "_search_block", None)  # no search for each block of queries
    dealt = cells.search_cells(queries, index, 3, probes=2, block_bytes=600)
    columns = ["query_id", "chunk_id", "cell", "score", "rank"]
    assert sorted(dealt.hits.select(columns).collect()) == sorted(small.hits.select(columns).collect())
    figures = ["query_id", "rows_probed", "rows_coded", "rows_skipped", "proven"]
    assert sorted(dealt.report.select(figures).collect()) == sorted(small.report.select(figures).collect())
    quick = cells.search_cells(queries, index, 3, probes=1, complete=False, block_bytes=600)
    assert quick.report.filter("not proven").count() > 0
    exact = {r.query_id: r.chunk_id for r in small.hits.filter(F.col("rank") == 1).collect()}
    sure = {r.query_id for r in quick.report.filter("proven").collect()}
    assert all(exact[r.query_id] == r.chunk_id for r in quick.hits.filter("rank = 1").collect() if r.query_id in sure)


def test_large_batch_takes_repeated_keys_as_a_small_one(spark):
    x = unit_rows(40, 8, 2)
    queries, vectors = frame(spark, unit_rows(20, 8, 1), "q", "query_id"), frame(spark, x, "x", "chunk_id")
    index = cells.cells_over(vectors.unionByName(vectors.filter("chunk_id < 'x0020'")), 4)
    columns = ["query_id", "chunk_id", "score", "rank"]
    small = cells.search_cells(queries, index, 5, probes=1).hits.select(columns)
    dealt = cells.search_cells(queries, index, 5, probes=1, block_bytes=600).hits.select(columns)
    assert sorted(dealt.collect()) == sorted(small.collect())
