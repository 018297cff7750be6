"""Learned cells: search against brute force, the stored index by generations, reading rows by place."""

import os
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from answerloom.functions import cells as C
from answerloom.operators import cell_index, cells
from answerloom.operators.embed import HashedWords
from test_retrieve import brute, found, frame, unit_rows

EMBEDDER = HashedWords(64)


@pytest.fixture(scope="module")
def data(spark):
    x = unit_rows(900, 16, 2, centres=12)
    q = np.concatenate([unit_rows(20, 16, 5, centres=12), unit_rows(20, 16, 6)])
    x[100:160] = x[100]  # more equal vectors than k
    x[200] = 0
    q[3] = x[100]
    q[4] = 0
    return q, x, frame(spark, q, "q", "query_id"), frame(spark, x, "x", "chunk_id")


@pytest.fixture(scope="module")
def index(data):
    return cells.cells_over(data[3], 24)


def test_kernels_bound_what_they_say():
    rng = np.random.default_rng(1)
    x, q = rng.normal(size=(300, 20)) * rng.uniform(0, 3, (300, 1)), rng.normal(size=(15, 20))
    centroids = C.unit(rng.normal(size=(9, 20)))
    own = C.nearest(x, centroids)
    numbers, counts, cap, low, high = C.caps(x, own, centroids)
    assert counts.sum() == 300
    bounds = C.cap_bounds(q, centroids[numbers], cap, low, high)
    for i, cell in enumerate(numbers):
        assert ((q @ x[own == cell].T).max(axis=1) <= bounds[:, i]).all()
    scores, slack = C.code_scores(q, *C.encode(x))
    lengths = np.linalg.norm(q, axis=1)[:, None] * np.linalg.norm(x, axis=1)
    assert (np.abs(scores - q @ x.T) <= slack).all() and (slack <= 0.02 * lengths + 1e-5).all()


def test_search_is_exact_and_caps_leave_cells_out(data, index):
    q, x, queries, _ = data
    result = cells.search_cells(queries, index, 5, probes=2)
    assert found(result.hits) == brute(q, x, 5)
    report = result.report.collect()
    assert len(report) == len(q) and all(r.proven for r in report)
    assert all(r.rows_probed + r.rows_coded + r.rows_skipped == len(x) for r in report)
    near = [r for r in report if int(r.query_id[1:]) < 20 and r.query_id not in ("q0003", "q0004")]
    assert np.mean([r.rows_skipped for r in near]) > 0.5 * len(x)  # these lie in clusters
    assert np.mean([r.rows_checked for r in report if r.query_id != "q0004"]) < 0.1 * len(x)


def test_blocks_of_queries_give_the_same(data, index):
    q, x, queries, _ = data
    assert found(cells.search_cells(queries, index, 3, probes=1, block_bytes=2000).hits) == brute(q, x, 3)


def test_incomplete_search_proves_only_what_is_exact(data, index):
    q, x, queries, _ = data
    result = cells.search_cells(queries, index, 5, probes=2, complete=False)
    proven = {r.query_id for r in result.report.filter("proven").collect()}
    hits, want = found(result.hits), brute(q, x, 5)
    assert 0 < len(proven) < len(q)
    assert {h for h in hits if h[0] in proven} == {w for w in want if w[0] in proven}


def test_few_rows_no_rows_no_queries(data, spark):
    q, x, queries, vectors = data
    few = cells.cells_over(vectors.filter("chunk_id < 'x0003'"), 8)
    assert found(cells.search_cells(queries, few, 5).hits) == brute(q, x[:3], 5)
    none = cells.cells_over(vectors.limit(0), 8)
    empty = cells.search_cells(queries, none, 5)
    assert empty.hits.count() == 0 and empty.report.filter("proven").count() == len(q)
    assert cells.search_cells(queries.limit(0), few, 5).hits.count() == 0


def test_centroids_do_not_follow_the_partitioning(data):
    vectors = data[3]
    one, many = (cells.train_cells(vectors.repartition(n), 10) for n in (1, 7))
    assert np.allclose(one, many, atol=1e-6)
    assert cells.train_cells(vectors, 10_000).shape[0] <= 900
    with pytest.raises(ValueError):
        cells.train_cells(vectors, 0)


# --- the stored index -----------------------------------------------------------------------------


def chunk_rows(spark, texts):
    rows = [(f"doc/{p}", t) for p, t in texts]
    return spark.createDataFrame(rows, "path string, chunked_text string").withColumn("chunk_id", F.md5("chunked_text"))


def words(rng):
    return " ".join(f"w{i}" for i in rng.integers(0, 50, 12))


@pytest.fixture
def stored(spark, tmp_path):
    rng = np.random.default_rng(8)
    texts = [(i, words(rng)) for i in range(300)] + [(900, "shared text"), (901, "shared text")]
    folder = str(tmp_path / "index")
    return folder, texts, cell_index.ensure_cell_index(spark, folder, chunk_rows(spark, texts), "sync", EMBEDDER, 10)


def state(index):
    return {tuple(r) for r in index.rows.select("chunk_id", "chunked_text", "path", F.hash("embedding")).collect()}


def test_sync_writes_touched_cells_only(spark, stored):
    folder, texts, before = stored
    old_state, old_files = state(before), set(before.rows.inputFiles())
    changed = texts[1:-2] + [(901, "shared text"), (500, "an entirely new text")]  # one gone, one moved, one new
    after = cell_index.ensure_cell_index(spark, folder, chunk_rows(spark, changed), "sync", EMBEDDER)
    fresh = cell_index.ensure_cell_index(spark, folder + "-2", chunk_rows(spark, changed), "create_if_missing", EMBEDDER, 10)
    assert state(after) == state(fresh)
    touched = {f for f in after.rows.inputFiles() if f not in old_files}
    assert 0 < len(touched) <= 3 and len(set(after.rows.inputFiles()) & old_files) >= 7
    assert state(before) == old_state  # an open reader keeps its generation
    assert state(cell_index.open_index(spark, folder, 0)) == old_state
    assert cell_index.generations(spark, folder) == [0, 1]
    same = cell_index.ensure_cell_index(spark, folder, chunk_rows(spark, changed), "sync", EMBEDDER)
    assert cell_index.generations(spark, folder) == [0, 1] and state(same) == state(after)

    caps = cells.cell_caps(after.rows, after.centroids).orderBy("cell").toArrow()
    assert after.n_rows.tolist() == caps["n_rows"].to_pylist()
    assert np.allclose(after.cap, caps["cap"].to_numpy(), atol=1e-6)

    assert cell_index.drop_generations(spark, folder) > 0
    assert cell_index.generations(spark, folder) == [1] and state(after) == state(fresh)
    kept = {f"cell={c}/generation={g}" for c, g in cell_index._used(cell_index._cells_of(spark, folder, 1))}
    assert kept == {f"{c}/{g}" for c in os.listdir(f"{folder}/rows") if c.startswith("cell") for g in os.listdir(f"{folder}/rows/{c}")}


def test_a_sync_that_stops_is_as_if_it_never_was(spark, stored, monkeypatch):
    folder, texts, before = stored
    changed = chunk_rows(spark, [*texts[5:], (600, "another text")])

    def stop(*_):
        raise RuntimeError("stopped")

    with monkeypatch.context() as patch:
        patch.setattr(cell_index, "_publish", stop)
        with pytest.raises(RuntimeError):
            cell_index.ensure_cell_index(spark, folder, changed, "sync", EMBEDDER)
    assert cell_index.generations(spark, folder) == [0]
    assert state(cell_index.open_index(spark, folder)) == state(before)
    after = cell_index.ensure_cell_index(spark, folder, changed, "sync", EMBEDDER)
    assert cell_index.generations(spark, folder) == [0, 2]  # the number of the stopped one is not used again
    assert len(state(after)) == 297


def test_modes_rejects_and_an_index_that_begins_empty(spark, tmp_path):
    folder = str(tmp_path / "index")
    with pytest.raises(ValueError):
        cell_index.open_index(spark, folder)
    none = cell_index.ensure_cell_index(spark, folder, chunk_rows(spark, [("0", "x")]).limit(0), embedder=EMBEDDER)
    assert none.rows.count() == 0

    def refusing(texts):
        if any("bad" in t for t in texts):
            raise ValueError("no")
        return EMBEDDER(texts)

    some = chunk_rows(spark, [(1, "good text"), (2, "bad text"), (3, "more text")])
    assert cell_index.ensure_cell_index(spark, folder, some, embedder=EMBEDDER).rows.count() == 0  # kept as it is
    assert cell_index.ensure_cell_index(spark, folder, some, "sync", refusing).rows.count() == 2
    assert [r.status for r in spark.read.parquet(f"{folder}/rejected").collect()] == ["ERROR: no"]
    assert cell_index.ensure_cell_index(spark, folder, some, "sync", EMBEDDER).rows.count() == 3  # tried again
    assert cell_index.ensure_cell_index(spark, folder, some.limit(1), "rebuild", EMBEDDER).rows.count() == 1
    gone = cell_index.ensure_cell_index(spark, folder, some.limit(0), "sync", EMBEDDER)
    assert gone.rows.count() == 0
    assert cell_index.ensure_cell_index(spark, folder, some, "sync", EMBEDDER).rows.count() == 3


def test_texts_are_fetched_by_cell_and_key(spark, stored):
    folder, texts, index = stored
    questions = spark.createDataFrame([(1, texts[7][1]), (2, texts[90][1])], "query_id long, query string")
    hits, search = cell_index.search_index(questions, index, embedder=EMBEDDER)
    best = {r.query_id: r.chunk_text for r in hits.filter("rank = 1").collect()}
    assert best == {1: texts[7][1], 2: texts[90][1]} and hits.count() == 10
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    plan = hits.select("chunk_text")._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    scan = next(line for line in plan.splitlines() if "PartitionFilters" in line and "chunked_text" in line)
    lists = [{int(c) for c in x.split(",")} for x in re.findall(r"cell#\d+ IN \(([\d,]+)\)", scan.split("PartitionFilters")[1])]
    hit_cells = {r.cell for r in search.hits.collect()}
    assert hit_cells in lists and len(hit_cells) < len(index.cells)
    assert re.search(r"PushedFilters: \[Or\(.*EqualTo\(chunk_id", scan)  # files sorted by key skip pages
    assert "embedding" not in scan  # vectors are not read for texts


def test_more_places_than_may_be_sent_around(data, index, monkeypatch):
    q, x, queries, _ = data
    monkeypatch.setattr(cells, "BROADCAST_PLACES", 3)
    assert found(cells.search_cells(queries, index, 5, probes=1).hits) == brute(q, x, 5)


def test_the_index_is_not_shuffled_by_a_search(data, index):
    plan = cells.search_cells(data[2], index, 5, probes=2).hits._jdf.queryExecution().toString()
    assert "embedding" not in "".join(line for line in plan.splitlines() if "Exchange" in line)
