import numpy as np
import pytest
from pyspark.sql import functions as F

from answerloom.conf import IndexColumns, RetrieverSettings
from answerloom.functions import vectors as V
from answerloom.operators import embed, index, ranking, retrieve


def unit_rows(n, dim, seed, centres=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim))
    if centres:
        c = np.random.default_rng(0).normal(size=(centres, dim)) * 12
        x += c[rng.integers(0, centres, n)]
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)


def frame(spark, rows, prefix, key):
    return spark.createDataFrame(
        [(f"{prefix}{i:04d}", [float(v) for v in r]) for i, r in enumerate(rows)], f"{key} string, embedding array<float>")


def brute(q, x, k):
    scores = np.round(q.astype(np.float64) @ x.astype(np.float64).T, 6)
    return {(f"q{i:04d}", f"x{j:04d}", rank + 1) for i, row in enumerate(scores)
            for rank, j in enumerate(sorted(range(len(x)), key=lambda j: (-row[j], j))[:k])}


def found(df):
    return {(r.query_id, r.chunk_id, r["rank"]) for r in df.collect()}


@pytest.fixture(scope="module")
def data(spark):
    q, x = unit_rows(30, 16, 1), unit_rows(400, 16, 2)
    x[7] = x[3]  # equal vectors: the smaller id goes first
    return q, x, frame(spark, q, "q", "query_id"), frame(spark, x, "x", "chunk_id")


def test_exact_search_both_ways(data):
    q, x, queries, vectors = data
    want = brute(q, x, 5)
    assert found(retrieve.knn(queries, vectors, 5)) == want
    assert found(retrieve.knn(queries, vectors, 5, broadcast_bytes=1024)) == want  # too large to broadcast
    assert found(retrieve.knn_blocks(queries, vectors, 5, query_block=4, vector_block=30)) == want


def test_fewer_vectors_than_k(data):
    q, x, queries, vectors = data
    few = vectors.filter("chunk_id < 'x0003'")
    assert found(retrieve.knn(queries, few, 5)) == brute(q, x[:3], 5)
    assert retrieve.knn(queries.limit(0), vectors, 5).count() == 0
    assert retrieve.knn(queries, vectors.limit(0), 5).count() == 0


def test_cells_with_all_probes_are_exact(data):
    q, x, queries, vectors = data
    for limit in (1, 1 << 26):  # block join, then scan
        hits = retrieve.knn_cells(queries, vectors, 5, planes=4, probes=16, query_block=3, vector_block=9,
                                  broadcast_bytes=limit)
        assert found(hits) == brute(q, x, 5)
        assert hits.filter("not proven").count() == 0


def test_cell_search_is_the_same_by_scan_and_by_join(data, spark, tmp_path):
    q, x, queries, vectors = data
    retrieve.with_cell(vectors, 5).write.partitionBy("cell").parquet(str(tmp_path / "index"))
    table = spark.read.parquet(str(tmp_path / "index"))
    by_scan = retrieve.knn_cells(queries, table, 5, planes=5, probes=6)
    by_join = retrieve.knn_cells(queries, table, 5, planes=5, probes=6, query_block=4, vector_block=9, broadcast_bytes=1)
    assert found(by_scan) == found(by_join) == found(retrieve.knn_cells(queries, vectors, 5, planes=5, probes=6))
    plan = by_scan._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(cell" in plan or "PartitionFilters: [cell" in plan


def test_proven_results_are_exact_and_the_rest_is_completed(spark):
    q, x = np.vstack([unit_rows(30, 16, 5, 8), unit_rows(30, 16, 6)]), unit_rows(600, 16, 5, 8)
    queries, vectors = frame(spark, q, "q", "query_id"), frame(spark, x, "x", "chunk_id")
    want = brute(q, x, 5)
    hits = retrieve.knn_cells(queries, vectors, 5, planes=6, probes=16).cache()
    proven = found(hits.filter("proven"))
    assert proven and proven <= want
    assert hits.filter("not proven").count() > 0
    assert found(retrieve.knn_certified(queries, vectors, 5, planes=6, probes=16)) == want
    recall = retrieve.recall_at_k(hits, retrieve.knn(queries, vectors, 5)).agg(F.avg("recall")).first()[0]
    assert recall == pytest.approx(len(found(hits.drop("rank").withColumn("rank", F.lit(0))) & {
        (a, b, 0) for a, b, _ in want}) / len(want))


def test_one_hot_cell(spark):
    """A third of all vectors are copies of one; the cell is cut into blocks and nothing is lost."""
    x = unit_rows(300, 8, 9)
    x[:100] = x[0]
    q = x[:40].copy()
    hits = retrieve.knn_cells(frame(spark, q, "q", "query_id"), frame(spark, x, "x", "chunk_id"), 120,
                              planes=4, probes=16, query_block=7, vector_block=11, broadcast_bytes=1)
    assert found(hits) == brute(q, x, 120)


def test_planes_are_orthonormal():
    for dim, planes in ((64, 14), (256, 10), (48, 6)):
        width = 1 << (dim - 1).bit_length()
        full = V.sign_planes(width, planes)
        assert np.allclose(full @ full.T, np.eye(planes))
        assert np.allclose(V.sign_planes(dim, planes), full[:, :dim])


def test_cell_bound_holds():
    q, x = unit_rows(50, 16, 3), unit_rows(500, 16, 4)
    chosen, bound = V.nearest_cells(q, 5, 9)
    cell_of = V.cells(x, 5)
    for i in range(len(q)):
        outside = x[~np.isin(cell_of, chosen[i])]
        assert (outside @ q[i]).max() <= bound[i] + 1e-6
        assert V.cells(q[i:i + 1], 5)[0] == chosen[i][0]


def test_embedding_matches_counts_and_keeps_errors(spark):
    texts = spark.createDataFrame([("a", "The the cat"), ("b", ""), ("c", None)], "id string, t string")
    rows = {r.id: r for r in embed.embed(texts, "t", embed.HashedWords(32)).collect()}
    assert sorted(v for v in rows["a"].embedding if v) == pytest.approx([1 / 5**0.5, 2 / 5**0.5])
    assert rows["b"].embedding == [0.0] * 32 and rows["b"].embed_status == "SUCCESS"
    assert rows["c"].embedding is None and rows["c"].embed_status == "ERROR: no text"

    def picky(batch):
        if any("cat" in t for t in batch):
            raise ValueError("no cats")
        return np.ones((len(batch), 2))

    statuses = {r.id: r.embed_status for r in embed.embed(texts.filter("t is not null"), "t", picky).collect()}
    assert statuses == {"a": "ERROR: no cats", "b": "SUCCESS"}


def chunk_rows(spark, rows):
    return spark.createDataFrame(rows, "path string, chunked_text string").withColumn("chunk_id", F.md5("chunked_text"))


def index_rows(df):
    return {(r.chunk_id, r.path, tuple(r.embedding)) for r in df.collect()}


def test_sync_equals_rebuild_and_embeds_new_texts_only(spark):
    old = chunk_rows(spark, [("a", "shared"), ("b", "shared"), ("a", "gone"), ("a", "kept")])
    new = chunk_rows(spark, [("b", "shared"), ("a", "kept"), ("a", "fresh")])
    built = index.build_index(old)

    def only_fresh(batch):
        assert set(batch) <= {"fresh"}
        return embed.HashedWords()(batch)

    synced = index.sync_index(built, new, only_fresh)
    assert index_rows(synced) == index_rows(index.build_index(new))


def test_snapshot_diff_and_changes(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, None)], "k int, v string")
    new = spark.createDataFrame([(2, "b"), (3, "c"), (4, None), (5, "e")], "k int, v string")
    diff = index.snapshot_diff(old, new, "k")
    assert {(r.k, r.v, r.op) for r in diff.collect()} == {(1, "a", "delete"), (3, "c", "update"), (5, "e", "insert")}
    assert {tuple(r) for r in index.apply_changes(old, diff, "k").collect()} == {tuple(r) for r in new.collect()}


def test_index_lifecycle(spark):
    spark.sql("drop table if exists t_index")
    one, two = chunk_rows(spark, [("a", "one")]), chunk_rows(spark, [("a", "two")])
    texts = lambda: {r.chunked_text for r in spark.table("t_index").collect()}
    index.ensure_index(spark, "t_index", one)
    assert texts() == {"one"}
    index.ensure_index(spark, "t_index", two)
    assert texts() == {"one"}
    index.ensure_index(spark, "t_index", two, "sync")
    assert texts() == {"two"} and "cell" in spark.table("t_index").columns
    index.ensure_index(spark, "t_index", one, "rebuild")
    assert texts() == {"one"}
    with pytest.raises(ValueError):
        index.index_action(True, "other")


def test_search_with_other_column_names(spark):
    chunks = chunk_rows(spark, [("a", "red apple"), ("b", "green pear"), ("c", "blue plum")])
    renamed = index.build_index(chunks).withColumnsRenamed({"chunk_id": "id", "chunked_text": "body", "path": "uri"})
    queries = spark.createDataFrame([(1, "a green pear")], "query_id int, query string")
    for kind in ("exact", "ann"):
        settings = RetrieverSettings(k=1, query_type=kind, planes=3, probes=8, columns=IndexColumns("id", "body", "uri"))
        hit = retrieve.search(queries, renamed, settings).first()
        assert (hit.chunk_text, hit.document_uri, hit["rank"]) == ("green pear", "b", 1)


def test_ann_search_is_completed(spark):
    texts = [f"word{i} word{i * 7 % 50} word{i * 3 % 20}" for i in range(200)]
    built = index.build_index(chunk_rows(spark, [(f"p{i}", t) for i, t in enumerate(texts)])).cache()
    queries = spark.createDataFrame([(i, t + " word1") for i, t in enumerate(texts[:20])], "query_id int, query string")

    def hits(**kind):
        rows = retrieve.search(queries, built, RetrieverSettings(k=3, planes=5, probes=2, **kind)).collect()
        return {(r.query_id, r["rank"], r.primary_key) for r in rows}

    exact = hits(query_type="exact")
    assert hits(query_type="ann") == exact
    assert hits(query_type="ann", complete=False) != exact


def test_hash_rank_is_a_global_rank(spark):
    keys = [f"k{i}" for i in range(500)]
    got = ranking.hash_rank(spark.createDataFrame([(k,) for k in keys], "k string"), "k", hex_digits=2).collect()
    import hashlib

    want = sorted(keys, key=lambda k: (hashlib.md5(k.encode()).hexdigest(), k))
    assert {r.k: r["rank"] for r in got} == {k: i + 1 for i, k in enumerate(want)}
