"""What an index costs by its size: the number of cells, the ways of a large batch, rows shuffled by a sync, tasks that parse."""

from pyspark.sql import functions as F

from answerloom.operators import cell_index, cells, chunk
from answerloom.operators.embed import HashedWords
from answerloom.streaming import incremental
from test_retrieve import brute, found, frame, unit_rows

EMBEDDER = HashedWords(64)
RAW = "path string, modificationTime timestamp, length bigint, content binary"


def chunk_rows(spark, texts):
    return spark.createDataFrame(texts, "path string, chunked_text string").withColumn("chunk_id", F.md5("chunked_text"))


def state(index):
    return {tuple(r) for r in index.rows.select("chunk_id", "chunked_text", "path", "cell", F.hash("embedding"), "twin").collect()}


def test_cells_do_not_grow_with_the_rows_for_ever(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(cell_index, "ROWS_PER_CELL", 5)
    monkeypatch.setattr(cell_index, "DEFAULT_CELLS", 7, raising=False)
    texts = [(f"doc/{i}", f"word{i} word{i % 17} word{i % 5}") for i in range(200)]
    built = cell_index.ensure_cell_index(spark, str(tmp_path / "index"), chunk_rows(spark, texts), "sync", EMBEDDER)
    assert len(built.centroids) == 7 and built.n_rows.sum() == 200


def test_many_queries_are_one_search_without_codes(spark, monkeypatch):
    q, x = unit_rows(30, 16, 1), unit_rows(300, 16, 2)
    index = cells.cells_over(frame(spark, x, "x", "chunk_id"), 12)

    def refused(*_, **__):
        raise AssertionError("a large batch is looked up by codes")

    monkeypatch.setattr(cells, "FEW_QUERIES", 20, raising=False)
    few = cells.search_cells(frame(spark, q[:20], "q", "query_id"), index, 3)
    assert found(few.hits) == brute(q[:20], x, 3)
    monkeypatch.setattr(cells, "_search_block", refused)
    many = cells.search_cells(frame(spark, q, "q", "query_id"), index, 3)
    assert found(many.hits) == brute(q, x, 3)
    assert many.report.filter("proven").count() == 30


def test_sync_shuffles_and_writes_each_row_once(spark, tmp_path, monkeypatch):
    texts = [(f"doc/{i}", f"word{i} word{i % 7}") for i in range(120)]
    changed = texts[10:100] + [("doc/x", texts[100][1])] + [("doc/new", f"fresh{i}") for i in range(9)]  # gone, renamed, new
    written, plans = [], []
    keep = cell_index.write_and_reload
    monkeypatch.setattr(cell_index, "write_and_reload", lambda df, name, *a: written.append((name, df)) or keep(df, name, *a))
    folder = str(tmp_path / "index")
    cell_index.ensure_cell_index(spark, folder, chunk_rows(spark, texts), "sync", EMBEDDER, 6)
    write_rows = cell_index._write_rows
    monkeypatch.setattr(cell_index, "_write_rows", lambda df, *a: plans.append(
        df._jdf.queryExecution().executedPlan().toString()) or write_rows(df, *a))
    after = cell_index.ensure_cell_index(spark, folder, chunk_rows(spark, changed), "sync", EMBEDDER)
    assert [name for name, df in written if "embedding" in df.columns] == ["index-texts", "new-texts", "new-rows"]
    assert plans[0].count("Exchange hashpartitioning") == 1 and "SortMergeJoin" not in plans[0]
    fresh = cell_index.ensure_cell_index(spark, folder + "-2", chunk_rows(spark, changed), "create_if_missing", EMBEDDER, 6)
    assert {r[:3] + r[4:] for r in state(after)} == {r[:3] + r[4:] for r in state(fresh)}
    assert after.n_rows.sum() == after.rows.count() == 100


def test_parsing_and_embedding_of_a_batch_are_work_for_all_cores(spark, tmp_path, monkeypatch):
    rows = [(f"p{i}", None, 1, f"<p>words of page {i}</p>".encode()) for i in range(60)]
    spark.createDataFrame(rows, RAW).coalesce(1).write.parquet(str(tmp_path / "in"))
    parts = {}
    keep = incremental.write_and_reload

    def kept(df, name, *more):
        done = keep(df, name, *more)
        parts[name] = len(done.inputFiles())
        return done

    monkeypatch.setattr(incremental, "write_and_reload", kept)
    stream = spark.readStream.schema(RAW).parquet(str(tmp_path / "in"))
    folder = str(tmp_path / "state")
    incremental.stream_index_sync(stream, folder, lambda docs: chunk.chunk_words(docs, 4, 1), embedder=EMBEDDER).awaitTermination()
    assert all(parts[name] >= 6 for name in ("sync-batch", "sync-vectors")), parts
    assert incremental.read_index(spark, folder).count() == 60
