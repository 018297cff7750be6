"""Similarity search: exact, by probed cells, and how close the two come.

No pair of query and vector ever becomes a row. Blocks of queries meet blocks of
vectors inside a task of the index scan and only the k best per query leave it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from answerloom.conf import IndexColumns, RetrieverSettings
from answerloom.functions import vectors as V
from answerloom.operators import cells, dealt
from answerloom.operators.embed import Embedder, embed
from answerloom.operators.parse import SUCCESS
from answerloom.operators.ranking import top_k
from answerloom.session import write_and_reload

QUERY_BROADCAST_BYTES = 64 * 1024 * 1024
# A batch of this many queries, with at most this many hits each, has few enough hits to broadcast.
FEW_QUERIES = 10_000
MANY_HITS = 50
# Queries and vectors that a task scores at a time.
QUERY_BLOCK = 8_192
SLICE_ROWS = 1_024
VECTOR_BLOCK = V.TILE_COLUMNS


def _slices(batch: pa.Array) -> Iterator[pa.Array]:
    """A batch in parts whose tables of vectors by cell stay small."""
    return (batch.slice(start, SLICE_ROWS) for start in range(0, len(batch), SLICE_ROWS))


def with_cell(df: DataFrame, planes: int, vector: str = "embedding") -> DataFrame:
    """Add the sign cell of each vector."""

    @F.arrow_udf("int")
    def cell(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            parts = [V.cells(V.matrix(part), planes) for part in _slices(batch)]
            yield pa.array(np.concatenate(parts) if parts else [], pa.int32())

    return df.withColumn("cell", cell(F.col(vector)))


def with_probes(df: DataFrame, planes: int, probes: int, vector: str = "embedding") -> DataFrame:
    """Add the cells to probe and ``open_bound``, the best score outside of them."""
    schema = T.StructType([
        T.StructField("cells", T.ArrayType(T.IntegerType())),
        T.StructField("open_bound", T.DoubleType()),
    ])

    @F.arrow_udf(schema)
    def choose(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            parts = [V.nearest_cells(V.matrix(part), planes, probes) for part in _slices(batch)]
            chosen = np.concatenate([c.astype(np.int32) for c, _ in parts]) if parts else np.zeros((0, 0), np.int32)
            bound = np.concatenate([b for _, b in parts]) if parts else np.zeros(0)
            ends = np.arange(len(chosen) + 1, dtype=np.int32) * (chosen.shape[1] if len(chosen) else 0)
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(chosen.ravel(), pa.int32()))
            yield pa.StructArray.from_arrays([lists, pa.array(bound, pa.float64())], ["cells", "open_bound"])

    return (
        df.withColumn("_probe", choose.asNondeterministic()(F.col(vector)))
        .withColumn("cells", F.col("_probe.cells"))
        .withColumn("open_bound", F.col("_probe.open_bound"))
        .drop("_probe")
    )


def _hit_schema(queries: DataFrame, index: DataFrame, query_key: str, key: str) -> T.StructType:
    return T.StructType([
        T.StructField(query_key, queries.schema[query_key].dataType),
        T.StructField(key, index.schema[key].dataType),
        T.StructField("score", T.DoubleType()),
    ])


def _hit_table(query_ids: np.ndarray, best_ids: np.ndarray, scores: np.ndarray, names: list[str], types) -> pa.Table:
    columns = [np.repeat(query_ids, scores.shape[1]), best_ids.ravel(), scores.ravel()]
    return pa.table([pa.array(c.tolist(), t) for c, t in zip(columns, types)], names=names)


def _arrow_types(schema: T.StructType) -> list[pa.DataType]:
    from pyspark.sql.pandas.types import to_arrow_type

    return [to_arrow_type(f.dataType) for f in schema.fields]


def _ranked(hits: DataFrame, query_key: str, key: str, k: int) -> DataFrame:
    return top_k(hits, [query_key], [F.desc("score"), F.asc(key)], k).withColumn("rank", F.col("rank").cast("bigint"))


def _small_batch(queries: DataFrame, index: DataFrame, vector: str, limit_bytes: int) -> pa.Table | None:
    """The queries as one table if they stay below the bounds on bytes and rows, else None.

    Reading stops one row past the bound, so the driver never holds more.
    """
    first = index.select(F.size(vector)).head()
    rows = min(FEW_QUERIES, max(1, limit_bytes // (8 * max(1, first[0])))) if first else 1
    table = queries.limit(rows + 1).toArrow()
    return table if table.num_rows <= rows else None


def _written(queries: DataFrame, query_key: str, vector: str) -> DataFrame:
    """Queries that are read more than once, as a table: their vectors may come from a model."""
    return write_and_reload(queries.select(query_key, vector), "queries")


def _scan(
    small: pa.Table, index: DataFrame, schema: T.StructType, k: int, query_key: str, key: str, vector: str,
    probed: bool = False,
) -> DataFrame:
    """Best hits per task of an index scan. The index is read once and never shuffled.

    With ``probed``, a query only meets the vectors of the cells it lists.
    """
    types, names = _arrow_types(schema), schema.fieldNames()
    by_cell: dict[int, list[int]] = {}
    if probed:
        for row, cells in enumerate(small["cells"].to_pylist()):
            for cell in cells:
                by_cell.setdefault(cell, []).append(row)
    shared = index.sparkSession.sparkContext.broadcast((V.keys(small[query_key]), V.matrix(small[vector]), by_cell))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, query_vectors, rows_of = shared.value
        best: dict[int, tuple] = {}
        for batch in batches:
            if batch.num_rows == 0 or len(query_ids) == 0:
                continue
            vectors, ids = V.matrix(batch.column(vector)), V.keys(batch.column(key))
            groups = batch.column("cell").to_numpy() if probed else np.zeros(len(ids), dtype=np.int64)
            for cell in np.unique(groups):
                rows = rows_of.get(int(cell), []) if probed else slice(None)
                inside = groups == cell
                block = query_vectors[rows]
                if len(block):
                    found = V.best_of_block(block, vectors[inside], ids[inside], k)
                    best[cell] = V.merge_best(*best[cell], *found, k) if cell in best else found
        for cell, (scores, found_ids) in best.items():
            rows = rows_of[int(cell)] if probed else slice(None)
            yield from _hit_table(query_ids[rows], found_ids, scores, names, types).to_batches()

    return index.select(key, vector, *(["cell"] if probed else [])).mapInArrow(scan, schema)


def knn(
    queries: DataFrame,
    index: DataFrame,
    k: int,
    query_key: str = "query_id",
    key: str = "chunk_id",
    vector: str = "embedding",
    broadcast_bytes: int = QUERY_BROADCAST_BYTES,
) -> DataFrame:
    """Exact k best vectors per query as (query, key, score, rank).

    A query batch below the byte bound goes to every task of the index scan. A
    larger one takes the block join.
    """
    small = _small_batch(queries.select(query_key, vector), index, vector, broadcast_bytes)
    if small is None:
        return knn_blocks(queries, index, k, query_key, key, vector)
    hits = _scan(small, index, _hit_schema(queries, index, query_key, key), k, query_key, key, vector)
    return _ranked(hits, query_key, key, k)


def knn_blocks(
    queries: DataFrame,
    index: DataFrame,
    k: int,
    query_key: str = "query_id",
    key: str = "chunk_id",
    vector: str = "embedding",
    query_block: int = QUERY_BLOCK,
    vector_block: int = VECTOR_BLOCK,
) -> DataFrame:
    """Exact search for query batches of any size: every query block meets every vector block once.

    The index is scanned once and not shuffled; its tasks read the queries beside it. The work is that of all pairs.
    """
    _, files = dealt.stored(queries.select(query_key, vector), "queries")
    schema = _hit_schema(queries, index, query_key, key)
    hits = dealt.best_hits(
        dealt.shared_out(index.select(key, vector)), files, schema, k, query_key, key, vector, query_block, vector_block)
    return _ranked(hits, query_key, key, k)


def knn_cells(
    queries: DataFrame,
    index: DataFrame,
    k: int,
    planes: int = 8,
    probes: int = 64,
    query_key: str = "query_id",
    key: str = "chunk_id",
    vector: str = "embedding",
    query_block: int = QUERY_BLOCK,
    vector_block: int = VECTOR_BLOCK,
    broadcast_bytes: int = QUERY_BROADCAST_BYTES,
) -> DataFrame:
    """Approximate search: each query looks only into its nearest cells.

    ``proven`` tells that no vector outside of the probed cells can change the
    result of this query (for vectors of length 1). A small query batch is scored
    during the scan, and of an index table partitioned by cell only the probed
    partitions are read. For a larger batch, the tasks of the scan read the queries beside it.
    """
    probed = with_probes(queries.select(query_key, vector), planes, probes, vector)
    schema = _hit_schema(queries, index, query_key, key)
    # Of equal width per query: the vector, the list of cells, the bound.
    small = _small_batch(probed, index, vector, broadcast_bytes)
    if small is not None:
        x = index if "cell" in index.columns else with_cell(index, planes, vector)
        cells = sorted({c for row in small["cells"].to_pylist() for c in row})  # at most 2 ** planes
        if "cell" in index.columns:
            x = x.filter(F.col("cell").isin(cells))
        hits = _scan(small, x, schema, k, query_key, key, vector, probed=True)
        bounds = queries.sparkSession.createDataFrame(small.select([query_key, "open_bound"]))
    else:
        probed, files = dealt.stored(probed, "probes")
        bounds = probed.select(query_key, "open_bound")
        x = dealt.shared_out(index)
        x = x if "cell" in index.columns else with_cell(x, planes, vector)
        hits = dealt.best_hits(x, files, schema, k, query_key, key, vector, query_block, vector_block, cells="cells")
    ranked = _ranked(hits, query_key, key, k)
    worst = ranked.groupBy(query_key).agg(F.min("score").alias("_worst"), F.count(F.lit(1)).alias("_found"))
    settled = (F.col("_found") == k) & (F.col("_worst") > F.col("open_bound") + 1e-6)
    certain = bounds.join(worst, query_key, "left").select(
        query_key, F.coalesce((F.col("open_bound") < 0) | settled, F.lit(False)).alias("proven"))
    # a query whose probed cells are empty keeps one row without a hit, not proven
    return certain.join(ranked, query_key, "left").select(*ranked.columns, "proven")


def knn_certified(
    queries: DataFrame, index: DataFrame, k: int, planes: int = 8, probes: int = 64,
    query_key: str = "query_id", key: str = "chunk_id", vector: str = "embedding",
) -> DataFrame:
    """Exact result by way of the cells: only queries the cells cannot settle scan the whole index."""
    queries = _written(queries, query_key, vector)
    quick = write_and_reload(knn_cells(queries, index, k, planes, probes, query_key, key, vector), "knn-cells")
    settled = quick.filter("proven").drop("proven")
    open_queries = queries.join(settled.select(query_key).distinct(), query_key, "left_anti")
    rest = knn(open_queries, index, k, query_key, key, vector)
    return settled.unionByName(rest)


def recall_at_k(approximate: DataFrame, exact: DataFrame, query_key: str = "query_id", key: str = "chunk_id") -> DataFrame:
    """Share of the exact hits that the approximate search found, per query."""
    found = approximate.select(query_key, key, F.lit(1).alias("_hit"))
    return (
        exact.select(query_key, key)
        .join(found, [query_key, key], "left")
        .groupBy(query_key)
        .agg(F.avg(F.coalesce("_hit", F.lit(0))).alias("recall"))
    )


def search_with_failures(
    queries: DataFrame, index: DataFrame | cells.CellIndex, settings: RetrieverSettings, embedder: Embedder | None = None,
    query_key: str = "query_id", text: str = "query",
) -> tuple[DataFrame, DataFrame]:
    """The hits of ``search``, and (query, status) of the queries that could not be embedded."""
    embedded = write_and_reload(embed(queries.select(query_key, text), text, embedder), "embedded-queries")
    failed = embedded.filter(F.col("embed_status") != SUCCESS).select(query_key, F.col("embed_status").alias("status"))
    return search(embedded, index, settings, None, query_key, text), failed


def search(
    queries: DataFrame,
    index: DataFrame | cells.CellIndex,
    settings: RetrieverSettings,
    embedder: Embedder | None = None,
    query_key: str = "query_id",
    text: str = "query",
) -> DataFrame:
    """Search an index by text: (query, rank, score, primary_key, chunk_text, document_uri).

    Only key and vector take part in scoring. Text and address join in for the
    final hits: few hits, by the bound on their queries, go to the index scan;
    otherwise both sides shuffle on the key. Queries that ``embed`` has been run on are not embedded again; those
    that could not be embedded have no hits (``search_with_failures`` names them). An index in learned cells is
    searched through them, and gives its texts by place.
    """
    cols: IndexColumns = settings.columns
    embedded = queries if "embed_status" in queries.columns else embed(queries.select(query_key, text), text, embedder)
    embedded = embedded.filter(F.col("embed_status") == SUCCESS)
    vectors = embedded.select(query_key, "embedding")
    if isinstance(index, cells.CellIndex):
        exact = settings.complete or settings.query_type == "exact"
        return cells.search_texts(
            vectors, index, settings.k, settings.near_cells, exact, query_key, cols.chunk_text, cols.document_uri)[0]
    if settings.query_type == "exact":
        small = _small_batch(vectors, index, "embedding", QUERY_BROADCAST_BYTES)
        few = small is not None
        if few:
            schema = _hit_schema(vectors, index, query_key, cols.primary_key)
            hits = _scan(small, index, schema, settings.k, query_key, cols.primary_key, "embedding")
            hits = _ranked(hits, query_key, cols.primary_key, settings.k)
        else:
            hits = knn_blocks(vectors, index, settings.k, query_key, cols.primary_key)
    else:
        by_cells = knn_certified if settings.complete else knn_cells
        hits = by_cells(
            vectors, index, settings.k, settings.planes, settings.probes, query_key, cols.primary_key
        ).drop("proven")
        few = queries.select(query_key).limit(FEW_QUERIES + 1).count() <= FEW_QUERIES
    texts = index.select(cols.primary_key, cols.chunk_text, cols.document_uri)
    return texts.join(F.broadcast(hits) if few and settings.k <= MANY_HITS else hits, cols.primary_key).select(
        query_key, "rank", "score",
        F.col(cols.primary_key).alias("primary_key"),
        F.col(cols.chunk_text).alias("chunk_text"),
        F.col(cols.document_uri).alias("document_uri"),
    )
