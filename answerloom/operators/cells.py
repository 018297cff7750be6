"""Search through learned cells, exact at the cost of a part of the index.

Cells are learned by k-means on a bounded sample, with one round of summed vectors after the other. Each cell knows the
cap around its centroid in which all of its vectors lie, and each row carries a code of one byte a dimension with a bound
on its error. A query

1. scores the rows of its nearest cells, which gives a k-th best score to beat;
2. leaves out every other cell whose cap cannot reach that score;
3. looks at the codes of what is left, a quarter of the bytes, and keeps the rows that could still win;
4. reads the vectors of these few rows by their place (cell and key).

So the result is that of a full scan. The index is read, never shuffled. A batch of bounded size goes to all tasks of its
scan. A larger one stands in files that the tasks read block by block (``dealt``), with the thresholds that its first pass
has found; there, as some query looks into nearly every row, 3 and 4 are one scan of the vectors. What reaches the driver is
bounded by the size of a query block and by the number of cells.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from answerloom.functions import cells as C
from answerloom.functions import vectors as V
from answerloom.operators import dealt
from answerloom.operators.ranking import top_k
from answerloom.session import write_and_reload

MODEL_BYTES = 64 * 1024 * 1024
MOST_CELLS = 16_384
#: A block of queries: so many bytes of vectors and lists of cells, and so many hits.
BLOCK_BYTES = 64 * 1024 * 1024
BLOCK_HITS = 500_000
#: Above so many queries products of whole vectors, read once for all of them, cost less than codes.
FEW_QUERIES = 512
#: Queries that a task reads at a time, of a batch above these bounds.
DEALT_ROWS = 8_192
#: Places that are sent to all tasks, and keys that are pushed into the scan.
BROADCAST_PLACES = 200_000
PUSHED_KEYS = 256
CODE_COLUMNS = ("cell", "code", "scale", "error", "twin")


@dataclass(frozen=True, eq=False)
class CellIndex:
    """Rows with CODE_COLUMNS, the centroids by cell number, and the caps of the cells that have rows."""

    rows: DataFrame
    centroids: np.ndarray
    cells: np.ndarray
    n_rows: np.ndarray
    cap: np.ndarray
    low: np.ndarray
    high: np.ndarray
    key: str = "chunk_id"
    vector: str = "embedding"


@dataclass(frozen=True)
class CellHits:
    """`hits`: query, key, cell, score, rank. `report`: for each query the rows of probed cells, the rows looked at by code,
    the rows whose vectors were read for it besides, the rows never looked at, and whether the result is proven exact."""

    hits: DataFrame
    report: DataFrame


# --- learning -----------------------------------------------------------------------------------


def train_cells(
    vectors: DataFrame, cells: int, rounds: int = 6, rows_per_cell: int = 64, key: str = "chunk_id", vector: str = "embedding",
) -> np.ndarray:
    """Unit centroids of at most `cells` cells.

    Trained on rows chosen by the hash of their key, some `cells * rows_per_cell` (all, if there are no more). The
    first centroids are the vectors of smallest hash. In each round, every task sends the sum of its vectors by cell.
    """
    if not 1 <= cells <= MOST_CELLS:
        raise ValueError(f"cells must lie between 1 and {MOST_CELLS}")
    plain = vectors.select(F.col(key).alias("key"), F.col(vector).alias("vector"))
    total, wanted = plain.count(), cells * rows_per_cell
    if total > wanted:
        plain = plain.filter(F.pmod(F.xxhash64("key"), F.lit(total)) < wanted)
    sample = write_and_reload(plain, "cell-training")
    first = sample.orderBy(F.xxhash64("key", F.lit(1)), "key").limit(cells).toArrow()
    if first.num_rows == 0:
        return np.ones((1, 1))
    centroids = C.unit(np.unique(V.matrix(first["vector"]), axis=0))
    if centroids.nbytes > MODEL_BYTES:
        raise ValueError("too many cells for vectors of this length")
    for _ in range(rounds):
        sums = round_sums(sample, centroids)
        found = np.array(sums["cell"].to_numpy(), np.int64)
        centroids = centroids.copy()
        centroids[found] = V.matrix(sums["total"])
        centroids = np.round(C.unit(centroids), 7)
    return C.unit(centroids)


def round_sums(sample: DataFrame, centroids: np.ndarray) -> pa.Table:
    """cell and the sum of its vectors, one row for each cell that has any."""
    shared = sample.sparkSession.sparkContext.broadcast(centroids)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            rows = V.matrix(batch.column("vector"))
            if len(rows):
                for cell, _, total in zip(*C.cell_sums(rows, C.nearest(rows, shared.value))):
                    totals[int(cell)] = totals.get(int(cell), 0) + total
        if totals:
            yield pa.RecordBatch.from_pydict({"cell": pa.array(list(totals), pa.int32()),
                                              "total": pa.array([t.tolist() for t in totals.values()], pa.list_(pa.float64()))})

    def add(group: pa.Table) -> pa.Table:
        rows = V.matrix(group["total"])
        rows = rows[np.lexsort(rows.T)]  # the same sum in whatever order the parts arrive
        return pa.table({"cell": group["cell"][:1], "total": pa.array([rows.sum(axis=0).tolist()], pa.list_(pa.float64()))})

    schema = "cell int, total array<double>"
    return sample.select("vector").mapInArrow(partial, schema).groupBy("cell").applyInArrow(add, schema).toArrow()


# --- index rows ---------------------------------------------------------------------------------


def with_own_cell(df: DataFrame, centroids: np.ndarray, vector: str = "embedding") -> DataFrame:
    """Add the number of the nearest centroid."""
    shared = df.sparkSession.sparkContext.broadcast(centroids)

    @F.arrow_udf("int")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            rows = V.matrix(batch)
            yield pa.array(C.nearest(rows, shared.value) if len(rows) else np.zeros(0, np.int32), pa.int32())

    return df.withColumn("cell", run(F.col(vector)))


def with_codes(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """Add code, scale, error, and twin, a hash that equal vectors share. Codes follow from the vectors, so they are made
    after the shuffle by cell."""
    schema = T.StructType([
        T.StructField("code", T.BinaryType()), T.StructField("scale", T.FloatType()), T.StructField("error", T.FloatType())])

    @F.arrow_udf(schema)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            codes, scale, error = C.encode(V.matrix(batch))
            yield pa.StructArray.from_arrays(
                [pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(scale, pa.float32()),
                 pa.array(error, pa.float32())], ["code", "scale", "error"])

    coded = df.withColumn("_code", run.asNondeterministic()(F.col(vector)))
    return coded.select(*df.columns, *[F.col(f"_code.{c}").alias(c) for c in CODE_COLUMNS[1:4]], F.xxhash64(vector).alias("twin"))


def by_cell(rows: DataFrame, key: str = "chunk_id") -> DataFrame:
    """Rows of a cell side by side in the order of their keys, in one shuffle; adaptive execution makes a large cell several
    tasks' work."""
    return rows.hint("rebalance", F.col("cell")).sortWithinPartitions("cell", key)


def cell_caps(rows: DataFrame, centroids: np.ndarray, vector: str = "embedding") -> DataFrame:
    """cell, n_rows, cap, low and high of the cells that have rows."""
    shared = rows.sparkSession.sparkContext.broadcast(centroids)
    names = ["cell", "n_rows", "cap", "low", "high"]

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                own = batch.column("cell").to_numpy()
                cells, counts, *rest = C.caps(V.matrix(batch.column(vector)), own, shared.value)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cells, pa.int32()), pa.array(counts, pa.int64()), *[pa.array(x, pa.float64()) for x in rest]], names=names)

    parts = rows.select("cell", vector).mapInArrow(partial, "cell int, n_rows long, cap double, low double, high double")
    return parts.groupBy("cell").agg(F.sum("n_rows").alias("n_rows"), F.min("cap").alias("cap"), F.min("low").alias("low"),
                                     F.max("high").alias("high"))


def opened(rows: DataFrame, centroids: np.ndarray, caps: pa.Table, key: str = "chunk_id", vector: str = "embedding") -> CellIndex:
    figures = [np.array(caps[name].to_numpy(), kind) for name, kind in (
        ("cell", np.int64), ("n_rows", np.int64), ("cap", float), ("low", float), ("high", float))]
    # a cap is a bound: room for the rounding of its cosine
    return CellIndex(rows, centroids, figures[0], figures[1], figures[2] - 1e-9, figures[3], figures[4], key, vector)


def cells_over(vectors: DataFrame, cells: int, key: str = "chunk_id", vector: str = "embedding", rounds: int = 6) -> CellIndex:
    """An index of vectors in the shared folder, for one session's searches."""
    centroids = train_cells(vectors, cells, rounds, key=key, vector=vector)
    rows = write_and_reload(with_codes(by_cell(with_own_cell(vectors.select(key, vector), centroids, vector), key), vector), "cell-index")
    return opened(rows, centroids, cell_caps(rows, centroids, vector).toArrow(), key, vector)


# --- reading rows by place ------------------------------------------------------------------------


def fetch(rows: DataFrame, places: DataFrame, columns: list[str], key: str = "chunk_id") -> DataFrame:
    """`places` with the columns of their rows in the index.

    Only the cells named are read. A few keys are pushed into the scan, where files sorted by key skip all other row
    groups and pages. Places up to a bound go to every task; more of them meet the rows in a shuffled join.
    """
    n_places, named = places.agg(F.count(F.lit(1)), F.collect_set("cell")).first()  # at most MOST_CELLS cells
    few = n_places <= BROADCAST_PLACES
    wanted = rows.filter(F.col("cell").isin(sorted(named)))
    keys = places.select(key).distinct().limit(PUSHED_KEYS + 1).collect() if few else []
    if 0 < len(keys) <= PUSHED_KEYS:
        wanted = wanted.filter(_any_of([F.col(key) == r[0] for r in keys]))
    return wanted.select("cell", key, *columns).join(F.broadcast(places) if few else places, ["cell", key])


def _any_of(conditions: list) -> F.Column:
    """A balanced tree of ORs: each equality is compared with the statistics of row groups and pages."""
    while len(conditions) > 1:
        conditions = [reduce(lambda a, b: a | b, conditions[i : i + 2]) for i in range(0, len(conditions), 2)]
    return conditions[0]


# --- search ---------------------------------------------------------------------------------------


def search_cells(
    queries: DataFrame, index: CellIndex, k: int = 5, probes: int = 8, complete: bool = True, query_key: str = "query_id",
    vector: str = "embedding", block_bytes: int = BLOCK_BYTES,
) -> CellHits:
    """The k best rows of each query. With `complete` they are exact; without, `proven` tells which are.

    Batches of more than FEW_QUERIES, or above the bound of a block, stay in files, which the tasks of the scan read block by
    block: codes save reading, but cost more than the products that they spare, once a vector is read for many queries.
    """
    queries = write_and_reload(queries.select(F.col(query_key).alias("query"), F.col(vector).alias("vector")), "queries")
    dim = index.centroids.shape[1]
    rows = max(1, min(block_bytes // (8 * dim + 4 * probes), BLOCK_HITS // k))
    search = _search_block if queries.count() <= min(rows, FEW_QUERIES) else partial(_search_dealt, block=min(rows, DEALT_ROWS))
    found = search(queries, index, k, probes, complete)
    return CellHits(found.hits.withColumnsRenamed({"query": query_key, "key": index.key}),
                    found.report.withColumnRenamed("query", query_key))


def _probes(queries: DataFrame, index: CellIndex, probes: int) -> DataFrame:
    """The queries with the cells (among those with rows) of the best centroid scores."""
    shared = queries.sparkSession.sparkContext.broadcast((index.centroids[index.cells], index.cells))
    names = [*queries.columns, "cells"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centroids, cells = shared.value
        step = max(1, 1_000_000 // max(1, len(cells)))
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                scores = np.round(V.matrix(part.column("vector")) @ centroids.T, 9) if len(cells) else np.zeros((part.num_rows, 0))
                best = cells[np.argsort(-scores, axis=1, kind="stable")[:, :probes]]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(best.tolist(), pa.list_(pa.int32()))], names=names)

    schema = T.StructType([*queries.schema.fields, T.StructField("cells", T.ArrayType(T.IntegerType()))])
    return queries.mapInArrow(run, schema)


def _search_dealt(queries: DataFrame, index: CellIndex, k: int, probes: int, complete: bool, block: int) -> CellHits:
    """The search for a batch of any size: its queries are read by the tasks, `block` at a time."""
    numbered = queries.withColumn("row", F.monotonically_increasing_id())
    probed, files = dealt.stored(_probes(numbered, index, probes), "probes")
    schema = T.StructType([T.StructField("row", T.LongType()), *_hit_type(index, T.StructField("score", T.DoubleType())).fields[1:]])
    schema.fields[1].name = index.key
    schema.names[1] = index.key
    hits = dealt.best_hits(
        dealt.shared_out(index.rows.select(index.key, index.vector, "cell")), files, schema, k, "row", index.key, index.vector, block,
        query_vector="vector", cells="cells").withColumnRenamed(index.key, "key")
    first = write_and_reload(_best(hits, k), "probe-hits")
    least = first.filter(F.col("rank") == k).select("row", F.col("score").alias("least"))
    waiting, files = dealt.stored(_waiting(probed.join(least, "row", "left"), index), "waiting-queries")
    waiting = waiting.drop("vector", "cells", "least")
    found, checked = first, waiting.select("row", F.lit(0).cast("bigint").alias("rows_checked"))
    if complete:
        more = write_and_reload(_open_scan(index, files, k, block), "open-hits")
        # as places are fetched by key in _search_block, a key of several rows in a cell comes once for each of them
        copies = index.rows.groupBy(F.col(index.key).alias("key"), "cell").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        hits = more.filter(F.col("cell").isNotNull()).join(copies, ["key", "cell"], "left").withColumn(
            "_copy", F.explode(F.array_repeat(F.lit(0), F.least(F.coalesce("n", F.lit(1)), F.lit(k)).cast("int"))))
        found = _best(first.drop("rank").unionByName(hits.select("row", "key", "cell", "score")), k)
        checked = more.groupBy("row").agg(F.sum("checked").alias("rows_checked"))
    coded = F.col("rows_open") if complete else F.lit(0).cast("bigint")
    report = waiting.join(checked, "row", "left").select(
        "rows_probed", coded.alias("rows_coded"), F.coalesce("rows_checked", F.lit(0)).cast("bigint").alias("rows_checked"),
        (F.lit(int(index.n_rows.sum())) - F.col("rows_probed") - coded).alias("rows_skipped"),
        ((F.col("rows_open") == 0) | F.lit(complete)).alias("proven"), "query")
    named = found.join(waiting.select("row", "query"), "row").select("query", "key", "cell", "score", "rank")
    return CellHits(named, report)


def _wins(queries: np.ndarray, least: np.ndarray, probed: np.ndarray, centroids: np.ndarray, cells: np.ndarray,
          caps: list[np.ndarray]) -> np.ndarray:
    """Which of the cells each query must still look into: those not probed whose caps can reach its k-th best score."""
    wins = C.cap_bounds(queries, centroids, *caps) >= least[:, None] - C.MARGIN
    place = np.searchsorted(cells, probed)
    here = (place < len(cells)) & (cells[np.minimum(place, len(cells) - 1)] == probed)
    row, column = np.nonzero(here)
    wins[row, place[row, column]] = False
    return wins


def _cell_figures(index: CellIndex) -> tuple[np.ndarray, ...]:
    order = np.argsort(index.cells)
    return tuple(x[order] for x in (index.cells, index.centroids[index.cells], index.n_rows, index.cap, index.low, index.high))


def _waiting(queries: DataFrame, index: CellIndex) -> DataFrame:
    """The queries with the k-th best score of their probed cells, the rows of these cells and those of the cells still open."""
    shared = queries.sparkSession.sparkContext.broadcast(_cell_figures(index))
    names = [*queries.columns, "rows_probed", "rows_open"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, centroids, n_rows, *caps = shared.value
        step = max(1, 500_000 // max(1, len(cells)))
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                least = part.column("least").fill_null(-np.inf)
                probed = V.matrix(part.column("cells")).astype(np.int64)
                near, rows_open = np.zeros(part.num_rows, np.int64), np.zeros(part.num_rows, np.int64)
                if len(cells):
                    near = n_rows[np.searchsorted(cells, probed)].sum(axis=1)
                    rows_open = _wins(V.matrix(part.column("vector")), least.to_numpy(), probed, centroids, cells, caps) @ n_rows
                columns = [least if name == "least" else part.column(name) for name in part.schema.names]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(near), pa.array(rows_open)], names=names)

    schema = T.StructType([*queries.schema.fields, T.StructField("rows_probed", T.LongType()), T.StructField("rows_open", T.LongType())])
    return queries.mapInArrow(run, schema)


def _open_scan(index: CellIndex, files: list[str], k: int, block: int) -> DataFrame:
    """row, key, cell, score of the rows of open cells that reach the k-th best score of a query, and how many rows were
    scored in full for it."""
    from pyspark.sql.pandas.types import to_arrow_type

    shared = index.rows.sparkSession.sparkContext.broadcast(_cell_figures(index))
    schema = T.StructType([
        T.StructField("row", T.LongType()), *_hit_type(index, T.StructField("score", T.DoubleType())).fields[1:],
        T.StructField("checked", T.LongType())])
    kinds, names = [to_arrow_type(f.dataType) for f in schema], schema.fieldNames()
    name, key = index.vector, index.key

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, centroids, _, *caps = shared.value
        best: dict[int, dealt.Best] = {}
        for piece in dealt.pieces(batches, name):
            ids = V.keys(piece[key])
            order = np.lexsort((ids, piece["cell"].to_numpy()))
            piece = piece.take(pa.array(order))
            vectors, own = V.matrix(piece[name], plain=True), piece["cell"].to_numpy()
            groups = list(dealt.numbers_in_order(own))
            here = np.searchsorted(cells, [cell for cell, _ in groups])
            figures = [centroids[here], cells[here], [x[here] for x in caps]]
            for number, queries in enumerate(dealt.query_blocks(files, ["row", "vector", "cells", "least"], block)):
                rows, probed = V.matrix(queries["vector"], plain=True), V.matrix(queries["cells"]).astype(np.int64)
                top = best.get(number)
                if top is None:
                    top = best[number] = dealt.Best(len(rows), k)
                    top.scores[:] = queries["least"].to_numpy()[:, None]
                open_cells = _wins(rows, top.least(), probed, *figures)
                found, checked = [], np.zeros(len(rows), np.int64)
                for place, (cell, inside) in enumerate(groups):
                    some = np.flatnonzero(open_cells[:, place])
                    if len(some) == 0:
                        continue
                    at, columns, scores, full = V.leading(rows[some], vectors[inside], k, top.least(some))
                    checked[some] += full
                    if len(at):
                        top.add(some[at], scores)
                        found.append((some[at], inside.start + columns, scores))
                at, columns, scores = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 3
                reach = scores >= top.least()[at]
                at, columns, scores = at[reach], columns[reach], scores[reach].astype(float)
                numbers = queries["row"].to_numpy()
                hits = pa.table([pa.array(numbers[at]), piece[key].take(pa.array(columns)), pa.array(own[columns]), pa.array(scores),
                                 pa.array(np.zeros(len(at), np.int64))], names=names)
                some = np.flatnonzero(checked)  # a row without key tells how many were scored
                counts = pa.table([pa.array(numbers[some]), pa.nulls(len(some), kinds[1]), pa.nulls(len(some), kinds[2]),
                                   pa.nulls(len(some), kinds[3]), pa.array(checked[some])], names=names)
                for table in (hits, counts):
                    yield from pa.table([c.cast(t) for c, t in zip(table.columns, kinds)], names=names).to_batches()

    return dealt.shared_out(index.rows.select(key, name, "cell")).mapInArrow(scan, schema)


def _search_block(queries: DataFrame, index: CellIndex, k: int, probes: int, complete: bool) -> CellHits:
    spark = queries.sparkSession
    small = _probes(queries, index, probes).toArrow()
    vectors = V.matrix(small["vector"]) if small.num_rows else np.zeros((0, index.centroids.shape[1]))
    probed = small["cells"].to_pylist()
    first = write_and_reload(_best(_probe_scan(index, vectors, probed, k), k), "probe-hits")
    least = np.full(len(vectors), -np.inf)
    last = first.filter(F.col("rank") == k).select("row", "score").toArrow()
    least[last["row"].to_numpy()] = last["score"].to_numpy()

    open_cells, rows_open = _open_cells(spark, index, vectors, probed, least)
    hits, checked = first, np.zeros(len(vectors), np.int64)
    if complete and len(open_cells):
        places = write_and_reload(_code_scan(index, vectors, probed, least, open_cells, k), "candidates")
        more = _exact_scores(fetch(index.rows, places.withColumnRenamed("key", index.key), [index.vector], index.key), index, vectors)
        hits = _best(first.drop("rank").unionByName(more), k)
        counts = places.groupBy("row").agg(F.count(F.lit(1)).alias("n")).toArrow()
        checked[counts["row"].to_numpy()] = counts["n"].to_numpy()

    size = dict(zip(index.cells.tolist(), index.n_rows.tolist()))
    near = np.array([sum(size[c] for c in cells) for cells in probed], np.int64).reshape(len(vectors))
    coded = rows_open if complete else np.zeros_like(rows_open)
    report = pa.table({
        "row": pa.array(range(len(vectors)), pa.int32()), "rows_probed": near, "rows_coded": coded, "rows_checked": checked,
        "rows_skipped": int(index.n_rows.sum()) - near - coded, "proven": (rows_open == 0) | complete})
    names = spark.createDataFrame(pa.table({"row": pa.array(range(len(vectors)), pa.int32()), "query": small["query"]}))
    named = names.select("row", F.col("query").cast(queries.schema["query"].dataType).alias("query"))
    return CellHits(
        hits.join(F.broadcast(named), "row").select("query", "key", "cell", "score", "rank"),  # a block of queries is bounded
        spark.createDataFrame(report).join(F.broadcast(named), "row").drop("row"))


def _best(hits: DataFrame, k: int) -> DataFrame:
    return top_k(hits, ["row"], [F.desc("score"), F.asc("key")], k).withColumn("rank", F.col("rank").cast("bigint"))


def _hit_type(index: CellIndex, *more: T.StructField) -> T.StructType:
    return T.StructType([T.StructField("row", T.IntegerType()), T.StructField("key", index.rows.schema[index.key].dataType),
                         T.StructField("cell", T.IntegerType()), *more])


def _by_number(lists: list[list[int]]) -> dict[int, np.ndarray]:
    out: dict[int, list[int]] = {}
    for row, cells in enumerate(lists):
        for cell in cells:
            out.setdefault(cell, []).append(row)
    return {cell: np.array(rows, np.int32) for cell, rows in out.items()}


def _probe_scan(index: CellIndex, vectors: np.ndarray, probed: list[list[int]], k: int) -> DataFrame:
    """row, key, cell, score: the k best of each task among the rows of the probed cells."""
    rows_of = _by_number(probed)
    shared = index.rows.sparkSession.sparkContext.broadcast((vectors, rows_of))
    name, key = index.vector, index.key
    schema = _hit_type(index, T.StructField("score", T.DoubleType()))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, rows_of = shared.value
        best: dict[int, tuple] = {}  # query row: scores, ids, cells
        for batch in batches:
            if batch.num_rows == 0:
                continue
            block, ids, own = V.matrix(batch.column(name)), V.keys(batch.column(key)), batch.column("cell").to_numpy()
            for cell in np.unique(own):
                rows = rows_of.get(int(cell))
                if rows is None:
                    continue
                inside = own == cell
                scores, found = V.best_of_block(queries[rows], block[inside], ids[inside], k)
                for row, s, i in zip(rows.tolist(), scores, found):
                    new = (s, i, np.full(len(s), cell, np.int32))
                    if row in best:
                        s, i, c = (np.concatenate([a, b]) for a, b in zip(best[row], new))
                        order = np.lexsort((i, -s))[:k]
                        new = (s[order], i[order], c[order])
                    best[row] = new
        if best:
            columns = [np.repeat(list(best), [len(b[0]) for b in best.values()]),
                       *[np.concatenate([b[j] for b in best.values()]) for j in (1, 2, 0)]]
            yield from pa.table([pa.array(c.tolist(), t) for c, t in zip(columns, kinds)], names=names).to_batches()

    from pyspark.sql.pandas.types import to_arrow_type

    kinds, names = [to_arrow_type(f.dataType) for f in schema], schema.fieldNames()
    wanted = index.rows.filter(F.col("cell").isin([int(c) for c in rows_of]))
    return wanted.select(key, name, "cell").mapInArrow(scan, schema)


def _open_cells(spark, index: CellIndex, vectors: np.ndarray, probed: list[list[int]], least: np.ndarray):
    """Cells that some query must still look into, and for each query the rows of such cells."""
    shared = spark.sparkContext.broadcast((vectors, least, _by_number(probed), index.centroids[index.cells], index.cells,
                                           index.n_rows, index.cap, index.low, index.high))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            queries, least, rows_of, centroids, cells, n_rows, *cap = shared.value
            numbers, waiting = batch.column(0).to_numpy(), np.zeros(len(queries), np.int64)
            for start in range(0, len(numbers), step):
                some = numbers[start : start + step]
                bounds = C.cap_bounds(queries, centroids[some], *[x[some] for x in cap])
                for place, number in enumerate(some):
                    bounds[rows_of.get(int(cells[number]), []), place] = -np.inf
                wins = bounds >= least[:, None] - C.MARGIN
                wins &= bounds > -np.inf
                waiting += wins @ n_rows[some]
                yield _pairs("cell", cells[some][wins.any(axis=0)], np.zeros(int(wins.any(axis=0).sum()), np.int64))
            yield _pairs("query", np.flatnonzero(waiting), waiting[waiting > 0])

    step = max(1, 4_000_000 // max(1, len(vectors)))
    numbers = spark.range(len(index.cells)).repartition(max(1, min(64, len(index.cells) // 64)))
    found = numbers.mapInArrow(run, "kind string, id long, rows long").groupBy("kind", "id").agg(F.sum("rows").alias("rows")).toArrow()
    kind, ids, rows = np.array(found["kind"].to_pylist(), str), found["id"].to_numpy(), found["rows"].to_numpy()
    rows_open = np.zeros(len(vectors), np.int64)
    rows_open[ids[kind == "query"]] = rows[kind == "query"]
    return [int(c) for c in ids[kind == "cell"]], rows_open


def _pairs(kind: str, ids: np.ndarray, rows: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"kind": pa.array([kind] * len(ids), pa.string()), "id": pa.array(ids, pa.int64()),
                                       "rows": pa.array(rows, pa.int64())})


def _code_scan(index: CellIndex, vectors: np.ndarray, probed: list[list[int]], least: np.ndarray, open_cells: list[int],
               k: int) -> DataFrame:
    """row, key, cell of the rows of open cells whose code does not rule them out."""
    place = {int(c): i for i, c in enumerate(index.cells)}
    shared = index.rows.sparkSession.sparkContext.broadcast((vectors, least, _by_number(probed), index.centroids[index.cells],
                                                             place, index.cap, index.low, index.high))
    key, schema = index.key, _hit_type(index)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, least, rows_of, centroids, place, *cap = shared.value
        least = least.copy()
        for batch in batches:
            own = batch.column("cell").to_numpy()
            for cell in np.unique(own):
                inside = np.flatnonzero(own == cell)
                part = batch.take(pa.array(inside))
                ids = V.keys(part.column(key))
                fresh = C.first_twins(part.column("twin").to_numpy(), ids, k)
                part, ids = part.filter(pa.array(fresh)), ids[fresh]
                number = [place[int(cell)]]
                wins = C.cap_bounds(queries, centroids[number], *[x[number] for x in cap])[:, 0] >= least - C.MARGIN
                wins[rows_of.get(int(cell), [])] = False
                rows = np.flatnonzero(wins)
                codes = np.frombuffer(b"".join(part.column("code").to_pylist()), np.int8).reshape(part.num_rows, -1)
                scale, error = part.column("scale").to_numpy(), part.column("error").to_numpy()
                step = max(1, 2_000_000 // max(1, part.num_rows))
                for start in range(0, len(rows), step):
                    some = rows[start : start + step]
                    maybe, least[some] = C.candidates(*C.code_scores(queries[some], codes, scale, error), least[some], k)
                    q, x = np.nonzero(maybe)
                    if len(q):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(some[q], pa.int32()), pa.array(ids[x].tolist(), key_type),
                             pa.array(np.full(len(q), cell), pa.int32())], names=["row", "key", "cell"])

    from pyspark.sql.pandas.types import to_arrow_type

    key_type = to_arrow_type(schema["key"].dataType)
    wanted = index.rows.filter(F.col("cell").isin(open_cells))
    return wanted.select(key, "cell", "code", "scale", "error", "twin").mapInArrow(scan, schema)


def _exact_scores(found: DataFrame, index: CellIndex, vectors: np.ndarray) -> DataFrame:
    """row, key, cell, score of rows that came with their vectors."""
    shared = found.sparkSession.sparkContext.broadcast(vectors)
    schema = _hit_type(index, T.StructField("score", T.DoubleType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 4096):
                part = batch.slice(start, 4096)
                scores = np.einsum("ij,ij->i", shared.value[part.column(0).to_numpy()], V.matrix(part.column(3)))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:3], pa.array(np.round(scores, V.SCORE_DIGITS), pa.float64())], names=["row", "key", "cell", "score"])

    return found.select("row", F.col(index.key).alias("key"), "cell", index.vector).mapInArrow(run, schema)


def search_texts(
    vectors: DataFrame, index: CellIndex, k: int, probes: int, complete: bool, query_key: str, text: str = "chunked_text",
    uri: str = "path",
) -> tuple[DataFrame, CellHits]:
    """(query, rank, score, primary_key, chunk_text, document_uri), and the hits with their report.

    Hits know the cell of their rows, so texts are read from these cells only, and in them by key.
    """
    found = search_cells(vectors, index, k, probes, complete, query_key)
    found = CellHits(write_and_reload(found.hits, "hits"), found.report)
    texts = fetch(index.rows, found.hits, [text, uri], index.key)
    return texts.select(query_key, "rank", "score", F.col(index.key).alias("primary_key"), F.col(text).alias("chunk_text"),
                        F.col(uri).alias("document_uri")), found
