"""Query batches of any size beside an index scan.

The queries stand in files of the shared folder. Every task of the scan holds a piece of the index of bounded size and reads
the queries beside it, block by block. So neither side is repeated in a shuffle or passes through the driver; only the best
hits of a piece leave the task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from answerloom.functions import vectors as V
from answerloom.session import write_and_reload

#: Vectors of an index piece and of a query block that a task holds.
PIECE_BYTES = 48 * 1024 * 1024
QUERY_BYTES = 8 * 1024 * 1024


def stored(queries: DataFrame, name: str) -> tuple[DataFrame, list[str]]:
    """Queries as a written table, and its files."""
    table = write_and_reload(queries, name)
    return table, sorted(table.inputFiles())


def shared_out(index: DataFrame) -> DataFrame:
    """An index with work for all cores: one of few files is dealt anew, as each of its rows meets all queries."""
    cores = index.sparkSession.sparkContext.defaultParallelism
    return index if len(index.inputFiles()) >= 2 * cores else index.repartition(2 * cores)


def gathered(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """The rows of all batches in tables of ``rows`` rows, the last one smaller."""
    waiting, n = [], 0
    for batch in batches:
        while batch.num_rows:
            part = batch.slice(0, rows - n)
            batch = batch.slice(part.num_rows)
            waiting.append(part)
            n += part.num_rows
            if n == rows:
                yield pa.Table.from_batches(waiting).combine_chunks()
                waiting, n = [], 0
    if waiting:
        yield pa.Table.from_batches(waiting).combine_chunks()


def pieces(batches: Iterator[pa.RecordBatch], vector: str, most_bytes: int = PIECE_BYTES) -> Iterator[pa.Table]:
    """An index partition in tables whose vectors stay below a bound."""
    for batch in batches:
        if batch.num_rows:
            width = max(1, len(batch.column(vector).flatten()) // batch.num_rows) * 4
            yield from gathered(_again(batch, batches), max(1, most_bytes // width))


def _again(batch: pa.RecordBatch, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield batch
    yield from batches


def query_blocks(files: list[str], columns: list[str], rows: int) -> Iterator[pa.Table]:
    """All queries in the order of their files, in tables of ``rows`` rows."""

    def batches() -> Iterator[pa.RecordBatch]:
        for path in files:
            system, place = fs.FileSystem.from_uri(path)
            with system.open_input_file(place) as source:
                yield from pq.ParquetFile(source).iter_batches(batch_size=min(rows, 4096), columns=columns)

    for table in gathered(batches(), rows):
        yield table.select(columns)


def rows_by_number(lists: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all lists (one a row) in order, and the rows that they stand in."""
    flat = lists.astype(np.int64).ravel()
    order = np.argsort(flat, kind="stable")
    return flat[order], order // max(1, lists.shape[1] if lists.ndim == 2 else 1)


def numbers_in_order(own: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Each number of a sorted column, and where it stands."""
    numbers, first, counts = np.unique(own, return_index=True, return_counts=True)
    for number, start, count in zip(numbers.tolist(), first.tolist(), counts.tolist()):
        yield number, slice(start, start + count)


class Best:
    """The k best scores of each query of a block, as far as its task has seen."""

    def __init__(self, n: int, k: int) -> None:
        self.scores, self.k = np.full((n, k), -np.inf), k

    def least(self, rows: np.ndarray | slice = slice(None)) -> np.ndarray:
        return self.scores[rows, -1]

    def add(self, rows: np.ndarray, scores: np.ndarray) -> None:
        """Scores of sorted rows, at most k of a row."""
        some, (number, place) = V._places(rows)
        grid = np.full((len(some), self.k), -np.inf)
        grid[number, place] = scores
        self.scores[some] = -np.sort(-np.concatenate([self.scores[some], grid], axis=1), axis=1)[:, : self.k]


def best_hits(
    index: DataFrame, files: list[str], schema: T.StructType, k: int, query_key: str, key: str, vector: str,
    query_block: int, vector_block: int = V.TILE_COLUMNS, query_vector: str | None = None, cells: str | None = None,
) -> DataFrame:
    """Hits by ``schema`` (query, key, score, with a cell before the score if the schema has four fields): of each piece of
    the index, those that are among the k best of a query in their task so far.

    With ``cells``, a column of lists of equal length, a query only meets the vectors of the cells it lists.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    types, names = [to_arrow_type(f.dataType) for f in schema.fields], schema.fieldNames()
    query_vector = query_vector or vector
    wanted = [query_key, query_vector, *([cells] if cells else [])]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, Best] = {}
        for piece in pieces(batches, vector):
            ids = V.keys(piece[key])
            order = np.lexsort((ids, piece["cell"].to_numpy())) if cells else np.argsort(ids, kind="stable")
            piece = piece.take(pa.array(order))
            block, own = V.matrix(piece[vector], plain=True), piece["cell"].to_numpy() if cells else None
            groups = list(numbers_in_order(own)) if cells else [(0, slice(0, len(block)))]
            for number, queries in enumerate(query_blocks(files, wanted, query_block)):
                rows = V.matrix(queries[query_vector], plain=True)
                top = best.setdefault(number, Best(len(rows), k))
                found = []
                if cells:
                    listed, rows_of = rows_by_number(V.matrix(queries[cells]))
                for cell, inside in groups:
                    some = np.arange(len(rows))
                    if cells:
                        some = rows_of[np.searchsorted(listed, cell) : np.searchsorted(listed, cell, "right")]
                    if len(some) == 0:
                        continue
                    at, columns, scores, _ = V.leading(rows[some], block[inside], k, top.least(some), vector_block)
                    if len(at):
                        top.add(some[at], scores)
                        found.append((some[at], inside.start + columns, scores))
                if not found:
                    continue
                at, columns, scores = (np.concatenate(x) for x in zip(*found))
                last = scores >= top.least()[at]
                at, columns, scores = at[last], columns[last], scores[last]
                out = [queries[query_key].take(pa.array(at)), piece[key].take(pa.array(columns)),
                       *([pa.array(own[columns])] if len(names) == 4 else []), pa.array(scores)]
                yield from pa.table([c.cast(t) for c, t in zip(out, types)], names=names).to_batches()

    return index.select(key, vector, *(["cell"] if cells else [])).mapInArrow(scan, schema)
