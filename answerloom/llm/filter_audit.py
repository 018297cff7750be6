"""Filter interaction audit: what each of several filters removes, in every order in which they can run.

1. `failure_masks` gives each document the bit mask of the filters that it fails. Four filters look at the text alone;
   the last one finds texts that a smaller id has too, by the smallest id of each text digest.
2. Documents are counted by part and mask, so that a part becomes 2^k cells, whatever its size.
3. `walk` visits all subsets of filters in Gray-code order. Each step toggles one filter: the counter of active failures
   of every cell that fails it moves by one, and the running survivors change by the cells that leave or reach zero.
   The survivors of each of the 2^k subsets are stored.
4. Every step of every order is a difference of two stored states: before and after its filter.

Only the masks and keys are shuffled, never texts. Identical texts are combined before the shuffle; the way back to the
documents is a join on digest and id together, so a text with a third of all rows is spread like any other.

Cases: a null text is empty; a null part is the empty string. Documents without an id count, but are never smaller than
others nor have smaller ones. Repeated rows count one by one and are no copies of each other, as they have the same id.
Documents without a label are neither good nor toxic; of several labels of a document, one is enough. An empty table has
no parts and gives no rows. Texts of any length are read whole. Further columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from answerloom.llm import texts as T
from answerloom.session import write_and_reload

#: The filters, in the order of their bits: few words, few different words, many capitals, symbols, a copy.
FILTERS = "ABCDE"
LEAST_WORDS = 200
LEAST_DISTINCT_PERCENT = 50
MOST_CAPITAL_PERCENT = 3

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#$%&*|"]] = True
_CAPITAL = np.zeros(256, bool)
_CAPITAL[0x41:0x5B] = True
#: Bytes that begin a character.
_BEGINS = (np.arange(256) & 0xC0) != 0x80

STEP_SCHEMA = ("part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
               "good_lost long, toxic_lost long, shapley long")


def text_masks(piece: T.Piece) -> np.ndarray:
    """The filters A to D that each text fails, as bits."""
    starts, ends, first_word = piece.words()
    hashes = T.span_hash(piece.prefix(), starts, ends)
    n_words = np.diff(first_word)
    distinct = np.array([len(np.unique(hashes[a:b])) for a, b in zip(first_word[:-1], first_word[1:])], np.int64)
    capitals, points, symbols = (T.row_sums(which[piece.data], piece.offsets) for which in (_CAPITAL, _BEGINS, _SYMBOL))
    return ((n_words < LEAST_WORDS) * 1 + (100 * distinct < LEAST_DISTINCT_PERCENT * n_words) * 2
            + (100 * capitals > MOST_CAPITAL_PERCENT * points) * 4 + (symbols > 0) * 8).astype(np.int32)


def failure_masks(documents: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """id, part and mask of each document."""
    plain = documents.select(
        F.col(key).cast("long").alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col(text), F.lit("")).alias("text"))
    plain = plain.select("id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in T.pieces(batch.column(3)):
                own = batch.slice(piece.first, piece.rows)
                yield pa.RecordBatch.from_arrays([*own.columns[:3], pa.array(text_masks(piece), pa.int32())],
                                                 names=["id", "part", "digest", "mask"])

    judged = write_and_reload(plain.mapInArrow(run, "id long, part string, digest binary, mask int"), "judged-texts")
    first = judged.where("id IS NOT NULL").groupBy("digest").agg(F.min("id").alias("id")).withColumn("is_first", F.lit(True))
    copy = F.when(F.col("id").isNull() | F.col("is_first"), 0).otherwise(16)
    return judged.join(first, ["digest", "id"], "left").select("id", "part", F.col("mask").bitwiseOR(copy).alias("mask"))


def mask_cells(masks: DataFrame, labels: DataFrame, filters: str = FILTERS, key: str = "doc_id") -> DataFrame:
    """part and its cells: for each mask in order the documents, the good and the toxic ones, one after the other."""
    marks = labels.groupBy(F.col(key).cast("long").alias("id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("bad"))
    counts = masks.join(marks, "id", "left").groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"),
        F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    return counts.groupBy("part").agg(*[  # at most 2^k rows a part
        F.coalesce(F.sum(F.when(F.col("mask") == mask, F.col(name))), F.lit(0)).alias(f"{name}{mask}")
        for mask in range(1 << len(filters)) for name in ("n", "good", "bad")]
    ).select("part", F.array(*[f"{name}{mask}" for mask in range(1 << len(filters)) for name in ("n", "good", "bad")]).alias("cells"))


def walk(cells: np.ndarray) -> np.ndarray:
    """The survivors of each subset of filters. `cells` is parts x masks x figures, and so is the result, by subset."""
    masks = np.arange(cells.shape[1])
    failures = np.zeros(len(masks), np.int64)  # active filters that a cell fails
    survivors = cells.sum(axis=1)
    states = np.empty_like(cells)
    states[:, 0] = survivors
    active = 0
    for step in range(1, len(masks)):
        bit = step & -step  # the one filter that the Gray code toggles here
        active ^= bit
        fails = masks & bit != 0
        if active & bit:
            survivors = survivors - cells[:, fails & (failures == 0)].sum(axis=1)
            failures[fails] += 1
        else:
            failures[fails] -= 1
            survivors = survivors + cells[:, fails & (failures == 0)].sum(axis=1)
        states[:, active] = survivors
    return states


def order_steps(states: np.ndarray, filters: str = FILTERS) -> Iterator[tuple[str, int, np.ndarray]]:
    """Order, step number and the figures of that step for all parts: kept, removed, redundant, unique_fails, good_lost,
    toxic_lost, shapley."""
    everything = (1 << len(filters)) - 1
    steps = []
    removed_by = np.zeros((len(filters), len(states)), np.int64)
    for order in permutations(range(len(filters))):
        before = 0
        for number, which in enumerate(order, start=1):
            bit = 1 << which
            lost = states[:, before] - states[:, before | bit]
            failing = states[:, 0, 0] - states[:, bit, 0]
            unique = states[:, everything ^ bit, 0] - states[:, everything, 0]
            steps.append((order, number, which, (states[:, before | bit, 0], lost[:, 0], failing - lost[:, 0], unique,
                                                 lost[:, 1], lost[:, 2])))
            removed_by[which] += lost[:, 0]
            before |= bit
    for order, number, which, figures in steps:
        yield "".join(filters[i] for i in order), number, np.stack([*figures, removed_by[which]])


def audit_cells(cells: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row for each part, order and step."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                own = batch.slice(start, 256)
                table = np.array(own.column(1).to_pylist(), np.int64).reshape(own.num_rows, 1 << len(filters), 3)
                for order, number, figures in order_steps(walk(table), filters):
                    yield pa.RecordBatch.from_arrays(
                        [own.column(0), pa.array([order] * own.num_rows), pa.array([number] * own.num_rows, pa.int32()),
                         *[pa.array(f, pa.int64()) for f in figures]],
                        names=[field.split()[0] for field in STEP_SCHEMA.split(", ")])

    return cells.mapInArrow(run, STEP_SCHEMA)


def audit(documents: DataFrame, labels: DataFrame) -> DataFrame:
    return audit_cells(mask_cells(failure_masks(documents), labels))
