"""Benchmark decontamination by greedy string tiling.

1. Seeds: every run of `SEED` words of the benchmark. They are told apart into blocks of bounded size by their hash,
   and each block is looked up in one scan of all documents (a sorted array and a bit map of fixed size in each task).
2. Documents with seeds meet the benchmark items in a join on the seeds; both sides are salted, because a seed may
   stand in any share of the documents.
3. The words of an item that its shared seeds can cover bound what tiles can cover, as every tile consists of seeds. Only
   pairs that can reach one of the thresholds go on, and only then are texts fetched.
4. Each pair is tiled: the longest matches that do not overlap are marked again and again, found by running
   Karp-Rabin hashes over what is not marked yet, down to `LEAST` words. Tiles may stand in any order, so reordered
   passages are covered too. An item with at least `coverage` of its words in tiles, or a tile of
   `long_run` words, marks the document.

Words are runs of ASCII letters, digits and bytes beyond ASCII, with A-Z in lower case. Items shorter than a seed are
seeds as a whole.

Cases: null and empty texts, and texts without words, match nothing. Equal rows of a table count once. Documents
without an id are found too and give rows with a null id. An empty table on either side gives no rows. Other columns
are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from answerloom.llm import texts as T
from answerloom.session import write_and_reload

SEED = 4
LEAST = 4
COVERAGE = 0.5
#: Words of a single tile that are enough, however long the item is.
LONG_RUN = 13
#: Seeds looked up in one scan (8 bytes each in every task).
BLOCK_SEEDS = 1 << 21
SALTS = 16

ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def token_hashes(piece: T.Piece) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, first_word = piece.words(ALNUM)
    return T.span_hash(piece.prefix(T.LOWER_ASCII[piece.data]), starts, ends), first_word


def tokens_of(text: str | None) -> np.ndarray:
    return token_hashes(next(T.pieces(pa.array([text], pa.string()))))[0]


def seeds_of(tokens: np.ndarray, first_word: np.ndarray, size: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of each run of `size` words."""
    at, row = T.inner_grams(first_word, size)
    return T.gram_hash(tokens, size)[at] + np.uint64(size), row


def item_seeds(items: DataFrame) -> DataFrame:
    """item, its words, seed, size, and the places at which the seed stands in the item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in T.pieces(batch.column(1)):
                tokens, first_word = token_hashes(piece)
                counts, found = np.diff(first_word), []
                for size in range(1, SEED + 1):
                    seeds, row = seeds_of(tokens, first_word, size)
                    fits = (counts[row] == size) | (size == SEED)
                    found.append((seeds[fits], row[fits], np.full(fits.sum(), size, np.int32)))
                seeds, row, sizes = map(np.concatenate, zip(*found, strict=True))
                keys = batch.column(0).slice(piece.first, piece.rows)
                yield pa.RecordBatch.from_pydict({
                    "item": keys.take(pa.array(row)), "n_words": pa.array(counts[row], pa.int64()),
                    "seed": pa.array(seeds.view(np.int64)), "size": pa.array(sizes)})

    every = items.select("item", "words").mapInArrow(run, "item long, n_words long, seed long, size int")
    return every.groupBy("item", "n_words", "seed", "size").agg(F.count(F.lit(1)).alias("places"))


class SeedSet:
    """Sorted seeds behind a bit map that most words never pass."""

    def __init__(self, seeds: np.ndarray) -> None:
        self.seeds = np.sort(seeds)
        self.shift = np.uint64(64 - max(10, int(len(seeds) * 16).bit_length()))
        self.map = np.zeros(1 << (64 - int(self.shift)), bool)
        self.map[self.seeds >> self.shift] = True

    def member(self, values: np.ndarray) -> np.ndarray:
        found = self.map[values >> self.shift]
        some = np.flatnonzero(found)
        at = np.minimum(np.searchsorted(self.seeds, values[some]), max(0, len(self.seeds) - 1))
        found[some] = self.seeds[at] == values[some]
        return found


def seeded_documents(documents: DataFrame, seeds: DataFrame) -> DataFrame:
    """key, mark, text and seeds of the documents that hold a seed; one scan for each block of seeds."""
    spark = documents.sparkSession
    distinct = seeds.select("seed", "size").distinct()
    blocks = max(1, -(-distinct.count() // (BLOCK_SEEDS // 2)))
    out = None
    for block in range(blocks):
        chosen = distinct.where(F.pmod("seed", F.lit(blocks)) == block).toArrow()
        sizes = sorted(set(chosen.column("size").to_pylist()))
        held = spark.sparkContext.broadcast(
            (SeedSet(chosen.column("seed").to_numpy().view(np.uint64)), sizes))

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            known, sizes = held.value
            for batch in batches:
                for piece in T.pieces(batch.column(2)):
                    tokens, first_word = token_hashes(piece)
                    hits = []
                    for size in sizes:
                        values, row = seeds_of(tokens, first_word, size)
                        found = known.member(values)
                        hits.append((row[found], values[found]))
                    row, values = map(np.concatenate, zip(*hits, strict=True)) if hits else (np.zeros(0, int),) * 2
                    if not len(row):
                        continue
                    pairs = np.unique(np.rec.fromarrays([row, values]))
                    rows, begins = np.unique(pairs.f0, return_index=True)
                    ends = np.append(begins, len(pairs)).astype(np.int32)
                    part = batch.slice(piece.first, piece.rows).take(pa.array(rows))
                    yield pa.RecordBatch.from_arrays(
                        [*part.columns, pa.ListArray.from_arrays(pa.array(ends), pa.array(pairs.f1.view(np.int64)))],
                        names=["key", "mark", "text", "seeds"])

        hits = documents.mapInArrow(run, "key long, mark long, text string, seeds array<long>")
        out = hits if out is None else out.unionByName(hits)
    return out


def _windows(tokens: np.ndarray, size: int, free: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Running hashes of the windows without a marked word, and their places."""
    forward, back = T.powers(len(tokens) + 1)
    sums = np.zeros(len(tokens) + 1, np.uint64)
    np.cumsum(tokens * forward[: len(tokens)], out=sums[1:])
    taken = np.concatenate([[0], np.cumsum(~free)])
    at = np.flatnonzero(taken[size:] == taken[:-size])
    return T.mix((sums[at + size] - sums[at]) * back[at]), at


def matches(doc: np.ndarray, item: np.ndarray, size: int, doc_free: np.ndarray, item_free: np.ndarray) -> np.ndarray:
    """Maximal matches of at least `size` unmarked words: columns length, place in the document, place in the item."""
    if min(len(doc), len(item)) < size:
        return np.zeros((0, 3), np.int64)
    item_hash, item_at = _windows(item, size, item_free)
    doc_hash, doc_at = _windows(doc, size, doc_free)
    order = np.argsort(item_hash, kind="stable")
    item_hash, item_at = item_hash[order], item_at[order]
    low, high = (np.searchsorted(item_hash, doc_hash, side=s) for s in ("left", "right"))
    counts = high - low
    d = np.repeat(doc_at, counts)
    p = item_at[np.repeat(low, counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)]
    if not len(d):
        return np.zeros((0, 3), np.int64)
    order = np.lexsort((d, d - p))
    d, p = d[order], p[order]
    begins = np.flatnonzero(np.append(True, (np.diff(d) != 1) | (np.diff(p) != 1)))
    lengths = np.diff(np.append(begins, len(d))) + size - 1
    return np.stack([lengths, d[begins], p[begins]], axis=1)


def tile(doc: np.ndarray, item: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int]]:
    """Tiles (length, place in the document, place in the item), the longest first; ties go to the earlier place."""
    least = max(1, min(least, len(item)))
    doc_free, item_free = np.ones(len(doc), bool), np.ones(len(item), bool)
    tiles, size = [], max(least, min(len(item), len(doc)))
    while True:
        found = matches(doc, item, size, doc_free, item_free)
        if not len(found):
            if size == least:
                return tiles
            size = max(least, size // 2)
            continue
        for length, d, p in found[np.lexsort((found[:, 2], found[:, 1], -found[:, 0]))].tolist():
            if doc_free[d : d + length].all() and item_free[p : p + length].all():
                doc_free[d : d + length] = item_free[p : p + length] = False
                tiles.append((length, d, p))
        # a match cut by a longer one is found again, shorter, in the next turn


def contaminated(documents: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
                 item_key: str = "item_id", item_text: str = "text", coverage: float = COVERAGE,
                 long_run: int = LONG_RUN) -> DataFrame:
    """key, item, item_words, tiled_words, n_tiles, longest_tile and coverage of the pairs with `coverage` or a tile of
    `long_run` words; `mark` is the hash of the document's text."""
    items = write_and_reload(
        benchmark.select(F.col(item_key).cast("long").alias("item_id"), F.coalesce(F.col(item_text), F.lit("")).alias("words"))
        .distinct().withColumn("item", F.xxhash64("item_id", "words")), "benchmark-items")
    seeds = write_and_reload(item_seeds(items), "benchmark-seeds")
    plain = documents.select(F.col(key).cast("long").alias("key"), F.xxhash64(text).alias("mark"),
                             F.coalesce(F.col(text), F.lit("")).alias("text"))
    hits = write_and_reload(seeded_documents(plain, seeds), "seeded-documents")
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    salted = hits.withColumn("salt", F.pmod("mark", F.lit(SALTS)).cast("int"))
    pairs = (
        salted.select("key", "mark", "salt", F.explode("seeds").alias("seed"))
        .join(seeds.select("seed", "item", "n_words", "size", "places", salts), ["seed", "salt"])
        .groupBy("key", "mark", "salt", "item")
        .agg(F.sum(F.col("places") * F.col("size")).alias("reach"), F.sum("places").alias("runs"), F.first("n_words").alias("n_words"))
        .where((F.col("reach") >= coverage * F.col("n_words")) | (F.col("runs") > long_run - SEED))
        .select("key", "mark", "salt", "item"))
    texts = salted.groupBy("key", "mark").agg(F.first("text").alias("text"))
    cases = (
        pairs.join(texts.withColumnsRenamed({"key": "k", "mark": "m"}),
                   F.col("key").eqNullSafe(F.col("k")) & (F.col("mark") == F.col("m")))
        .join(items.select("item", "item_id", "words", salts), ["item", "salt"])
        .select("key", "mark", "item_id", "text", "words"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, item in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True):
                item_tokens = tokens_of(item)
                lengths = [x[0] for x in tile(tokens_of(doc), item_tokens)]
                rows.append((len(item_tokens), sum(lengths), len(lengths), max(lengths, default=0)))
            figures = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)] or [pa.array([], pa.int64())] * 4
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], *figures],
                names=["key", "mark", "item_id", "item_words", "tiled_words", "n_tiles", "longest_tile"])

    tiled = cases.mapInArrow(run, "key long, mark long, item_id long, item_words long, tiled_words long, "
                                  "n_tiles long, longest_tile long")
    share = F.col("tiled_words") / F.col("item_words")
    return tiled.withColumn("coverage", share).where(
        (share >= coverage) | (F.col("longest_tile") >= long_run)).withColumnRenamed("key", key)


def decontaminate(documents: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that hold no item of the benchmark, with all their columns."""
    found = contaminated(documents, benchmark, key, text).select(F.col(key).alias("_key"), F.col("mark").alias("_mark"))
    source = T.packed(documents, text)
    return source.join(found.distinct(), F.col(f"row.{key}").cast("long").eqNullSafe(F.col("_key")) & (
        F.xxhash64("text") == F.col("_mark")), "left_anti").select("row.*")
