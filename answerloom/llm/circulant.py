"""Near copies by circulant MinHash: two permutations give all coordinates of a signature.

1. Each text, lower-cased in A to Z, becomes its set of `WORDS`-word shingles (64-bit hashes; a shorter text is one
   shingle as a whole). Texts with equal sets are one *set* from here on, known by its smallest id and a 128-bit key.
2. A shingle is a place in a circle of `CIRCLE` places. The first permutation moves the places; the second one, turned by
   k places, gives the values of the k-th hash function, and its least value in the set is coordinate k. So the values of
   one shingle under all functions stand side by side in the second permutation: a signature is the least, place by
   place, of such windows.
3. Coordinates are cut into bands, whose number and rows follow from the recall wanted at the threshold. Sets that share a
   band are compared on their full shingle sets: pair by pair in small buckets, block by block as matrices in large ones.
4. Components of the links are found by rounds of joins on written tables; the key of a set begins with its smallest id,
   so the smallest key that a set reaches tells the component's id.

Places of different shingles may coincide in the circle; that adds candidates or takes a few away at random, as any
MinHash does, and never a wrong link, since links are confirmed on the 64-bit sets.

Cases: texts without words (null, empty, white) have no shingles, are linked with nothing, and keep their own id. Repeated
rows and copies are linked. Documents without an id take part; a component without any id has a null one. Texts of any
length are read whole. An empty table gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from answerloom.llm import texts as T
from answerloom.llm.jaccard import compared, components, large_bucket_links, plan_bands, set_key
from answerloom.session import write_and_reload

WORDS = 4
#: Places of the circle.
CIRCLE_BITS = 22
CIRCLE = 1 << CIRCLE_BITS
#: Largest bucket of which pairs are made.
SMALL = 16


@dataclass(frozen=True)
class CopySettings:
    """Links have a similarity of `percent` or more; a pair at this very similarity is a candidate with `recall`."""

    percent: int = 80
    recall: float = 0.9999
    hashes: int = 128


@cache
def permutations(hashes: int) -> tuple[np.ndarray, np.ndarray]:
    """The permutation of the places, and the windows of `hashes` values of the second one that begin at each place."""
    draw = np.random.Generator(np.random.PCG64(11))
    moved = draw.permutation(CIRCLE).astype(np.int32)
    values = draw.permutation(CIRCLE).astype(np.uint32)
    turned = np.concatenate([values, values[: hashes - 1]])
    return moved, np.lib.stride_tricks.sliding_window_view(turned, hashes)


def signature(shingles: np.ndarray, hashes: int) -> np.ndarray:
    """Coordinate k is the least value of the set's places in the second permutation turned by k."""
    moved, windows = permutations(hashes)
    places = moved[(shingles >> np.uint64(64 - CIRCLE_BITS)).astype(np.int64)]
    least = np.full(hashes, CIRCLE, np.uint32)
    for start in range(0, len(places), 1024):
        np.minimum(least, windows[places[start : start + 1024]].min(axis=0), out=least)
    return least


def band_hashes(coordinates: np.ndarray, bands: int) -> np.ndarray:
    out = np.arange(bands, dtype=np.uint64)
    for row in coordinates.reshape(bands, -1).T.astype(np.uint64):
        out = T.mix(out * np.uint64(0x9E3779B97F4A7C15) + row)
    return out


def shingle_sets(piece: T.Piece) -> list[np.ndarray]:
    """The sorted distinct shingles of each row; none for rows without words."""
    starts, ends, first_word = piece.words()
    words = T.span_hash(piece.prefix(T.LOWER_ASCII[piece.data]), starts, ends)
    runs = T.gram_hash(words, WORDS)
    out = []
    for low, high in zip(first_word[:-1], first_word[1:]):
        if high - low >= WORDS:
            out.append(np.unique(runs[low : high - WORDS + 1]))
        elif high > low:
            out.append(T.gram_hash(words[low:high], high - low) + np.uint64(high - low))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def signed_documents(documents: DataFrame, settings: CopySettings) -> DataFrame:
    """id, mark, n_shingles, set and bands of each document."""
    bands, rows = plan_bands(settings.percent / 100, settings.recall, settings.hashes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in T.pieces(batch.column(2)):
                sets = shingle_sets(piece)
                own = batch.slice(piece.first, piece.rows)
                yield pa.RecordBatch.from_arrays([
                    *own.columns[:2], pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([set_key(s) if len(s) else None for s in sets], pa.binary()),
                    pa.array([band_hashes(signature(s, bands * rows), bands).view(np.int64) if len(s) else None for s in sets],
                             pa.list_(pa.int64()))], names=["id", "mark", "n_shingles", "set", "bands"])

    return documents.mapInArrow(run, "id long, mark long, n_shingles long, set binary, bands array<long>")


def full_sets(texts: DataFrame) -> DataFrame:
    """set and its shingles, of the texts given."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in T.pieces(batch.column(0)):
                sets = [s for s in shingle_sets(piece) if len(s)]
                yield pa.RecordBatch.from_pydict({"own": pa.array([set_key(s) for s in sets], pa.binary()),
                                                  "grams": pa.array([s.tobytes() for s in sets], pa.binary())})

    return texts.select("text").mapInArrow(run, "own binary, grams binary")


_SIGN = -(1 << 63)


def node_key(first: Column, own: Column) -> Column:
    """Bytes that sort by id and then by set; sets without an id come last."""
    number = F.lpad(F.hex(F.coalesce(first, F.lit(0)).bitwiseXOR(F.lit(_SIGN))), 16, "0")
    return F.concat(F.when(first.isNull(), F.unhex(F.lit("01"))).otherwise(F.unhex(F.lit("00"))), F.unhex(number), own)


def node_id(node: Column) -> Column:
    number = F.conv(F.hex(F.substring(node, 2, 8)), 16, -10).cast("long").bitwiseXOR(F.lit(_SIGN))
    return F.when(F.hex(F.substring(node, 1, 1)) == "00", number)


def links(documents: DataFrame, sets: DataFrame, settings: CopySettings) -> DataFrame:
    """Links a, b between sets, enough to connect all that are linked."""
    buckets = sets.select("set", "copies", F.explode("bands").alias("band"))
    sizes = buckets.groupBy("band").agg(  # buckets with equal members are looked at once
        F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("set")).alias("f1"), F.bit_xor(F.xxhash64("set", F.lit(1))).alias("f2"))
    once = sizes.where("n > 1").groupBy("n", "f1", "f2").agg(F.min("band").alias("band")).select("band", "n")
    members = write_and_reload(buckets.join(once, "band"), "copy-buckets")

    wanted = write_and_reload(members.select("set").distinct().join(sets.select("set", "own", "at"), "set"), "copy-candidates")
    chosen = wanted.select(F.col("at.mark").alias("m"), F.col("at.id").alias("i"))
    texts = documents.join(chosen, (F.col("mark") == F.col("m")) & F.col("id").eqNullSafe(F.col("i")), "left_semi")
    full = full_sets(texts).groupBy("own").agg(F.first("grams").alias("grams"))
    grams = write_and_reload(wanted.select("set", "own").join(full, "own").select("set", "grams"), "copy-shingles")

    small, large = members.where(F.col("n") <= SMALL), members.where(F.col("n") > SMALL)
    own = large.groupBy("set").agg(F.collect_list("band").alias("buckets"))  # no more than bands
    pairs = (
        small.select("band", F.col("set").alias("a")).join(small.select("band", F.col("set").alias("b")), "band")
        .where("a < b").select("a", "b").distinct())
    linked = 100 * F.col("shared") >= settings.percent * F.col("total")
    single = compared(pairs, grams, "a", "b").where(linked).select("a", "b")
    blocked = large_bucket_links(large.join(own, "set"), grams, settings.percent / 100)
    return single.union(blocked.where("links > 0 AND set <> root").select(F.col("set").alias("a"), F.col("root").alias("b")).distinct())


def near_copies(documents: DataFrame, settings: CopySettings = CopySettings(), key: str = "doc_id",
                text: str = "text") -> DataFrame:
    """key, n_shingles, component_id (the smallest id reached) and kept (it is the document's own)."""
    plain = documents.select(F.col(key).cast("long").alias("id"), F.xxhash64(text).alias("mark"),
                             F.coalesce(F.col(text), F.lit("")).alias("text"))
    signed = write_and_reload(signed_documents(plain, settings), "signed-copies")
    sets = signed.where("set IS NOT NULL").groupBy(F.col("set").alias("own")).agg(
        F.min("id").alias("first"), F.count(F.lit(1)).alias("copies"), F.min(F.struct("mark", "id")).alias("at"),
        F.first("bands").alias("bands"))
    sets = write_and_reload(sets.withColumn("set", node_key(F.col("first"), F.col("own"))), "copy-sets")
    roots = components(write_and_reload(links(plain, sets, settings), "copy-links"))
    named = sets.select("own", "set").join(roots, F.col("set") == F.col("node"), "left").select(
        "own", node_id(F.coalesce("root", "set")).alias("component_id"))
    found = signed.select("id", "n_shingles", F.col("set").alias("own"))
    alone = found.where("own IS NULL").select("id", "n_shingles", F.col("id").alias("component_id"))
    every = found.join(named, "own").select("id", "n_shingles", "component_id").union(alone)
    return every.select(F.col("id").alias(key), "n_shingles", "component_id",
                        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
