"""Similarity join on word n-grams: MinHash bands to find pairs, full n-gram sets to verify them.

1. Each text becomes its set of `WORDS`-word n-grams (64-bit hashes; a shorter text is one n-gram as a whole). Texts
   with equal sets are one *set*, known by a 128-bit key; only sets are compared from here on.
2. Rows and bands of the MinHash signature follow from the target recall at the threshold (`plan_bands`); the sets
   are shuffled on their band hashes.
3. Buckets with equal members are kept once. Of a bucket of up to `SMALL` sets the pairs are made, told apart, and
   compared on the full n-gram sets.
4. A larger bucket is cut into blocks of about `BLOCK` sets, and each task compares two blocks as matrices of sets by
   n-grams. No pairs leave it: only, for each set, how many it is linked to, and a star of links for each connected
   group. A pair counts in the first of the large buckets that it shares, so each pair counts once. The work of a
   huge group is spread over as many tasks as it has pairs of blocks.
5. Classes are the connected components of the links, found by rounds of joins on written tables.

The result has one row per document: its class (the smallest id in it) and its number of links (other documents at
or over the threshold, copies with equal sets included).

Cases: texts without words (null, empty) are in no class with others: they have their own id as class and no links.
Repeated rows are copies of each other. Documents without an id take part and have the class of their group; the
class is null if no member has an id. An empty table gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from answerloom.llm import texts as T
from answerloom.session import write_and_reload

WORDS = 5
#: Largest bucket of which pairs are made, and sets in a block of a larger one.
SMALL = 16
BLOCK = 512
#: N-grams multiplied at a time.
COLUMNS = 2048


def plan_bands(threshold: float, recall: float, hashes: int) -> tuple[int, int]:
    """Bands and rows: the most rows (fewest false candidates) whose bands reach the recall with so many hashes."""
    best = None
    for rows in range(1, hashes + 1):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))
        if bands * rows > hashes:
            break
        best = (bands, rows)
    if best is None:
        raise ValueError("too few hashes for this recall")
    return best


@dataclass(frozen=True)
class JoinSettings:
    threshold: float = 0.8
    recall: float = 0.999
    hashes: int = 100


def gram_sets(piece: T.Piece) -> list[np.ndarray]:
    """The sorted distinct n-gram hashes of each row; empty for rows without words."""
    starts, ends, first_word = piece.words()
    tokens = T.span_hash(piece.prefix(), starts, ends)
    grams = T.gram_hash(tokens, WORDS)
    out = []
    for i in range(piece.rows):
        low, high = first_word[i], first_word[i + 1]
        if high - low >= WORDS:
            out.append(np.unique(grams[low : high - WORDS + 1]))
        elif high > low:
            out.append(T.gram_hash(tokens[low:high], high - low) + np.uint64(high - low))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def set_key(grams: np.ndarray) -> bytes:
    """128 bits: two sums over differently mixed members, and so independent of order."""
    with np.errstate(over="ignore"):
        first = T.mix(grams).sum(dtype=np.uint64)
        second = T.mix(grams ^ np.uint64(0xA0761D6478BD642F)).sum(dtype=np.uint64)
    return np.array([first, second], ">u8").tobytes()


def signature(grams: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """The hash of each band: of the minima under `rows` hash functions, computed in blocks of n-grams."""
    seeds = _SEEDS[: bands * rows, None]
    least = np.full(bands * rows, 2**64 - 1, np.uint64)
    for start in range(0, len(grams), 1024):
        values = (grams[None, start : start + 1024] ^ (grams[None, start : start + 1024] >> np.uint64(29))) * seeds
        np.minimum(least, values.min(axis=1), out=least)
    out = np.arange(bands, dtype=np.uint64)
    for row in least.reshape(bands, rows).T:
        out = T.mix(out * np.uint64(0x9E3779B97F4A7C15) + row)
    return out


_SEEDS = np.random.Generator(np.random.PCG64(7)).integers(0, 2**63, 4096, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def signed_documents(documents: DataFrame, settings: JoinSettings) -> DataFrame:
    """id, mark (hash of the text), set (key) and bands of each document; set is null without words."""
    bands, rows = plan_bands(settings.threshold, settings.recall, settings.hashes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in T.pieces(batch.column(2)):
                sets = gram_sets(piece)
                part = batch.slice(piece.first, piece.rows)
                yield pa.RecordBatch.from_arrays([
                    *part.columns[:2],
                    pa.array([set_key(s) if len(s) else None for s in sets], pa.binary()),
                    pa.array([signature(s, bands, rows).view(np.int64) if len(s) else None for s in sets],
                             pa.list_(pa.int64()))], names=["id", "mark", "set", "bands"])

    return documents.mapInArrow(run, "id long, mark long, set binary, bands array<long>")


def sets_of(documents: DataFrame) -> DataFrame:
    """set and its sorted grams, for the documents given."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in T.pieces(batch.column(0)):
                sets = [s for s in gram_sets(piece) if len(s)]
                yield pa.RecordBatch.from_pydict({
                    "set": pa.array([set_key(s) for s in sets], pa.binary()),
                    "grams": pa.array([s.tobytes() for s in sets], pa.binary())})

    return documents.select("text").mapInArrow(run, "set binary, grams binary")


def compared(pairs: DataFrame, sets: DataFrame, left: str, right: str) -> DataFrame:
    """The pairs with `shared` and `total`, the sizes of intersection and union of their n-gram sets."""
    both = (
        pairs.join(sets.select(F.col("set").alias(left), F.col("grams").alias("_a")), left)
        .join(sets.select(F.col("set").alias(right), F.col("grams").alias("_b")), right)
        .select(left, right, "_a", "_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shared, total = [], []
            for a, b in zip(batch.column(2), batch.column(3), strict=True):
                a, b = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)
                joined = np.concatenate([a, b])
                joined.sort(kind="stable")  # two sorted runs: a merge
                common = int((joined[1:] == joined[:-1]).sum())
                shared.append(common)
                total.append(len(joined) - common)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(shared, pa.int64()), pa.array(total, pa.int64())],
                names=[left, right, "shared", "total"])

    return both.mapInArrow(run, f"{left} binary, {right} binary, shared long, total long")


def _linked(settings: JoinSettings):
    return F.col("shared") >= F.lit(settings.threshold) * F.col("total")


def _incidence(owner: np.ndarray, column: np.ndarray, rows: int, low: int) -> np.ndarray:
    out = np.zeros((rows, COLUMNS), np.float32)
    inside = (column >= low) & (column < low + COLUMNS)
    out[owner[inside], column[inside] - low] = 1
    return out


def shared_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all left sets with all right ones; n-grams of a single set take no part."""
    both = [*left, *right]
    owner = np.repeat(np.arange(len(both)), [len(x) for x in both])
    grams, column, count = np.unique(np.concatenate(both), return_inverse=True, return_counts=True)
    common = np.flatnonzero(count > 1)
    place = np.full(len(grams), -1)
    place[common] = np.arange(len(common))
    column = place[column]
    owner, column = owner[column >= 0], column[column >= 0]
    first = owner < len(left)
    out = np.zeros((len(left), len(right)), np.float32)
    for low in range(0, len(common), COLUMNS):
        out += _incidence(owner[first], column[first], len(left), low) @ _incidence(
            owner[~first] - len(left), column[~first], len(right), low).T
    return out


def block_links(grams: list[np.ndarray], buckets: list[list[int]], block: np.ndarray, band: int, left: int, right: int,
                threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of the sets of two blocks, and the matrix of their links. Pairs of an earlier common bucket are left out."""
    a, b = np.flatnonzero(block == left), np.flatnonzero(block == right)
    sizes = np.array([len(g) for g in grams], np.float64)
    shared = shared_counts([grams[i] for i in a], [grams[i] for i in b]).astype(np.float64)
    linked = shared >= threshold * (sizes[a][:, None] + sizes[b][None, :] - shared)
    earlier = {x: k for k, x in enumerate(sorted({x for own in buckets for x in own if x < band}))}
    if earlier:
        flags = np.zeros((len(grams), len(earlier)), np.float32)
        for i, own in enumerate(buckets):
            flags[i, [earlier[x] for x in own if x < band]] = 1
        linked &= flags[a] @ flags[b].T == 0
    if left == right:
        np.fill_diagonal(linked, False)
    return a, b, linked


def local_roots(a: np.ndarray, b: np.ndarray, linked: np.ndarray, count: int) -> np.ndarray:
    """The smallest number in the connected group of each."""
    root = np.arange(count)
    while True:
        before = root.copy()
        root[a] = np.minimum(root[a], np.where(linked, root[b][None, :], count).min(axis=1, initial=count))
        root[b] = np.minimum(root[b], np.where(linked, root[a][:, None], count).min(axis=0, initial=count))
        if (root == before).all():
            return root


def large_bucket_links(members: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """set, root and links by pair of blocks. `members` has band, n, set, copies and buckets (large ones of the set)."""
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    placed = members.withColumn("block", F.pmod(F.xxhash64("set"), blocks).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    placed = placed.join(sets, "set").select(
        "band", F.least("block", "other").alias("left"), F.greatest("block", "other").alias("right"), "block", "set",
        "copies", "buckets", "grams")

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("set")
        names, copies = table["set"].to_pylist(), table["copies"].to_numpy()
        grams = [np.frombuffer(x.as_buffer(), np.uint64) for x in table["grams"]]
        a, b, linked = block_links(grams, table["buckets"].to_pylist(), table["block"].to_numpy(), table["band"][0].as_py(),
                                   table["left"][0].as_py(), table["right"][0].as_py(), threshold)
        links = np.zeros(len(names), np.int64)
        links[a] += linked @ copies[b]
        if table["left"][0].as_py() != table["right"][0].as_py():
            links[b] += linked.T @ copies[a]
        root = local_roots(a, b, linked, len(names))
        some = np.flatnonzero(links)
        return pa.table({"set": pa.array([names[i] for i in some], pa.binary()),
                         "root": pa.array([names[root[i]] for i in some], pa.binary()),
                         "links": pa.array(links[some], pa.int64())})

    return placed.groupBy("band", "left", "right").applyInArrow(run, "set binary, root binary, links long")


def components(edges: DataFrame) -> DataFrame:
    """node and root (the smallest node reached) of the undirected edges a, b.

    Each round gives every node the smallest label around it and then the label of its label, so paths halve.
    Rounds end when nothing changes; each is written, so none is computed again.
    """
    both = write_and_reload(
        edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct(), "component-edges")
    label = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
    label = write_and_reload(label.select("node", F.least("node", "root").alias("root")), "component-labels")
    while True:
        around = both.join(label, F.col("b") == F.col("node")).groupBy("a").agg(F.min("root").alias("near"))
        nearer = label.join(around, F.col("node") == F.col("a")).select(
            "node", F.col("root").alias("old"), F.least("root", "near").alias("root"))
        jump = label.select(F.col("node").alias("via"), F.col("root").alias("next"))
        after = write_and_reload(
            nearer.join(jump, F.col("root") == F.col("via"))
            .select("node", "old", F.least("root", "next").alias("root")), "component-labels")
        label = after.select("node", "root")
        if after.where("old <> root").isEmpty():
            return label


def classes(documents: DataFrame, settings: JoinSettings = JoinSettings(), key: str = "doc_id",
            text: str = "text") -> DataFrame:
    """id, mark (hash of the text), class_id, n_links and root (a key of the class, null without words)."""
    plain = documents.select(F.col(key).cast("long").alias("id"), F.xxhash64(text).alias("mark"),
                             F.coalesce(F.col(text), F.lit("")).alias("text"))
    signed = write_and_reload(signed_documents(plain, settings), "signed-documents")
    sets = write_and_reload(
        signed.where("set IS NOT NULL").groupBy("set")
        .agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("copies"), F.min(F.struct("mark", "id")).alias("at"),
             F.first("bands").alias("bands")), "distinct-sets")

    buckets = sets.select("set", "copies", F.explode("bands").alias("band"))
    sizes = buckets.groupBy("band").agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("set")).alias("f1"), F.bit_xor(F.xxhash64("set", F.lit(1))).alias("f2"))
    once = sizes.where("n > 1").groupBy("n", "f1", "f2").agg(F.min("band").alias("band")).select("band", "n")
    members = write_and_reload(buckets.join(once, "band"), "bucket-members")
    wanted = members.select("set").distinct().join(sets.select("set", "at"), "set").select(
        F.col("at.mark").alias("m"), F.col("at.id").alias("i"))
    texts = plain.join(wanted, (F.col("mark") == F.col("m")) & F.col("id").eqNullSafe(F.col("i")), "left_semi")
    grams = write_and_reload(sets_of(texts).groupBy("set").agg(F.first("grams").alias("grams")), "gram-sets")

    small, large = members.where(F.col("n") <= SMALL), members.where(F.col("n") > SMALL)
    own = large.groupBy("set").agg(F.collect_list("band").alias("buckets"))  # no more than bands
    pairs = (
        small.select("band", F.col("set").alias("a")).join(small.select("band", F.col("set").alias("b")), "band")
        .where("a < b").select("a", "b").distinct())
    for end in ("a", "b"):
        pairs = pairs.join(own.withColumnsRenamed({"set": end, "buckets": f"in_{end}"}), end, "left")
    pairs = pairs.where(~F.coalesce(F.arrays_overlap("in_a", "in_b"), F.lit(False))).select("a", "b")
    single = write_and_reload(compared(pairs, grams, "a", "b").where(_linked(settings)).select("a", "b"), "single-links")
    blocked = write_and_reload(large_bucket_links(large.join(own, "set"), grams, settings.threshold), "block-links")

    counts = sets.select("set", "copies")
    one_by_one = single.union(single.select("b", "a")).join(counts.withColumnRenamed("set", "b"), "b").select(
        F.col("a").alias("set"), F.col("copies").alias("links"))
    links = one_by_one.unionByName(blocked.select("set", "links")).groupBy("set").agg(F.sum("links").alias("links"))

    edges = single.union(blocked.select(F.col("set").alias("a"), F.col("root").alias("b")).distinct())
    roots = components(edges)
    grouped = sets.select("set", "first", "copies").join(roots, F.col("set") == F.col("node"), "left").select(
        "set", "first", "copies", F.coalesce("root", "set").alias("root"))
    named = grouped.groupBy("root").agg(F.min("first").alias("class_id"))
    facts = write_and_reload(
        grouped.join(named, "root").join(links, "set", "left")
        .select("set", "root", "class_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")),
        "set-facts")
    alone = signed.where("set IS NULL").select(
        "id", "mark", F.col("id").alias("class_id"), F.lit(0).cast("long").alias("n_links"), F.col("set").alias("root"))
    return signed.select("id", "mark", "set").join(facts, "set").select(
        "id", "mark", "class_id", "n_links", "root").unionByName(alone)


def join_documents(documents: DataFrame, settings: JoinSettings = JoinSettings(), key: str = "doc_id",
                   text: str = "text") -> DataFrame:
    """key, class_id and n_links of each document."""
    return classes(documents, settings, key, text).select(F.col("id").alias(key), "class_id", "n_links")


def keep_one(documents: DataFrame, settings: JoinSettings = JoinSettings(), key: str = "doc_id",
             text: str = "text") -> DataFrame:
    """One document of each class, that with the smallest id, with all its columns; texts without words all stay."""
    first = classes(documents, settings, key, text).where("root IS NOT NULL").groupBy("root").agg(
        F.min(F.struct(F.col("id").isNull().alias("last"), "id", "mark")).alias("first"))
    first = first.select(F.col("first.id").alias("_id"), F.col("first.mark").alias("_mark")).distinct()
    source = T.packed(documents, text)
    worded = F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    named = source.where(worded).select("row", F.col(f"row.`{key}`").cast("long").alias("id"), F.xxhash64("text").alias("mark"))
    kept = named.join(first, F.col("id").eqNullSafe(F.col("_id")) & (F.col("mark") == F.col("_mark")), "left_semi")
    once = kept.groupBy("id", "mark").agg(F.first("row").alias("row")).select("row.*")
    return once.union(source.where(~worded).select("row.*"))
