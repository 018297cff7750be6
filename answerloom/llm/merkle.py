"""Merkle dataset manifest: one root over all rows, and for each row the siblings that prove it.

A row's leaf is a hash of its columns. The leaves of a source stand in the order of their keys; every `WIDTH` consecutive
nodes have their hash as parent (the last run may be shorter), until one node is left, the subroot of the source. The
subroots, in the order of the sources, give the root in the same way.

1. Leaves are computed where the texts are read; from here on a row is its key and one or two digests.
2. Places: leaves are sorted by ranges of (source, key), each range counts its sources, and running sums of these small
   counts give each leaf its place. A source with a third of all rows is many ranges.
3. Aligned blocks of 16^3 leaves are appended one by one to an `OpenTree`. A new leaf attaches its empty partial
   witness to its open subtree; whenever siblings complete a subtree, the witnesses of all rows below are extended by
   them. The block's root is a further append to the tree above, which is cut into blocks in the same way until each
   source has one node. The subroots are leaves of a last such tree.
4. On the way back down a block's rows extend their partial witnesses by the witness of the block's root.

Blocks are stored as tables, so a witness of any row can be had later without a look at the texts. Nothing but the root
and the height of the tallest tree comes to the driver.

Cases: null columns are written `-`, so null and empty differ. A null source is a source of its own, before all others.
Rows without a key come first in their source; rows with equal keys follow their leaves, so repeated rows are leaves side
by side, and have a witness each. Texts are hashed whole at any length. An empty table has no root and gives no rows. Other
columns take no part.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from answerloom.llm import texts as T
from answerloom.session import write_and_reload

#: Children of a node.
WIDTH = 16
#: Levels of a full block: it has WIDTH ** BLOCK_LEVELS nodes.
BLOCK_LEVELS = 3
#: The columns of a leaf, in order.
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def node_hash(children: bytes) -> bytes:
    """Hash of digests written as hex text one after the other, as hex text."""
    return sha256(children).hexdigest().encode()


def levels_over(nodes: int) -> int:
    """Levels above so many nodes until one is left."""
    levels = 0
    while nodes > 1:
        nodes, levels = -(-nodes // WIDTH), levels + 1
    return levels


class OpenTree:
    """A tree under append. `open[level]` is the run of nodes that no parent has yet, each with the witnesses below it.

    A witness is a list of (siblings as hex text, place among them) from the leaf up; it is partial until `finish`.
    """

    def __init__(self, levels: int) -> None:
        self.levels, self.open, self.witnesses = levels, [[] for _ in range(levels + 1)], []

    def append(self, digest: bytes) -> None:
        witness: list[tuple[bytes, int]] = []
        self.witnesses.append(witness)
        self._add(0, digest, [witness])

    def _add(self, level: int, digest: bytes, below: list[list]) -> None:
        self.open[level].append((digest, below))
        if level < self.levels and len(self.open[level]) == WIDTH:
            self._complete(level)

    def _complete(self, level: int) -> None:
        run, self.open[level] = self.open[level], []
        digests = [digest for digest, _ in run]
        for place, (_, below) in enumerate(run):
            step = (b"".join(digests[:place] + digests[place + 1 :]), place)
            for witness in below:
                witness.append(step)
        self._add(level + 1, node_hash(b"".join(digests)), [w for _, below in run for w in below])

    def finish(self) -> bytes:
        """The root, once the last runs are closed as short as they are."""
        for level in range(self.levels):
            if self.open[level]:
                self._complete(level)
        return self.open[self.levels][0][0]


def grown(digests: Sequence[bytes], total: int, block_levels: int) -> OpenTree:
    """The tree of one block, of which the whole level has `total` nodes."""
    tree = OpenTree(min(block_levels, levels_over(total)))
    for digest in digests:
        tree.append(digest)
    return tree


def folded(digest: bytes, witness: Sequence[tuple[bytes, int]]) -> bytes:
    """The root that a leaf and its witness lead to."""
    for siblings, place in witness:
        at = place * len(digest)
        digest = node_hash(siblings[:at] + digest + siblings[at:])
    return digest


def row_text(columns: Sequence[Column]) -> Column:
    """Columns in a form that tells them apart: `-` for null, else the number of bytes, a colon and the value."""
    parts = []
    for column in columns:
        value = column.cast("string")
        parts.append(F.when(value.isNull(), F.lit("-")).otherwise(
            F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)))
    return F.concat(*parts)


def lower_ascii(column: Column) -> Column:
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(column, letters, letters.lower())


def tree_key(source: Column) -> Column:
    """Sources as text in their order: null before all others."""
    return F.when(source.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), source.cast("string")))


def leaves_of(documents: DataFrame, columns: Sequence[str] = COLUMNS, key: str = "doc_id", source: str = "source",
              altered: Column | None = None) -> DataFrame:
    """tree, id, leaf and `other`: the leaf of the row with its text lower-cased, where `altered` holds, else null."""
    own = [F.col(f"`{c}`") for c in columns]
    changed = [lower_ascii(c) if name == "text" else c for name, c in zip(columns, own)]
    other = F.lit(None).cast("string") if altered is None else F.when(altered, F.sha2(row_text(changed), 256))
    return documents.select(
        tree_key(F.col(f"`{source}`")).alias("tree"), F.col(f"`{key}`").cast("long").alias("id"),
        F.unhex(F.sha2(row_text(own), 256)).alias("leaf"), F.unhex(other).alias("other"))


def placed(leaves: DataFrame) -> DataFrame:
    """Leaves with `at`, their place in the tree from 0, and `total`, the leaves of the tree."""
    order = [F.col("tree"), F.col("id").asc_nulls_first(), F.col("leaf")]
    spread = leaves.repartitionByRange(*order).sortWithinPartitions(*order)
    spread = write_and_reload(spread.withColumn("seat", F.monotonically_increasing_id()), "sorted-leaves")
    spread = spread.withColumn("range", F.shiftright("seat", 33))
    counts = spread.groupBy("tree", "range").agg(F.count(F.lit(1)).alias("n"), F.min("seat").alias("first"))
    whole, before = Window.partitionBy("tree"), Window.partitionBy("tree").orderBy("range")
    sums = counts.select("tree", "range", "first", F.sum("n").over(whole).alias("total"),
                         (F.sum("n").over(before) - F.col("n")).alias("before"))
    return spread.join(sums, ["tree", "range"]).select(
        "tree", "id", "leaf", "other", (F.col("before") + F.col("seat") - F.col("first")).alias("at"), "total")


def blocks_of(nodes: DataFrame, id_type: str, block_levels: int) -> DataFrame:
    """Nodes by aligned blocks, one row each, with the block's root."""
    schema = (f"tree string, block long, total long, ids array<{id_type}>, leaves array<binary>, others array<binary>, "
              "root binary")

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("at")
        leaves = group["leaf"].to_pylist()
        total = group["total"][0].as_py()
        root = grown([x.hex().encode() for x in leaves], total, block_levels).finish()
        return pa.table({
            "tree": group["tree"][:1], "block": group["block"][:1], "total": group["total"][:1],
            "ids": [group["id"].to_pylist()], "leaves": [leaves], "others": [group["other"].to_pylist()],
            "root": [bytes.fromhex(root.decode())]}, schema=ARROW[id_type])

    numbered = nodes.select("tree", F.floor(F.col("at") / WIDTH**block_levels).cast("long").alias("block"), "at", "total", "id", "leaf", "other")
    return numbered.groupBy("tree", "block").applyInArrow(run, schema)


def _arrow(kind: pa.DataType) -> pa.Schema:
    return pa.schema([("tree", pa.string()), ("block", pa.int64()), ("total", pa.int64()), ("ids", pa.list_(kind)),
                      ("leaves", pa.list_(pa.binary())), ("others", pa.list_(pa.binary())), ("root", pa.binary())])


ARROW = {"long": _arrow(pa.int64()), "string": _arrow(pa.string())}


def climb(nodes: DataFrame, id_type: str, block_levels: int) -> list[DataFrame]:
    """The written blocks of each layer, from the leaves up to one block for each tree."""
    size = WIDTH**block_levels
    layers = [write_and_reload(blocks_of(nodes, id_type, block_levels), "tree-blocks")]
    while (layers[-1].agg(F.max("total")).first()[0] or 0) > size:
        below = layers[-1].select(
            "tree", F.col("block").alias("at"), F.ceil(F.col("total") / size).cast("long").alias("total"),
            F.lit(None).cast("long").alias("id"), F.col("root").alias("leaf"), F.lit(None).cast("binary").alias("other"))
        layers.append(write_and_reload(blocks_of(below, "long", block_levels), "tree-blocks"))
    return layers


@dataclass(frozen=True)
class Manifest:
    """Stored blocks of all layers, of the sources and of the tree of their subroots; `root` is None without rows."""

    sources: list[DataFrame]
    forest: list[DataFrame]
    root: str | None
    block_levels: int


def build(leaves: DataFrame, block_levels: int = BLOCK_LEVELS) -> Manifest:
    """The manifest of leaves as `leaves_of` gives them."""
    sources = climb(placed(write_and_reload(leaves, "leaves")), "long", block_levels)
    subroots = sources[-1].select(
        F.lit("").alias("tree"), F.col("tree").alias("id"), F.col("root").alias("leaf"), F.lit(None).cast("binary").alias("other"))
    forest = climb(placed(subroots), "string", block_levels)
    top = forest[-1].select(F.lower(F.hex("root"))).first()
    return Manifest(sources, forest, top[0] if top else None, block_levels)


PATH = "tree string, at long, subroot string, siblings array<string>, places array<int>"


def witnesses(blocks: DataFrame, paths: DataFrame) -> DataFrame:
    """The blocks with the witness of their own root in its tree above: `subroot`, `siblings` and `places`."""
    above = paths.select(F.col("tree").alias("_tree"), F.col("at").alias("_at"), "subroot", "siblings", "places")
    return blocks.join(above, (F.col("tree") == F.col("_tree")) & (F.col("block") == F.col("_at"))).select(
        "tree", "block", "total", "ids", "leaves", "others", "subroot", "siblings", "places")


def rows_of(batch: pa.RecordBatch, block_levels: int) -> Iterator[tuple[dict, list[bytes], list[list[tuple[bytes, int]]]]]:
    """For each block its values, the digests of its rows as hex text, and their whole witnesses."""
    for i in range(batch.num_rows):
        block = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
        above = list(zip((s.encode() for s in block["siblings"]), block["places"]))
        digests = [x.hex().encode() for x in block["leaves"]]
        tree = grown(digests, block["total"], block_levels)
        tree.finish()
        for witness in tree.witnesses:
            witness.extend(above)
        yield block, digests, tree.witnesses


def descend(layers: list[DataFrame], paths: DataFrame, block_levels: int) -> DataFrame:
    """The blocks of leaves with the witnesses of their roots, from the witnesses of the trees' roots."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, _, found in rows_of(batch, block_levels):
                start = block["block"] * WIDTH**block_levels
                yield pa.RecordBatch.from_pydict({
                    "tree": [block["tree"]] * len(found), "at": pa.array(range(start, start + len(found)), pa.int64()),
                    "subroot": pa.array([block["subroot"]] * len(found), pa.string()),
                    "siblings": pa.array([[s.decode() for s, _ in w] for w in found], pa.list_(pa.string())),
                    "places": pa.array([[p for _, p in w] for w in found], pa.list_(pa.int32()))})

    for blocks in reversed(layers[1:]):
        paths = witnesses(blocks, paths).mapInArrow(run, PATH)
    return witnesses(layers[0], paths)


def leaf_blocks(manifest: Manifest, spark) -> DataFrame:
    """All blocks of rows with the witnesses of their roots up to the root of the manifest."""
    block_levels = manifest.block_levels
    top = spark.createDataFrame([("", 0, None, [], [])], PATH)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, digests, found in rows_of(batch, block_levels):
                yield pa.RecordBatch.from_pydict({
                    "tree": pa.array(block["ids"], pa.string()), "at": pa.array([0] * len(found), pa.int64()),
                    "subroot": pa.array([d.decode() for d in digests], pa.string()),
                    "siblings": pa.array([[s.decode() for s, _ in w] for w in found], pa.list_(pa.string())),
                    "places": pa.array([[p for _, p in w] for w in found], pa.list_(pa.int32()))})

    return descend(manifest.sources, descend(manifest.forest, top, block_levels).mapInArrow(run, PATH), block_levels)


def row_witnesses(manifest: Manifest, spark) -> DataFrame:
    """id, leaf, subroot, siblings (hex text by level, from the leaf up) and places (among them) of each row."""
    block_levels = manifest.block_levels

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, digests, found in rows_of(batch, block_levels):
                for start in range(0, len(found), 512):
                    some = found[start : start + 512]
                    yield pa.RecordBatch.from_pydict({
                        "id": pa.array(block["ids"][start : start + 512], pa.int64()),
                        "leaf": [d.decode() for d in digests[start : start + 512]],
                        "subroot": [block["subroot"]] * len(some),
                        "siblings": pa.array([[s.decode() for s, _ in w] for w in some], pa.list_(pa.string())),
                        "places": pa.array([[p for _, p in w] for w in some], pa.list_(pa.int32()))})

    return leaf_blocks(manifest, spark).mapInArrow(
        run, "id long, leaf string, subroot string, siblings array<string>, places array<int>")


def proofs(manifest: Manifest, spark) -> DataFrame:
    """id, leaf, subroot, proof_sha256 (hash of all siblings) and folded_root (from the other leaf where there is one)."""
    block_levels = manifest.block_levels

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, digests, found in rows_of(batch, block_levels):
                now = [d if o is None else o.hex().encode() for d, o in zip(digests, block["others"])]
                yield pa.RecordBatch.from_pydict({
                    "id": pa.array(block["ids"], pa.int64()), "leaf": [d.decode() for d in digests],
                    "subroot": [block["subroot"]] * len(found),
                    "proof_sha256": [node_hash(b"".join([s for s, _ in w])).decode() for w in found],
                    "folded_root": [folded(d, w).decode() for d, w in zip(now, found)]})

    return leaf_blocks(manifest, spark).mapInArrow(
        run, "id long, leaf string, subroot string, proof_sha256 string, folded_root string")


def verify_documents(documents: DataFrame, key: str = "doc_id", block_levels: int = BLOCK_LEVELS) -> DataFrame:
    """Each document with its proof, checked against the root; every fifth (by the CRC of its id) is tampered with before."""
    spark = documents.sparkSession
    manifest = build(leaves_of(documents, key=key, altered=T.training_rest(key, 5) == 0), block_levels)
    root = F.lit(manifest.root).cast("string")
    return proofs(manifest, spark).select(
        F.col("id").alias(key), "leaf", "subroot", root.alias("root"), "proof_sha256", "folded_root",
        (F.col("folded_root") == root).alias("verified"))
