"""Token counts that follow edits.

Each document keeps a segment tree over its pre-tokens: the leaves hold the characters and tokens of a pre-token, the
inner nodes the sums of their subtrees. An edit replaces a span of characters. Only the span and its context are
encoded again: from the nearest certain boundary before it to the nearest after it. A certain boundary is a space
between two characters that are not white space, all three outside of the edit: a pre-token starts there whatever
stands further off. The leaves of that stretch are replaced and the sums of the subtrees above them are updated.

A tree has its leaves in blocks; edits change blocks in place. A block that has grown over its bound makes the tree
be dealt into even blocks again, from its leaves, without encoding anything.

Cases: a null text is an empty one, with an empty tree. Edits of one document are given in ascending places, apart
from each other, in the unedited text; those with an end before their start, beyond the text or in the span of an
earlier one are an error. No edits (null or empty) leave the counts as they are. Repeated rows are counted each, other
columns are not looked at, an empty table gives no rows.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from answerloom.llm import piecewise

#: Leaves in a block when a tree is made; a block of twice as many is dealt out again.
BLOCK = 64
#: Bytes of a generation of the memories for pieces and for what stands at the beginning of texts; each has two.
KNOWN_BYTES, ODD_BYTES = 48 << 20, 8 << 20
#: Unicode white space; Python's own set also holds four separators that are not.
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
SPACE = WHITE + "\x1c-\x1f"
BOUNDARY = re.compile(f"(?<=[^{SPACE}]) (?=[^{SPACE}])")
# Fixed value: how the vocabulary's texts are split into pre-tokens.
PRETOKEN = regex.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{WHITE}\p{{L}}\p{{N}}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")


class PretokenCounter:
    """Leaves (characters and tokens of each pre-token, as 32-bit integers) of texts, by pieces between boundaries.

    A piece that has white space beside a place where a cut would have to be has no leaves of its own: its text is cut
    at boundaries looked for one by one.
    """

    def __init__(self, path: str) -> None:
        self.library = piecewise.load(path, ordinary_specials=True)
        self.opens = piecewise.opening(self.library)
        self.known, self.odd = piecewise.Memory(KNOWN_BYTES), piecewise.Memory(ODD_BYTES)

    def _pack(self, lengths: list[int], counts: list[int]) -> bytes:
        return np.array([lengths, counts], "<i4").T.tobytes()

    def _alone(self, pieces: list[str]) -> list[bytes]:
        """Leaves of pieces of any kind, one call for each pre-token."""
        spelled = [PRETOKEN.findall(p) for p in pieces]
        counts = iter([len(x.ids) for x in self.library.encode_batch_fast(
            [t for s in spelled for t in s], add_special_tokens=False)])
        return [self._pack([len(t) for t in s], [next(counts) for _ in s]) for s in spelled]

    def _learn(self, pieces: set[str]) -> None:
        """`known` has the pieces of a text after its first, without the space before them."""
        even, letters, parted = [], [], []
        for piece in self.known.unknown(pieces):
            if parts := piecewise.PARTED.fullmatch(piece):
                if parts[2]:
                    parted.append((piece, parts[1], [parts[2]]))
                else:
                    letters.append(piece)
            elif "\n" in piece and all(lines := [*map(piecewise.PARTED.fullmatch, piece.split("\n"))]):
                bare = [part for line in lines[1:] for part in ("\n", *line.groups())]
                parted.append((piece, lines[0][1], [x for x in (lines[0][2], *bare) if x]))
            elif not piece or piece[0].isspace() or piece[-1].isspace():
                self.known[piece] = None
            else:
                even.append(piece)
        letters += self.known.absent({first for _, first, _ in parted}.difference(letters))
        for group, _, cuts in piecewise.strung_ids(self.library, self.opens, letters):  # one pre-token each
            self.known.update([(p, struct.pack("<2i", len(p) + 1, high - low))
                               for p, low, high in zip(group, cuts, cuts[1:], strict=False)])
        bare = self.odd.absent({part for _, _, rest in parted for part in rest})
        self.odd.update(zip(bare, self._alone(bare), strict=True))
        leaves = self.odd.__getitem__
        self.known.update([(p, self.known[first] + b"".join(map(leaves, rest))) for p, first, rest in parted])
        plain = [p for p in even if not any(c.isspace() for c in p)]
        for group, _, places, cuts in piecewise.strung(self.library, plain):
            places = places.tolist()
            for piece, low, high in zip(group, cuts, cuts[1:], strict=False):
                lengths = [len(t) for t in PRETOKEN.findall(" " + piece)]
                if len(lengths) == 1:
                    self.known[piece] = struct.pack("<2i", lengths[0], high - low)
                    continue
                counts, end, own = [0] * len(lengths), lengths[0], 0
                for place in places[low:high]:
                    while place >= end:
                        own += 1
                        end += lengths[own]
                    counts[own] += 1
                self.known[piece] = struct.pack(f"<{2 * len(lengths)}i", *[x for pair in zip(lengths, counts) for x in pair])
        rest = [p for p in even if any(c.isspace() for c in p)]
        self.known.update(zip(rest, self._alone([" " + p for p in rest]), strict=True))

    def _odd(self, pieces: list[str]) -> bytes:
        new = self.odd.unknown(set(pieces))
        self.odd.update(zip(new, self._alone(new), strict=True))
        return b"".join([self.odd[p] for p in pieces])

    def leaves_of(self, texts: list[str]) -> list[np.ndarray]:
        """Characters and tokens of each pre-token of texts that start and end at certain boundaries."""
        cut = [text.split(" ") for text in texts]
        self._learn(set().union(*[x[1:] for x in cut]))
        out = []
        for text, (first, *rest) in zip(texts, cut, strict=True):
            leaves = [self.known[p] for p in rest]
            if None in leaves or first[-1:].isspace():
                starts = [m.start() for m in BOUNDARY.finditer(text)]
                packed = self._odd([text[a:b] for a, b in zip([0, *starts], [*starts, len(text)], strict=True)])
            else:
                packed = self._odd([first]) + b"".join(leaves)
            out.append(np.frombuffer(packed, "<i4").reshape(-1, 2))
        return out

    def leaves(self, text: str) -> np.ndarray:
        return self.leaves_of([text])[0]


class PretokenTree:
    """Blocks of leaves under a binary tree of sums; node 1 is the root, block b lies under node `size + b`."""

    def __init__(self, leaves: np.ndarray) -> None:
        self.build([leaves[i : i + BLOCK] for i in range(0, len(leaves), BLOCK)])

    def build(self, blocks: list[np.ndarray], sums: np.ndarray | None = None) -> None:
        self.blocks = blocks
        self.size = 1 << max(0, len(blocks) - 1).bit_length()
        if sums is None:
            sums = np.zeros((2 * self.size, 2), np.int64)
            if blocks:
                flat, begins = np.concatenate(blocks), np.cumsum([0, *[len(b) for b in blocks[:-1]]])
                total = np.concatenate([np.zeros((1, 2), np.int64), np.cumsum(flat, axis=0, dtype=np.int64)])
                ends = np.append(begins[1:], len(flat))
                sums[self.size : self.size + len(blocks)] = total[ends] - total[begins]
            level = self.size
            while level > 1:
                level //= 2
                sums[level : 2 * level] = sums[2 * level : 4 * level : 2] + sums[2 * level + 1 : 4 * level : 2]
        self.sums = sums

    @property
    def chars(self) -> int:
        return int(self.sums[1, 0])

    @property
    def tokens(self) -> int:
        return int(self.sums[1, 1])

    def find(self, char: int) -> tuple[int, int]:
        """Block and leaf at whose start a character place lies; (number of blocks, 0) at the end of the text."""
        if char == self.chars:
            return len(self.blocks), 0
        node, before = 1, 0
        while node < self.size:
            node *= 2
            if char >= before + self.sums[node, 0]:
                before += self.sums[node, 0]
                node += 1
        block = node - self.size
        starts = before + np.concatenate([[0], np.cumsum(self.blocks[block][:, 0])])
        leaf = int(np.searchsorted(starts, char))
        if starts[leaf] != char:
            raise ValueError("no pre-token starts at this place")
        return block, leaf

    def replace(self, start: int, end: int, leaves: np.ndarray) -> None:
        """Put leaves in the place of those from character `start` to `end`, and update the sums above them."""
        if not self.blocks:
            self.build([leaves] if len(leaves) else [])
            return
        (first, low), (last, high) = self.find(start), self.find(end)
        if first == len(self.blocks):  # at the end of the text
            first, low = first - 1, len(self.blocks[-1])
        tail = self.blocks[last][high:] if last < len(self.blocks) else self.blocks[0][:0]
        new = np.concatenate([self.blocks[first][:low], leaves, tail])
        touched = range(first, min(last + 1, len(self.blocks)))
        for block in touched:
            self.blocks[block] = new if block == first else new[:0]
        if len(new) > 2 * BLOCK:
            flat = np.concatenate(self.blocks)
            self.build([flat[i : i + BLOCK] for i in range(0, len(flat), BLOCK)])
            return
        nodes = set()
        for block in touched:
            self.sums[self.size + block] = self.blocks[block].sum(axis=0, dtype=np.int64) if len(self.blocks[block]) else 0
            nodes.add((self.size + block) // 2)
        while nodes and max(nodes) >= 1:
            for node in nodes:
                self.sums[node] = self.sums[2 * node] + self.sums[2 * node + 1]
            nodes = {n // 2 for n in nodes if n > 1}

    def packed(self) -> tuple[bytes, bytes, bytes]:
        """Leaves, leaves in each block, and sums, as little-endian integers."""
        leaves = np.concatenate(self.blocks) if self.blocks else np.zeros((0, 2), "<i4")
        return (leaves.astype("<i4").tobytes(), np.array([len(b) for b in self.blocks], "<i4").tobytes(),
                self.sums.astype("<i8").tobytes())

    @classmethod
    def unpacked(cls, leaves: bytes, blocks: bytes, sums: bytes) -> PretokenTree:
        tree, flat = cls.__new__(cls), np.frombuffer(leaves, "<i4").reshape(-1, 2)
        ends = np.cumsum(np.frombuffer(blocks, "<i4"))
        tree.build(np.split(flat, ends[:-1]) if len(ends) else [], np.frombuffer(sums, "<i8").reshape(-1, 2).copy())
        return tree


def edited(text: str, edits: list[tuple[int, int, str]], tree: PretokenTree, counter: PretokenCounter) -> tuple[str, int]:
    """Apply edits (start, end, new text; places in the unedited text) to the text and its tree.

    Gives the new text and how many characters were encoded again. Edits whose stretches meet are done together.
    """
    groups: list[list] = []
    reached = 0
    for start, end, new in edits:
        if not reached <= start <= end <= len(text):
            raise ValueError("edits must be in order, apart and inside the text")
        reached = end
        low = start
        while True:  # the nearest boundary that ends before the edit
            low = text.rfind(" ", 0, max(0, low))
            if low < 0 or (low + 1 < start and BOUNDARY.match(text, low)):
                break
        high = end
        while True:  # the nearest boundary whose left neighbour is after the edit
            high = text.find(" ", high)
            if high < 0 or (high > end and BOUNDARY.match(text, high)):
                break
            high += 1
        low, high = max(low, 0), len(text) if high < 0 else high
        if groups and low < groups[-1][1]:
            groups[-1][1] = max(high, groups[-1][1])
            groups[-1][2].append((start, end, new))
        else:
            groups.append([low, high, [(start, end, new)]])
    out, at, shift, encoded = [], 0, 0, 0
    for low, high, inside in groups:
        stretch, place = [], low
        for start, end, new in inside:
            stretch += [text[place:start], new]
            place = end
        fresh = "".join([*stretch, text[place:high]])
        tree.replace(low + shift, high + shift, counter.leaves(fresh) if fresh else np.zeros((0, 2), "<i4"))
        out += [text[at:low], fresh]
        encoded += len(fresh)
        at, shift = high, shift + len(fresh) - (high - low)
    return "".join([*out, text[at:]]), encoded


@cache
def counter(path: str) -> PretokenCounter:
    return PretokenCounter(path)


TREE = "leaves binary, blocks binary, sums binary"


def _kind(df: DataFrame, name: str) -> str:
    return df.schema[name].dataType.simpleString()


def _trees(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """Batches whose last column is a text, with leaves, blocks and sums of its tree in the text's place."""
    work = counter(path)
    for batch in batches:
        for at in range(0, batch.num_rows, 200):
            part = batch.slice(at, 200)
            trees = [PretokenTree(x).packed() for x in work.leaves_of(part.column(part.num_columns - 1).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:-1], *[pa.array(c, pa.binary()) for c in zip(*trees, strict=True)]],
                names=[*part.schema.names[:-1], "leaves", "blocks", "sums"])


def build_trees(documents: DataFrame, path: str, carry: tuple[str, ...] = ("doc_id", "text"),
                text: str = "text") -> DataFrame:
    """The carried columns with leaves, blocks and sums of each text's tree; other columns are left out."""
    documents = documents.select(*carry)
    source = documents.select("*", F.coalesce(F.col(text), F.lit("")).alias("_text"))
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.schema.fields)
    return source.mapInArrow(lambda batches: _trees(batches, path), f"{columns}, {TREE}")


COUNTS = {"n_tokens_before": pa.int64(), "n_tokens_after": pa.int64(), "n_edits": pa.int64(), "encoded_chars": pa.int64()}


def _applied(batches: Iterator[pa.RecordBatch], path: str, keep_texts: bool, keep_trees: bool) -> Iterator[pa.RecordBatch]:
    """From batches of key, text, edits, leaves, blocks and sums: the key, new texts if kept, counts, new trees if kept."""
    work = counter(path)
    kinds = ({"text": pa.string()} if keep_texts else {}) | COUNTS | (
        dict.fromkeys(("leaves", "blocks", "sums"), pa.binary()) if keep_trees else {})
    for batch in batches:
        for at in range(0, batch.num_rows, 200):
            part = batch.slice(at, 200)
            rows = []
            for old, changes, *packed in zip(*(c.to_pylist() for c in part.columns[1:]), strict=True):
                tree, changes = PretokenTree.unpacked(*packed), [(e["start"], e["stop"], e["new"]) for e in changes or ()]
                before = tree.tokens
                new, encoded = edited(old, changes, tree, work) if changes else (old, 0)
                rows.append((*((new,) if keep_texts else ()), before, tree.tokens, len(changes), encoded,
                             *(tree.packed() if keep_trees else ())))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), *[pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds.values(), strict=True)]],
                names=["key", *kinds])


def apply_edits(trees: DataFrame, path: str, key: str = "doc_id", text: str = "text", edits: str = "edits",
                keep_trees: bool = True) -> DataFrame:
    """key, the new text, n_tokens before and after, n_edits, encoded_chars, and the new trees if they are kept.

    `edits` is an array of structs (start, stop, new).
    """
    source = trees.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"),
                          F.col(edits).alias("edits"), "leaves", "blocks", "sums")

    schema = (f"key {_kind(source, 'key')}, text string, n_tokens_before long, n_tokens_after long, n_edits long, "
              "encoded_chars long")
    return source.mapInArrow(lambda batches: _applied(batches, path, True, keep_trees),
                             schema + (f", {TREE}" if keep_trees else "")).withColumnRenamed("key", key)


EDITS = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("new", pa.string())]))
DIGITS = re.compile("[0-9]{3,}")


def _edits_of(old: str, label: str) -> list[dict]:
    out, at, seen = [{"start": 0, "stop": 0, "new": f"{label}: "}], 0, set()
    for line in old.split("\n"):
        if line in seen and line:
            out.append({"start": at - 1, "stop": at + len(line), "new": ""})
        else:
            out += [{"start": at + m.start(), "stop": at + m.end(), "new": "<number>"} for m in DIGITS.finditer(line)]
        seen.add(line)
        at += len(line) + 1
    return out


def _masked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From batches of key, text and label: the key, the text and its edits."""
    for batch in batches:
        for at in range(0, batch.num_rows, 200):
            part = batch.slice(at, 200)
            texts, labels = (c.to_pylist() for c in part.columns[1:])
            found = [_edits_of(t or "", s) for t, s in zip(texts, labels, strict=True)]
            yield pa.RecordBatch.from_arrays([*part.columns[:2], pa.array(found, EDITS)],
                                             names=[*part.schema.names[:2], "edits"])


def masking_edits(documents: DataFrame, key: str = "doc_id", text: str = "text", label: str = "source") -> DataFrame:
    """key, text and edits made from the texts: the label is put in front, runs of three or more digits are masked,
    and lines equal to an earlier one are taken out with their line break."""
    source = documents.select(key, text, F.coalesce(F.col(label), F.lit("unknown")).alias("_label"))
    return source.mapInArrow(
        _masked, f"`{key}` {_kind(source, key)}, `{text}` string, edits array<struct<start:long,stop:long,new:string>>")


def count_masked(documents: DataFrame, path: str, key: str = "doc_id", text: str = "text",
                 label: str = "source") -> DataFrame:
    """key and counts of the texts' `masking_edits`, put on their trees; without the new texts and trees.

    The steps follow each other in one Python process of a task, a few texts at a time: they share one memory of
    pieces, and no tree leaves the process.
    """
    source = documents.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"),
                              F.coalesce(F.col(label), F.lit("unknown")).alias("_label"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a tree is built from a text that stands last, beside the columns that go on
        last = (pa.RecordBatch.from_arrays([*b.columns, b.column(1)], names=[*b.schema.names, "_text"])
                for b in _masked(batches))
        yield from _applied(_trees(last, path), path, False, False)

    schema = f"key {_kind(source, 'key')}, n_tokens_before long, n_tokens_after long, n_edits long, encoded_chars long"
    return source.mapInArrow(run, schema).withColumnRenamed("key", key)
