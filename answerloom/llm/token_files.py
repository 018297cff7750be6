"""Token ids as Arrow files of equal-length sequences.

The ids of all documents, in ascending order of their keys, form one stream. It is written as Arrow IPC files, one
for each range of keys. A file holds record batches of two fixed-size lists, `ids` (16 or 32 bits, as the vocabulary
needs) and `mask` (true where the place holds an id; only the last sequence of a file is padded). Since every
sequence has the same length, sequence `i` of a file lies at a computed place of a computed batch, and a mapped file
gives it without a copy. An index file beside it says where each document starts.

Texts are encoded with the tokenizers library. A space between two characters that are not white space always starts
a new piece there, so texts are cut at such spaces, and a task encodes each distinct piece once while its bounded
memory holds. Letters and the punctuation behind them are encoded apart, as the library does. Texts in which such a space stands beside other white space go through the library as a whole.

Cases: a null text is an empty one and has the end id alone. Null keys come first; rows with equal keys stand side by
side in one file in no promised order; repeated rows are written each. An empty table gives no files and no rows.
Other columns are not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from answerloom.llm import piecewise, shared_files
from answerloom.session import new_folder, write_and_reload

SEQUENCE = 2048
#: Sequences in a record batch.
BATCH = 64
PIECE_TEXTS = 1000
#: Bytes of a generation of the memory of inner pieces, and of those of first and last ones; each has two.
INNER_BYTES, FIRST_BYTES, LAST_BYTES = 112 << 20, 16 << 20, 8 << 20


class SplitEncoder:
    """Ids of texts as the tokenizers library gives them, as little-endian integers of 16 or 32 bits.

    First, inner and last pieces of a text are remembered apart. The ids of a piece are None if it has white space at
    a side where a cut would have to be: its text is not cut then.
    """

    def __init__(self, path: str) -> None:
        self.library = piecewise.load(path)
        self.kind = np.dtype("<u2" if self.library.get_vocab_size() <= 1 << 16 else "<u4")
        self.opens = piecewise.opening(self.library)
        self.line_break = self._encode(["\n"])[0]
        self.first, self.inner, self.last = (piecewise.Memory(n) for n in (FIRST_BYTES, INNER_BYTES, LAST_BYTES))

    def _encode(self, pieces: list[str]) -> list[bytes]:
        found = self.library.encode_batch_fast(pieces, add_special_tokens=False)
        return [np.array(x.ids, self.kind).tobytes() for x in found]

    def _learn(self, memory: piecewise.Memory, pieces: set[str], lead: str, left: bool, right: bool) -> None:
        """Encode the pieces that are not known; left and right say at which sides texts are cut."""
        even, uneven, parted = [], [], []
        for piece in memory.unknown(pieces):
            if lead and (parts := piecewise.PARTED.fullmatch(piece)):
                if parts[2]:
                    parted.append((piece, parts[1], [parts[2]]))
                else:
                    even.append(piece)
            elif lead and "\n" in piece and all(lines := [*map(piecewise.PARTED.fullmatch, piece.split("\n"))]):
                bare = [part for line in lines[1:] for part in ("\n", *line.groups())]
                parted.append((piece, lines[0][1], [lines[0][2], *bare]))
            elif (left and piece[:1].isspace()) or (right and (piece[-1:].isspace() or (left and not piece))):
                memory[piece] = None
            elif lead and piece and not piece[-1].isspace():
                even.append(piece)
            else:
                uneven.append(piece)
        memory.update(zip(uneven, self._encode([lead + x for x in uneven]), strict=True))
        size = self.kind.itemsize
        even += memory.absent({letters for _, letters, _ in parted}.difference(even))
        for group, ids, cuts in piecewise.strung_ids(self.library, self.opens, even):
            data = ids.astype(self.kind).tobytes()
            memory.update(zip(group, [data[size * a : size * b] for a, b in pairwise(cuts)], strict=True))
        self._learn_bare({part for _, _, rest in parted for part in rest})
        bare = self.first.__getitem__
        memory.update([(piece, memory[letters] + b"".join(map(bare, rest))) for piece, letters, rest in parted])

    def _learn_bare(self, parts: set[str]) -> None:
        """Letters, and what else stands in no line break, without a space before, as first pieces are.

        A line break between two of them is a token of its own, so they are encoded line by line.
        """
        known = self.first
        known.update({"": b"", "\n": self.line_break})
        new, size = known.absent(parts), self.kind.itemsize
        groups = [new[i : i + piecewise.GROUP] for i in range(0, len(new), piecewise.GROUP)]
        mark = np.frombuffer(self.line_break, self.kind)
        for group, data in zip(groups, self._encode(["\n".join(g) for g in groups]), strict=True):
            cuts = np.flatnonzero(np.frombuffer(data, self.kind) == mark[0]).tolist()
            if len(mark) == 1 and len(cuts) == len(group) - 1:
                spans = zip([0, *[c + 1 for c in cuts]], [*cuts, len(data) // size], strict=True)
                known.update(zip(group, [data[size * a : size * b] for a, b in spans], strict=True))
            else:
                known.update(zip(group, self._encode(group), strict=True))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and how many each text has. There are no nulls.

        The pieces are cut and numbered by Arrow, so that each distinct one is looked up once.
        """
        cut = pc.split_pattern(texts, " ")
        bounds, pieces = cut.offsets.to_numpy().astype(np.int64), cut.flatten().dictionary_encode()
        number, spelled = pieces.indices.to_numpy().astype(np.int64), pieces.dictionary.to_numpy(zero_copy_only=False)
        begin, end = bounds[:-1], bounds[1:] - 1
        inner = np.ones(len(number), bool)
        inner[begin], inner[end] = False, False
        needed = np.bincount(number[inner], minlength=len(spelled)) > 0
        firsts, lasts = (spelled[number[at]].tolist() for at in (begin, end))
        between = spelled[needed].tolist()
        self._learn(self.first, set(firsts), "", False, True)
        self._learn(self.last, set(lasts), " ", True, False)
        self._learn(self.inner, set(between), " ", True, True)
        found = [*map(self.inner.__getitem__, between), *map(self.first.__getitem__, firsts), *map(self.last.__getitem__, lasts)]
        place = (np.cumsum(needed) - 1)[number]
        place[begin] = len(between) + np.arange(len(texts))
        place[end] = len(between) + len(texts) + np.arange(len(texts))
        sizes = np.array([-1 if ids is None else len(ids) for ids in found], np.int64)
        whole = np.flatnonzero((np.minimum.reduceat(sizes[place], begin) < 0) | (begin == end)) if len(texts) else begin
        if len(whole):
            place[np.isin(np.repeat(np.arange(len(texts)), np.diff(bounds)), whole)] = len(found)
            place[begin[whole]] = len(found) + 1 + np.arange(len(whole))
            found += [b"", *self._encode(texts.take(pa.array(whole)).to_pylist())]
            sizes = np.append(np.maximum(sizes, 0), list(map(len, found[len(sizes) :])))
        sizes //= self.kind.itemsize
        starts, counts = np.cumsum(sizes) - sizes, sizes[place]
        ends = np.cumsum(counts)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts[place] - (ends - counts), counts)
        return np.frombuffer(b"".join(filter(None, found)), self.kind)[at], np.add.reduceat(counts, begin) if len(texts) else counts


@cache
def encoder(path: str) -> SplitEncoder:
    return SplitEncoder(path)


def sequence_schema(kind: np.dtype, length: int) -> pa.Schema:
    return pa.schema([("ids", pa.list_(pa.from_numpy_dtype(kind), length)), ("mask", pa.list_(pa.bool_(), length))])


INDEX = pa.schema([("key", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


class SequenceWriter:
    """Cuts a stream of ids into sequences and writes them by full batches; at most one batch is held."""

    def __init__(self, out, kind: np.dtype, length: int) -> None:
        self.kind, self.length = kind, length
        self.schema = sequence_schema(kind, length)
        self.file = pa.ipc.new_file(out, self.schema)
        self.held: list[np.ndarray] = []
        self.count = self.total = 0

    def add(self, ids: np.ndarray) -> None:
        self.held.append(ids)
        self.count += len(ids)
        self.total += len(ids)
        full = self.length * BATCH
        if self.count >= full:
            flat = np.concatenate(self.held)
            for start in range(0, self.count - full + 1, full):
                self._write(flat[start : start + full], full)
            rest = flat[self.count - self.count % full :]
            self.held, self.count = [rest], len(rest)

    def _write(self, flat: np.ndarray, size: int) -> None:
        real = len(flat)
        if real < size:
            flat = np.concatenate([flat, np.zeros(size - real, self.kind)])
        mask = np.arange(size) < real
        self.file.write(pa.record_batch([
            pa.FixedSizeListArray.from_arrays(pa.array(flat), self.length),
            pa.FixedSizeListArray.from_arrays(pa.array(mask), self.length)], schema=self.schema))

    def close(self) -> None:
        if self.count:
            self._write(np.concatenate(self.held), -(-self.count // self.length) * self.length)
        self.file.close()


class SequenceFile:
    """A mapped file of sequences; `sequence(i)` and `mask(i)` are views into it."""

    def __init__(self, path: str) -> None:
        self.source = shared_files.opened(path)
        self.file = pa.ipc.open_file(self.source)
        self.length = self.file.schema.field("ids").type.list_size
        self.batches = self.file.num_record_batches

    def __len__(self) -> int:
        last = self.file.get_batch(self.batches - 1).num_rows if self.batches else 0
        return max(0, self.batches - 1) * BATCH + last

    def flat(self, batch: int) -> np.ndarray:
        return self.file.get_batch(batch).column("ids").values.to_numpy()

    def sequence(self, i: int) -> np.ndarray:
        return self.flat(i // BATCH)[i % BATCH * self.length :][: self.length]

    def mask(self, i: int) -> np.ndarray:
        column = self.file.get_batch(i // BATCH).column("mask")
        return column.values.slice(i % BATCH * self.length, self.length).to_numpy(zero_copy_only=False)

    def span(self, start: int, count: int) -> np.ndarray:
        """Ids from a place of the file's stream on; a view where they lie in one batch."""
        full, parts = self.length * BATCH, []
        while count:
            part = self.flat(start // full)[start % full :][:count]
            parts.append(part)
            start, count = start + len(part), count - len(part)
        return parts[0] if len(parts) == 1 else np.concatenate(parts) if parts else np.zeros(0, np.uint16)

    def close(self) -> None:
        self.source.close()


def write_files(documents: DataFrame, path: str, folder: str, end_id: int | None, key: str = "doc_id",
                text: str = "text", length: int = SEQUENCE) -> DataFrame:
    """part, path and n_ids of each file written; parts ascend with the keys."""
    shared_files.make_folder(folder)
    ordered = documents.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    ordered = ordered.repartitionByRange("key").sortWithinPartitions("key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        batch = next(batches, None)
        if batch is None:
            return
        work = encoder(path)
        name = f"{folder}/ids-{part:06d}.arrow"
        with shared_files.created(name) as out, shared_files.created(f"{name}.index") as index_out:
            ids, index = SequenceWriter(out, work.kind, length), pa.ipc.new_file(index_out, INDEX)
            while batch is not None:
                for at in range(0, batch.num_rows, PIECE_TEXTS):
                    rows = batch.slice(at, PIECE_TEXTS)
                    found, counts = work.encode(rows.column(1))
                    if end_id is not None:
                        found, counts = np.insert(found, np.cumsum(counts), end_id), counts + 1
                    starts = ids.total + np.cumsum(counts) - counts
                    index.write(pa.record_batch([rows.column(0), pa.array(starts), pa.array(counts)], schema=INDEX))
                    ids.add(found)
                batch = next(batches, None)
            ids.close()
            index.close()
        yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "path": [name], "n_ids": [ids.total]})

    return ordered.mapInArrow(run, "part int, path string, n_ids long")


def with_bases(files: DataFrame) -> DataFrame:
    """Ids in all files before each; there is one row per file, so one task sees few of them."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read_documents(files: DataFrame) -> DataFrame:
    """key, start, n_tokens and the checksum of the ids of each document, from the files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                sequences = SequenceFile(path)
                with shared_files.opened(f"{path}.index") as source:
                    index = pa.ipc.open_file(source)
                    for i in range(index.num_record_batches):
                        keys, starts, counts = index.get_batch(i).columns
                        sums = [zlib.crc32(sequences.span(s, n).astype("<u4")) for s, n in
                                zip(starts.to_pylist(), counts.to_pylist(), strict=True)]
                        yield pa.RecordBatch.from_pydict({
                            "key": keys, "start": pa.array(starts.to_numpy() + base), "n_tokens": counts,
                            "ids_crc32": pa.array(sums, pa.int64())})
                sequences.close()

    return files.select("path", "base").mapInArrow(run, "key long, start long, n_tokens long, ids_crc32 long")


def write_and_read(documents: DataFrame, path: str, end_id: int | None, key: str = "doc_id",
                   text: str = "text") -> DataFrame:
    spark = documents.sparkSession
    written = write_files(documents, path, new_folder(spark, "token-files"), end_id, key, text)
    files = write_and_reload(with_bases(write_and_reload(written, "token-paths")), "token-bases")
    spread = files.repartition(spark.sparkContext.defaultParallelism * 4, "path")
    return read_documents(spread).withColumnRenamed("key", key)
