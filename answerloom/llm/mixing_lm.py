"""Language-model scoring by online logistic mixing of hashed-context bit predictors.

Each byte of a text, and an end mark after the last, is a path through a Huffman tree of bytes, so a text is a sequence
of binary decisions, and the product of their probabilities is a proper probability of the text.

* Predictors: for each order the last bytes are the context, kept whole in a 64-bit key, so contexts never collide. The
  counts of the corpus are a table of contexts and next bytes; from them come the log-odds of the decisions at the
  inner nodes of the tree. The table grows with the corpus. It is written once, as files of sorted ranges in the shared
  folder: every pair of context and next byte with the log-odds along the byte's path. Tasks map the files and search
  them by the sorted pairs of each piece of text, so neither texts nor contexts are shuffled to meet the counts.
* Mixing: the log-odds are added with weights chosen by a gate (how sure the two highest orders are) and squashed.
  The weights move online after every decision, along the slope of the coding cost.
* Refinement: an adaptive map from the mixed log-odds to the share of ones seen there, averaged with the mix.

Long texts are cut into lanes of `LANE` decisions which start from the trained weights; contexts reach back over the
cuts. All lanes of a piece take each step together. Counts come from all training texts but those of one fold, on
which the weights and the map are trained, since counts from a text itself would make the high orders look too good.

Beside it stands a base score of words with add-one smoothing. Words are known by 64-bit hashes. Those that make up
at least one of `FREQUENT` training tokens, which are that many at most, are looked up in the task; all others are
joined.

Cases: a null text is an empty one and consists of the end mark alone. Rows without an id are training rows if the
CRC of the empty text says so. Repeated rows are learned from and scored each. Without training texts all counts are
zero and every predictor says one half. An empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field, replace
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from answerloom.llm import shared_files
from answerloom.llm import texts as T
from answerloom.session import new_folder, write_and_reload

#: Bytes of context of each predictor. A key is the order's number, six bytes of context and the next byte.
ORDERS = (2, 3, 4, 6)
#: Distinct counts that a counting task holds before they leave it, and rows that leave it at a time.
SLOTS = 1 << 20
BLOCK_SLOTS = 1 << 16
#: Pairs in a batch of a file of counts, and more by what one context and one batch of rows have.
BATCH_PAIRS = 1 << 18
END = 0xFF  # never a byte of UTF-8
END_TOKEN = np.uint64(0x1F83D9ABFB41BD6B)
FOLDS, HELD_OUT, MIX_FOLD = 7, 2, 6
FREQUENT = 1 << 20

LANE = 1024
PIECE = 1 << 20
#: Bytes of a piece whose lanes take their steps together.
PART = 1 << 18
#: Decisions looked up at a time.
CHUNK = 1 << 14
SCALE = 16  # steps of a unit of log-odds in the tables
RATE, MAP_RATE = 0.006, 0.02
GATES, CELLS = 9, 33
START_WEIGHT = 0.3
#: How sure a predictor is, by its log-odds read as an unsigned byte: 0 knows nothing, 1 leans, 2 is sure.
SURE = np.digitize(np.abs(np.arange(256, dtype=np.uint8).view(np.int8).astype(int)), [1, 2 * SCALE]).astype(np.int8)

def symbols(piece: T.Piece) -> tuple[np.ndarray, np.ndarray]:
    """Bytes with an end mark after each row, and where each row starts among them."""
    return np.insert(piece.data, piece.offsets[1:], END), piece.offsets + np.arange(piece.rows + 1)


def context_keys(stream: np.ndarray, bounds: np.ndarray) -> Iterator[np.ndarray]:
    """For each order the key of every byte and its context; bytes before a row's start count as zero."""
    place = np.arange(len(stream)) - np.repeat(bounds[:-1], np.diff(bounds))
    context, wide = np.zeros(len(stream), np.uint64), stream.astype(np.uint64)
    for back in range(1, max(ORDERS) + 1):
        context[back:] |= np.where(place[back:] >= back, wide[:-back], 0) << np.uint64(8 * (back - 1))
        if back in ORDERS:
            yield np.uint64(ORDERS.index(back) << 56) | (context << np.uint64(8)) | wide


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in rising order, and the number of each key among them."""
    encoded = pa.array(keys).dictionary_encode()
    found = encoded.dictionary.to_numpy()
    order = np.argsort(found)
    rank = np.empty(len(found), np.int64)
    rank[order] = np.arange(len(found))
    return found[order], rank.take(encoded.indices.to_numpy())


def counted_keys(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and how often each stands, in no order."""
    found = pa.array(keys).value_counts()
    return found.field("values").to_numpy(), found.field("counts").to_numpy()


def words(piece: T.Piece) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, first_word = piece.words()
    return T.span_hash(piece.prefix(T.LOWER_ASCII[piece.data]), starts, ends), first_word


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in rising order and their counts. The parts are used up: each array goes once it is copied."""
    keys, counts = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
    parts.clear()
    order = np.argsort(keys)
    keys = keys.take(order)
    counts = counts.take(order)
    del order
    begins = np.flatnonzero(np.append(len(keys) > 0, keys[1:] != keys[:-1]))
    return keys.take(begins), np.add.reduceat(counts, begins) if len(begins) else counts


PARTIAL = pa.schema([("kind", pa.int32()), ("key", pa.int64()), ("n", pa.int64())])
CONTEXTS, WORDS, BYTES, NEEDS = range(4)


def _partial(kind: int, keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    return T.batch_of([np.full(len(keys), kind, np.int32), keys, counts], PARTIAL)


def _counts(kind: int, keys: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    for start in range(0, len(keys), BLOCK_SLOTS):
        some = slice(start, start + BLOCK_SLOTS)
        yield _partial(kind, keys[some].view(np.int64), counts[some])


class _Held:
    """Counts of a task by key, given out when they are too many to hold: one sorted table, into which parts are put."""

    def __init__(self, kind: int, limit: int) -> None:
        self.kind, self.limit, self.parts, self.waiting = kind, limit, [], 0
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def add(self, keys: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.parts.append((keys, counts))
        self.waiting += len(keys)
        if self.waiting > self.limit // 4:
            self._take_in()
            if len(self.keys) > self.limit:
                yield from self.rest()

    def _take_in(self) -> None:
        keys, counts = _merged(self.parts)
        self.waiting = 0
        if not len(self.keys):
            self.keys, self.counts = keys, counts
            return
        place = np.searchsorted(self.keys, keys)
        new = self.keys.take(place, mode="clip") != keys
        self.counts[place[~new]] += counts[~new]
        self.keys = np.insert(self.keys, place[new], keys[new])
        self.counts = np.insert(self.counts, place[new], counts[new])

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.parts:
            self._take_in()
        yield from _counts(self.kind, self.keys, self.counts)
        self.keys, self.counts = self.keys[:0].copy(), self.counts[:0].copy()


def count_corpus(documents: DataFrame, needs: bool = True) -> DataFrame:
    """Partial counts of each task: contexts with the next byte, words, bytes; with `needs` also the contexts of all texts.

    `documents` has key, held_out, rest and text. Only training texts are counted.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        contexts, tokens, seen = _Held(CONTEXTS, 2 * SLOTS), _Held(WORDS, 2 * SLOTS), np.zeros(256, np.int64)
        for batch in batches:
            held_out, rest = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            for piece in T.pieces(batch.column(2), PART):
                own = slice(piece.first, piece.first + piece.rows)
                train = ~held_out[own].astype(bool)
                hashes, first_word = words(piece)
                hashes = hashes[np.repeat(train, np.diff(first_word))]
                yield from tokens.add(*np.unique(np.append(hashes, np.full(train.sum(), END_TOKEN)), return_counts=True))
                stream, bounds = symbols(piece)
                counted = np.repeat(train & (rest[own] != MIX_FOLD), np.diff(bounds))
                seen += np.bincount(stream[counted], minlength=256)
                for keys in context_keys(stream, bounds):
                    yield from contexts.add(*counted_keys(keys[counted]))
                    if needs:
                        found = np.unique(keys >> np.uint64(8))
                        yield from _counts(NEEDS, found, np.ones(len(found), np.int64))
        yield from contexts.rest()
        yield from tokens.rest()
        if seen.any():
            yield _partial(BYTES, np.arange(256), seen)
        pa.default_memory_pool().release_unused()  # the process stays for later tasks

    return documents.select("held_out", "rest", "text").mapInArrow(run, "kind int, key long, n long")


def context_counts(partial: DataFrame) -> DataFrame:
    """context and its next bytes, each as the count times 256 plus the byte."""
    counts = partial.where(F.col("kind") == CONTEXTS).select(
        F.shiftright("key", 8).alias("context"), F.col("key").bitwiseAND(255).alias("byte"), "n")
    return (
        counts.groupBy("context", "byte").agg(F.sum("n").alias("n"))
        .groupBy("context").agg(F.collect_list(F.col("n") * 256 + F.col("byte")).alias("nexts")))


@dataclass(frozen=True)
class Code:
    """A Huffman code of the bytes: their paths one after the other."""

    first: np.ndarray
    length: np.ndarray
    node: np.ndarray
    bit: np.ndarray
    #: Places of the bytes among the leaves from left to right, and how many nodes two paths share, by these places.
    rank: np.ndarray
    shared: np.ndarray

    @classmethod
    def of(cls, counts: np.ndarray) -> Code:
        heap = [(int(c) + 1, s, s) for s, c in enumerate(counts)]
        heapq.heapify(heap)
        parent = {}
        for inner in range(255):
            (a, _, left), (b, _, right) = heapq.heappop(heap), heapq.heappop(heap)
            parent[left], parent[right] = (inner, 0), (inner, 1)
            heapq.heappush(heap, (a + b, 256 + inner, 256 + inner))
        paths = []
        for symbol in range(256):
            path, at = [], symbol
            while at in parent:
                inner, bit = parent[at]
                path.append((inner, bit))
                at = 256 + inner
            paths.append(path[::-1])
        length = np.array([len(p) for p in paths])
        flat = np.array([x for p in paths for x in p])
        leaves = sorted(range(256), key=lambda symbol: [bit for _, bit in paths[symbol]])
        # neighbouring leaves tell all: two paths share what the paths of all leaves between them do
        shared = np.zeros((256, 256), np.int64)
        for place, symbol in enumerate(leaves):
            shared[place, place] = least = length[symbol]
            for other in range(place + 1, 256):
                pairs = zip(paths[leaves[other - 1]], paths[leaves[other]], strict=False)
                least = min(least, 1 + next(i for i, (a, b) in enumerate(pairs) if a != b))
                shared[place, other] = shared[other, place] = least
        return cls(np.cumsum(length) - length, length, flat[:, 0], flat[:, 1].astype(np.uint8),
                   np.argsort(leaves), shared)

    def paths(self, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The paths of bytes one after the other: number of the byte, node and bit of each decision."""
        lengths = self.length[symbol]
        last = np.cumsum(lengths)
        which = np.repeat(np.arange(len(symbol)), lengths)
        at = np.arange(len(which)) + np.repeat(self.first[symbol] - (last - lengths), lengths)
        return which, self.node[at], self.bit[at]


PATHS = pa.schema([("pair", pa.int64()), ("odds", pa.large_list(pa.int8()))])


def path_table(pairs: np.ndarray, n: np.ndarray, code: Code) -> pa.RecordBatch:
    """Rising pairs (context and leaf) and the log-odds along the leaf's path, from whole contexts, their next bytes and counts."""
    symbol = pairs & 255
    pairs = pairs - symbol + code.rank[symbol]
    order = np.argsort(pairs)
    pairs, symbol, n = pairs[order], symbol[order], n[order]
    which, node, bit = code.paths(symbol)
    keys = (pairs[which] >> 8 << 8) | node
    order = np.argsort(keys)
    first = np.append(True, np.diff(keys[order]) != 0)
    group = np.empty(len(keys), np.int64)
    group[order] = np.cumsum(first) - 1
    total, one = (np.bincount(group, n[which] * x) for x in (1.0, bit))
    odds = np.clip(np.rint(SCALE * np.log((one + 0.4) / (total - one + 0.4))), -127, 127).astype(np.int8)
    ends = np.concatenate([[0], np.cumsum(code.length[symbol])])
    return pa.RecordBatch.from_arrays(
        [pa.array(pairs), pa.LargeListArray.from_arrays(pa.array(ends), pa.array(odds[group]))], schema=PATHS)


def write_paths(counts: DataFrame, code: Code, folder: str) -> list[str]:
    """Files of sorted ranges of pairs (key, n), in rising order; a context stands in one batch."""
    shared_files.make_folder(folder)
    ordered = counts.select("key", "n").repartitionByRange(F.shiftright("key", 8)).sortWithinPartitions("key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = TaskContext.get().partitionId(), (np.zeros(0, np.int64),) * 2
        batch = next(batches, None)
        if batch is None:
            return
        name = f"{folder}/paths-{part:06d}.arrow"
        with shared_files.created(name) as out, pa.ipc.new_file(out, PATHS) as file:
            while batch is not None:
                held = tuple(np.concatenate([a, b.to_numpy()]) for a, b in zip(held, batch.columns, strict=True))
                batch = next(batches, None)
                whole = len(held[0])
                if whole and batch is not None:
                    whole = int(np.searchsorted(held[0], held[0][-1] >> 8 << 8))
                if whole and (batch is None or whole >= BATCH_PAIRS):
                    file.write(path_table(held[0][:whole], held[1][:whole], code))
                    held = tuple(x[whole:] for x in held)
        yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "path": [name]})

    return [r.path for r in ordered.mapInArrow(run, "part int, path string").orderBy("part").collect()]


@lru_cache(maxsize=1)
def mapped(paths: tuple[str, ...]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs, where their log-odds begin, and the log-odds, of each batch of the files; views where files can be mapped."""
    files = [pa.ipc.open_file(shared_files.opened(path)) for path in paths]
    batches = [file.get_batch(i) for file in files for i in range(file.num_record_batches)]
    return [(b.column(0).to_numpy(), b.column(1).offsets.to_numpy(), b.column(1).values.to_numpy()) for b in batches]


@dataclass(frozen=True)
class MixModel:
    code: Code = field(repr=False)
    table: np.ndarray = field(repr=False)
    weights: np.ndarray = field(repr=False)
    refine: np.ndarray = field(repr=False)
    #: Files of the counts as `write_paths` gives them; what stands in none is unknown.
    files: tuple[str, ...] = ()

    def odds(self, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For rising keys of contexts and bytes the log-odds along the bytes' paths, and where each path starts.

        A byte not seen in its context shares the known nodes of its path with one of the two seen leaves beside it.
        """
        symbol = (pairs & np.uint64(255)).astype(np.int64)
        lengths = self.code.length[symbol]
        starts = np.cumsum(lengths) - lengths
        out = np.zeros(int(lengths.sum()), np.int8)
        leaf = self.code.rank[symbol]
        wanted = (pairs >> np.uint64(8) << np.uint64(8)).view(np.int64) | leaf
        for keys, begins, values in mapped(self.files):
            ends = np.array([keys[0] >> 8 << 8, keys[-1] | 255]).view(np.uint64)
            low, high = np.searchsorted(pairs, ends[0]), np.searchsorted(pairs, ends[1], side="right")
            if low == high:
                continue
            own, own_leaf = wanted[low:high], leaf[low:high]
            after = np.searchsorted(keys, own)
            best, source = np.zeros(len(own), np.int64), after
            for place in (np.minimum(after, len(keys) - 1), np.maximum(after - 1, 0)):
                near = keys.take(place)
                shared = np.where(near >> 8 == own >> 8, self.code.shared[own_leaf, near & 255], 0)
                source = np.where(shared > best, place, source)
                best = np.maximum(best, shared)
            ends = np.cumsum(best)
            step = np.arange(int(ends[-1])) - np.repeat(ends - best, best)
            out[np.repeat(starts[low:high], best) + step] = values.take(
                np.repeat(begins.take(source, mode="clip"), best) + step)
        return out, starts


def start_state() -> tuple[np.ndarray, np.ndarray]:
    cells = (np.arange(CELLS) - CELLS // 2) / 2
    return (np.full((GATES, len(ORDERS)), START_WEIGHT, np.float32), (1 / (1 + np.exp(-cells))).astype(np.float32))


def _decisions(piece: T.Piece, model: MixModel):
    """Inputs (step, predictor, lane), gates, bits and validity (step, lane), and the row of each lane."""
    stream, bounds = symbols(piece)
    code, orders = model.code, len(ORDERS)
    lengths = code.length[stream]
    last = np.cumsum(lengths)
    total = int(last[-1])
    byte = np.repeat(np.arange(len(stream)), lengths)
    odds, rows = [], []
    for keys in context_keys(stream, bounds):
        pairs, number = distinct(keys)
        values, start = model.odds(pairs)
        odds.append(values)
        rows.append(start[number] - (last - lengths))
    path_first = code.first[stream] - (last - lengths)
    found, own_bits = np.empty((orders, total), np.int8), np.empty(total, np.uint8)
    for low in range(0, total, CHUNK):  # temporaries stay in the cache
        part = byte[low : low + CHUNK]
        path = path_first.take(part)
        path += np.arange(low, low + len(part))
        own_bits[low : low + CHUNK] = code.bit.take(path)
        for k in range(orders):
            at = rows[k].take(part)
            at += np.arange(low, low + len(part))
            found[k, low : low + CHUNK] = odds[k].take(at)
    del byte, odds, rows, path_first, values, number, keys, pairs
    row_start = np.concatenate([[0], last])[bounds]
    counts = np.diff(row_start)
    lanes = -(-counts // LANE)
    lane_start = np.concatenate([[0], np.cumsum(lanes)])
    width = int(lane_start[-1])
    inputs, bits = np.zeros((orders, width * LANE), np.int8), np.zeros(width * LANE, np.uint8)
    for i in range(piece.rows):
        to = slice(lane_start[i] * LANE, lane_start[i] * LANE + counts[i])
        inputs[:, to] = found[:, row_start[i] : row_start[i + 1]]
        bits[to] = own_bits[row_start[i] : row_start[i + 1]]
    del found, own_bits
    row = np.repeat(np.arange(piece.rows), lanes)
    size = np.minimum(LANE, counts[row] - (np.arange(width) - lane_start[row]) * LANE)
    gates = SURE.take(inputs[-1].view(np.uint8)) * np.int8(3) + SURE.take(inputs[-2].view(np.uint8))
    return (np.ascontiguousarray(inputs.reshape(orders, width, LANE).transpose(2, 0, 1)),
            np.ascontiguousarray(gates.reshape(width, LANE).T), np.ascontiguousarray(bits.reshape(width, LANE).T),
            np.arange(LANE)[:, None] < size, row)


def mix(piece: T.Piece, model: MixModel, usage: bool = False) -> tuple[np.ndarray, ...]:
    """log10 probability of each row; the weights (lane, gate, predictor) and maps at the ends of the lanes, and how
    often each gate was used, if that is asked for.

    Lanes know nothing of each other, so the rows go through in parts: what is held follows a part, not the piece.
    All parts take as many steps as the longest lane of the piece, since maps also move in the steps after a lane's end.
    """
    decisions = T.row_sums(model.code.length.astype(np.uint8)[piece.data], piece.offsets).max() + model.code.length[END]
    found, first = [], 0
    while first < piece.rows:
        last = int(np.searchsorted(piece.offsets, piece.offsets[first] + PART, side="right")) - 1
        last = min(piece.rows, max(first + 1, last))
        low, high = piece.offsets[first], piece.offsets[last]
        found.append(_mix(T.Piece(piece.data[low:high], piece.offsets[first : last + 1] - low, first), model,
                          min(LANE, int(decisions)), usage))
        first = last
    return tuple(map(np.concatenate, zip(*found, strict=True))) if len(found) > 1 else found[0]


def _mix(piece: T.Piece, model: MixModel, steps: int, usage: bool) -> tuple[np.ndarray, ...]:
    inputs, gates, bits, valid, row = _decisions(piece, model)
    width, orders = len(row), len(ORDERS)
    weights = np.repeat(model.weights.T.reshape(-1), width).astype(np.float32)  # predictor, gate, lane
    refine = np.tile(model.refine, width)
    lane, cell_base = np.arange(width), np.arange(width) * CELLS + CELLS // 2
    chance = np.empty((LANE, width), np.float32)
    scale, rate, map_rate = np.float32(1 / SCALE), np.float32(RATE), np.float32(MAP_RATE)
    predictor = np.arange(orders)[:, None] * (GATES * width)
    x, w, change = (np.empty((orders, width), np.float32) for _ in range(3))
    at, gate = np.empty((orders, width), np.int64), np.empty(width, np.int64)
    for step in range(steps):
        np.multiply(inputs[step], scale, out=x)
        np.multiply(gates[step], width, out=gate, dtype=np.int64)
        gate += lane
        np.add(predictor, gate, out=at)
        weights.take(at, out=w, mode="clip")
        np.multiply(w, x, out=change)
        mixed = change.sum(axis=0)
        p = 1 / (1 + np.exp(-mixed))
        bit = bits[step].astype(np.float32)
        np.multiply(x, (bit - p) * rate, out=change)
        w += change
        weights[at] = w
        cell = np.rint(np.clip(mixed, -8, 8) * 2).astype(np.int64)
        cell += cell_base
        seen = refine.take(cell)
        refine[cell] = seen + (bit - seen) * map_rate
        np.add(p, seen, out=chance[step])
    chance *= np.float32(0.5)
    np.subtract(1, chance, out=chance, where=bits == 0)
    np.clip(chance, 1e-5, 1, out=chance)
    chance[~valid] = 1
    logs = np.log10(chance).sum(axis=0, dtype=np.float64)
    used = np.stack([((gates == g) & valid).sum(axis=0) for g in range(GATES)], axis=1) if usage else np.zeros(0)
    return (np.bincount(row, logs, piece.rows), weights.reshape(orders, GATES, width).transpose(2, 1, 0),
            refine.reshape(width, CELLS), used)


def fit_mixer(fold: DataFrame, model: MixModel) -> MixModel:
    """Weights and map averaged over the lanes of all texts (text) of the fold; each task carries its own on, piece by piece."""
    held = fold.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, sums, uses, maps, lanes = held.value, None, None, 0.0, 0
        for batch in batches:
            for piece in T.pieces(batch.column(0), PIECE):
                _, weights, refine, used = mix(piece, own, usage=True)
                total = used.sum(axis=0)
                mean = np.where(total[:, None] > 0, (weights * used[:, :, None]).sum(axis=0) / np.maximum(total, 1)[:, None],
                                own.weights)
                own = replace(own, weights=mean.astype(np.float32), refine=refine.mean(axis=0).astype(np.float32))
                sums = total[:, None] * mean if sums is None else sums + total[:, None] * mean
                uses = total if uses is None else uses + total
                maps, lanes = maps + refine.sum(axis=0), lanes + len(refine)
        if lanes:
            yield pa.RecordBatch.from_pydict({
                "sums": pa.array([sums.ravel().tolist()]), "uses": pa.array([uses.tolist()], pa.list_(pa.int64())),
                "maps": pa.array([maps.tolist()]), "lanes": pa.array([lanes], pa.int64())})

    got = fold.select("text").mapInArrow(run, "sums array<double>, uses array<long>, maps array<double>, lanes long")
    # summed place by place: a fixed number of rows, whatever the number of tasks
    places = got.select(
        F.explode(F.map_from_arrays(F.array(F.lit("sums"), F.lit("uses"), F.lit("maps"), F.lit("lanes")), F.array(
            F.col("sums"), F.col("uses").cast("array<double>"), F.col("maps"),
            F.array(F.col("lanes").cast("double"))))).alias("kind", "values")).select(
        "kind", F.posexplode("values").alias("place", "value"))
    total = {(r.kind, r.place): r.value for r in places.groupBy("kind", "place").agg(F.sum("value").alias("value")).collect()}
    if not total:
        return model
    read = lambda kind, size: np.array([total[kind, i] for i in range(size)])
    uses = read("uses", GATES)
    sums = read("sums", GATES * len(ORDERS)).reshape(GATES, -1)
    weights = np.where(uses[:, None] > 0, sums / np.maximum(uses, 1)[:, None], model.weights)
    return replace(model, weights=weights.astype(np.float32),
                   refine=(read("maps", CELLS) / total["lanes", 0]).astype(np.float32))


def score_texts(documents: DataFrame, model: MixModel, known: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """row (a number of its own), key, held_out, n_tokens, score, what known words say, and the other words."""
    context = documents.sparkSession.sparkContext
    held = context.broadcast((model, known))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, (keys, counts) = held.value
        logs, number = np.log10(counts + 1.0), TaskContext.get().partitionId() << 33
        for batch in batches:
            for piece in T.pieces(batch.column(2), PIECE):
                score = mix(piece, own)[0]
                hashes, first_word = words(piece)
                # distinct words of each row with their number; the end token is a word of every row
                rows = np.append(np.repeat(np.arange(piece.rows), np.diff(first_word)), np.arange(piece.rows))
                hashes = np.append(hashes, np.full(piece.rows, END_TOKEN))
                order = np.lexsort((hashes, rows))
                rows, hashes = rows[order], hashes[order]
                begins = np.flatnonzero(np.append(True, (np.diff(rows) != 0) | (hashes[1:] != hashes[:-1])))
                times = np.diff(np.append(begins, len(rows)))
                rows, hashes = rows[begins], hashes[begins]
                at = np.minimum(np.searchsorted(keys, hashes), max(0, len(keys) - 1))
                found = keys[at] == hashes if len(keys) else np.zeros(len(hashes), bool)
                gain = np.bincount(rows[found], times[found] * logs[at[found]], piece.rows)
                seen = np.bincount(rows[found], times[found], piece.rows).astype(np.int64)
                rare = ~found
                ends = np.searchsorted(rows[rare], np.arange(piece.rows + 1)).astype(np.int32)
                part = batch.slice(piece.first, piece.rows)
                yield pa.RecordBatch.from_arrays([
                    pa.array(number + np.arange(piece.rows)), part.column(0), part.column(1),
                    pa.array(np.diff(first_word) + 1), pa.array(score), pa.array(gain), pa.array(seen),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(hashes[rare].view(np.int64))),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(times[rare].astype(np.int32)))],
                    names=["row", "key", "held_out", "n_tokens", "score", "gain", "seen", "rare", "times"])
                number += piece.rows

    return documents.select("key", "held_out", "text").mapInArrow(
        run, "row long, key long, held_out boolean, n_tokens long, score double, gain double, seen long, "
             "rare array<long>, times array<int>")


def score_documents(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, held_out, n_tokens, n_known, train_tokens, base_score and score of every document."""
    spark = documents.sparkSession
    rest = T.training_rest(key, FOLDS)
    plain = documents.select(F.col(key).cast("long").alias("key"), (rest == HELD_OUT).alias("held_out"),
                             rest.cast("int").alias("rest"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    summed = write_and_reload(
        count_corpus(plain, needs=False).groupBy("kind", "key").agg(F.sum("n").alias("n")), "corpus-counts")
    counts = np.zeros(256, np.int64)
    for r in summed.where(F.col("kind") == BYTES).collect():
        counts[r.key] = r.n
    code = Code.of(counts)
    files = write_paths(summed.where(F.col("kind") == CONTEXTS), code, new_folder(spark, "context-paths"))
    model = MixModel(code, np.zeros(0, np.int8), *start_state(), tuple(files))
    model = fit_mixer(plain.where(F.col("rest") == MIX_FOLD), model)

    vocabulary = summed.where(F.col("kind") == WORDS).select("key", "n")
    tokens, distinct = vocabulary.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    frequent = F.col("n") * FREQUENT >= tokens  # FREQUENT words at most
    top = vocabulary.where(frequent).toArrow()
    keys, n = top["key"].to_numpy().view(np.uint64), top["n"].to_numpy()
    order = np.argsort(keys)
    scored = write_and_reload(score_texts(plain, model, (keys[order], n[order])), "scored-texts")

    pairs = scored.select("row", F.explode(F.arrays_zip("rare", "times")).alias("w")).select(
        "row", F.col("w.rare").alias("key"), F.col("w.times").alias("times"))
    joined = pairs.join(vocabulary.where(~frequent), "key").groupBy("row").agg(
        F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("more"), F.sum("times").cast("long").alias("also"))
    total = F.log10(F.lit(float(tokens + distinct + 1)))
    return scored.join(joined, "row", "left").select(
        F.col("key").alias(key), "held_out", "n_tokens", (F.col("seen") + F.coalesce("also", F.lit(0))).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("gain") + F.coalesce("more", F.lit(0.0)) - F.col("n_tokens") * total).alias("base_score"), "score")
