"""Words, lines and hashes of Arrow text columns, computed on whole batches of bytes at a time.

A batch is worked on in pieces of bounded size (`pieces`), so memory does not follow the batch; only a single
text longer than a piece makes a piece larger. Hashes are 64-bit and depend on the bytes alone, never on the
place of a text in its batch.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PIECE_BYTES = 1 << 18

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTE_VALUE = np.random.Generator(np.random.PCG64(20240117)).integers(0, 2**64, 256, dtype=np.uint64)

#: The white space that ends a word: space and tab to carriage return.
WORD_BYTE = np.ones(256, bool)
WORD_BYTE[[0x20, *range(0x09, 0x0E)]] = False

LOWER_ASCII = np.arange(256, dtype=np.uint8)
LOWER_ASCII[0x41:0x5B] += 32


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the bits of unsigned 64-bit values; one to one."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


@cache
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse; sizes are rounded up, so few are kept."""
    out = []
    for base in (_BASE, _BASE_INVERSE):
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        out.append(np.multiply.accumulate(steps))
    return out[0], out[1]


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    return _powers(max(2 * PIECE_BYTES, 1 << max(0, size - 1).bit_length()))


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and where each row starts; null is empty."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, places, data = column.buffers()
    offsets = np.frombuffer(places, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


class Piece:
    """Some rows of a batch: `data` bytes, `offsets` of the rows in them, `first` row number."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, first: int) -> None:
        self.data, self.offsets, self.first = data, offsets, first
        self.rows = len(offsets) - 1

    def words(self, word_byte: np.ndarray = WORD_BYTE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and end of each word, and for each row the number of its first word (one more at the end)."""
        inside = word_byte[self.data]
        cut = np.zeros(len(inside) + 1, bool)
        cut[self.offsets] = True
        begins = inside.copy()
        begins[1:] &= ~inside[:-1] | cut[1:-1]
        ends = np.zeros(len(inside) + 1, bool)
        ends[1:] = inside
        ends[1:-1] &= ~inside[1:] | cut[1:-1]
        starts = np.flatnonzero(begins)
        return starts, np.flatnonzero(ends), np.searchsorted(starts, self.offsets)

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and end of each newline-separated line, and its row. Every row has one line at least."""
        breaks = np.flatnonzero(self.data == 0x0A)
        starts = np.concatenate([self.offsets[:-1], breaks + 1])
        ends = np.concatenate([self.offsets[1:], breaks])
        row = np.concatenate([np.arange(self.rows), np.searchsorted(self.offsets, breaks, side="right") - 1])
        # the line before a break ends there: sort starts and ends apart, row by row
        by_start, by_end = np.lexsort((starts, row)), np.lexsort((ends, row))
        return starts[by_start], ends[by_end], row[by_start]

    def prefix(self, data: np.ndarray | None = None) -> np.ndarray:
        """Prefix sums from which `span_hash` reads the hash of any span of bytes."""
        data = self.data if data is None else data
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE_VALUE[data] * powers(len(data) + 1)[0][: len(data)], out=sums[1:])
        return sums


def span_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    back = powers(len(sums))[1]
    return mix((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64) * _BASE)


def gram_hash(word_hash: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of `size` words, by its first word; runs over the end are left out."""
    count = max(0, len(word_hash) - size + 1)
    total = np.zeros(count, np.uint64)
    for i in range(size):
        total = total * _BASE + word_hash[i : i + count]
    return mix(total)


def inner_grams(first_word: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the words at which a run of `size` words of one row begins, and the rows of these runs."""
    counts = np.maximum(np.diff(first_word) - (size - 1), 0)
    row = np.repeat(np.arange(len(counts)), counts)
    within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return first_word[:-1][row] + within, row


def row_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of values between neighbouring bounds."""
    sums = np.zeros(len(values) + 1, np.result_type(values.dtype, np.int64) if values.dtype != float else float)
    np.cumsum(values, out=sums[1:])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def pieces(column: pa.Array, limit: int = PIECE_BYTES) -> Iterator[Piece]:
    """Consecutive rows, as many as fit the limit, one at least."""
    data, offsets = raw(column)
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1)
        yield Piece(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first], first)
        first = last


def batch_of(columns: Iterable, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [x if isinstance(x, pa.Array) else pa.array(x, type=f.type) for x, f in zip(columns, schema, strict=True)],
        schema=schema)


def training_rest(key, buckets: int):
    """Remainder of the CRC of a key written as text; null counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")), F.lit(buckets))


def packed(df: DataFrame, text: str = "text") -> DataFrame:
    """The whole row as one column and its text beside it: no name can clash with what an operator adds."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), F.col(f"`{text}`").alias("text"))
