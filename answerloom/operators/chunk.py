"""Documents to chunks."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from answerloom.conf import ChunkSettings
from answerloom.functions.text import strip, words
from answerloom.operators.parse import SUCCESS

# Separators of the recursive splitter, coarse to fine.
SEPARATORS = ("\n\n", "\n", " ", "")
# Documents that a task splits at a time.
SPLIT_ROWS = 256


def _explode_chunks(df: DataFrame, chunks: Column) -> DataFrame:
    """One row per chunk; a document without chunks gives no row."""
    return df.select("path", F.posexplode(chunks).alias("chunk_pos", "chunked_text")).select(
        "path", F.col("chunk_pos").cast("bigint").alias("chunk_pos"), "chunked_text"
    )


def chunk_words(docs: DataFrame, size: int, overlap: int, text: str = "parsed_content") -> DataFrame:
    """Windows of ``size`` words; the last ``overlap`` words of one begin the next.

    A window that would only repeat words of the one before is not emitted.
    """
    ChunkSettings(size, overlap)
    stride = size - overlap
    # The word array is used twice below, which keeps it from being split anew per window.
    worded = docs.select("path", words(F.col(text)).alias("_words"))
    n = F.size("_words")
    last = F.greatest(F.lit(0), F.ceil((n - size) / stride)).cast("int")
    starts = F.when(n > 0, F.sequence(F.lit(0), last))
    windows = F.transform(
        starts, lambda i: F.array_join(F.slice("_words", i * stride + 1, F.lit(size)), " ")
    )
    return _explode_chunks(worded, windows)


def pack_lines(docs: DataFrame, max_chars: int, text: str = "parsed_content") -> DataFrame:
    """Whole lines packed greedily into chunks of at most ``max_chars`` characters.

    A line that is longer on its own stays whole. Blank chunks are left out. The
    fold carries line numbers only, never text.
    """
    lined = docs.select("path", F.split(F.col(text), "\n").alias("_lines"))
    lengths = F.transform("_lines", lambda line: F.length(line))

    def step(state: Column, row: Column) -> Column:
        grown = state.used + 1 + row.length
        fits = (row.position > 0) & (grown <= max_chars)
        return F.struct(
            F.when(fits, state.starts).otherwise(F.concat(state.starts, F.array(row.position))).alias("starts"),
            F.when(fits, grown).otherwise(row.length).alias("used"),
        )

    rows = F.transform(lengths, lambda n, i: F.struct(i.alias("position"), n.alias("length")))
    empty = F.struct(F.array().cast("array<int>").alias("starts"), F.lit(0).alias("used"))
    starts = F.aggregate(rows, empty, step, lambda state: state.starts)
    packed = lined.withColumn("_starts", starts)
    chunks = F.transform(
        "_starts",
        lambda s, j: F.array_join(
            F.slice("_lines", s + 1, F.coalesce(F.get("_starts", j + 1), F.size("_lines")) - s), "\n"
        ),
    )
    return _explode_chunks(packed, F.filter(chunks, lambda c: strip(c) != ""))


# --- recursive splitter -------------------------------------------------------------------


@dataclass(frozen=True)
class LengthMeasure:
    """A named way to measure text; ``make`` runs once per task and returns the counter."""

    name: str
    make: Callable[[], Callable[[str], int]]


def length_measure(source: str | Callable[[str], int], name: str | None = None) -> LengthMeasure:
    """Characters, words, a tokenizer by source and name (or its JSON file, at the same place on every machine), or a
    caller's own counter."""
    if callable(source):
        return LengthMeasure(getattr(source, "__name__", "callable"), lambda: source)
    if source == "chars":
        return LengthMeasure("chars", lambda: len)
    if source == "words":
        return LengthMeasure("words", lambda: lambda text: len(text.split()))
    if source in ("tiktoken", "hugging_face") and not name:
        raise ValueError(f"length measure {source!r} needs the name of a tokenizer")
    if source == "tiktoken":

        def encoding() -> Callable[[str], int]:
            import tiktoken

            codec = tiktoken.encoding_for_model(name)
            return lambda text: len(codec.encode(text))

        return LengthMeasure(f"tiktoken:{name}", encoding)
    if source == "hugging_face":

        def pretrained() -> Callable[[str], int]:
            from tokenizers import Tokenizer

            model = Tokenizer.from_file(name) if name.endswith(".json") else Tokenizer.from_pretrained(name)
            return lambda text: len(model.encode(text, add_special_tokens=False).ids)

        return LengthMeasure(f"hugging_face:{name}", pretrained)
    raise ValueError(f"unknown length measure {source!r}")


def split_text(
    text: str, size: int, overlap: int, measure: Callable[[str], int] = len, separators: tuple[str, ...] = SEPARATORS
) -> list[str]:
    """Split at the coarsest separator present; go finer only inside pieces that are too long."""
    level = next(i for i, s in enumerate(separators) if s in text)
    separator, finer = separators[level], separators[level + 1:]
    pieces = _cut(text, separator) if separator else list(text)
    chunks: list[str] = []
    waiting: list[tuple[str, int]] = []
    for piece in pieces:
        length = measure(piece)
        if length < size:
            waiting.append((piece, length))
            continue
        chunks += _merge(waiting, size, overlap)
        waiting = []
        chunks += split_text(piece, size, overlap, measure, finer) if finer else [piece]
    return chunks + _merge(waiting, size, overlap)


def _cut(text: str, separator: str) -> list[str]:
    """Pieces of a text, each but the first with its separator in front."""
    head, *tail = text.split(separator)
    return [p for p in (head, *(separator + t for t in tail)) if p]


def _merge(pieces: list[tuple[str, int]], size: int, overlap: int) -> list[str]:
    """Join neighbouring pieces up to ``size``; whole pieces within ``overlap`` repeat in the next chunk."""
    chunks: list[str] = []

    def emit(first: int, end: int) -> None:
        joined = "".join(p for p, _ in pieces[first:end]).strip()
        if joined:
            chunks.append(joined)

    first = total = 0
    for i, (_, length) in enumerate(pieces):
        if total + length > size and first < i:
            emit(first, i)
            while total > overlap or (total + length > size and total > 0):
                total -= pieces[first][1]
                first += 1
        total += length
    emit(first, len(pieces))
    return chunks


CHUNKED = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("chunked", T.StructType([
        T.StructField("chunked_text", T.ArrayType(T.StringType())),
        T.StructField("chunker_status", T.StringType()),
    ])),
])


def stage_recursive(
    docs: DataFrame, size: int, overlap: int, measure: LengthMeasure | None = None, text: str = "parsed_content"
) -> DataFrame:
    """Each document with its chunks and a status; an exception becomes the row's status."""
    ChunkSettings(size, overlap)
    measure = measure or length_measure("chars")
    kind = pa.struct([("chunked_text", pa.list_(pa.string())), ("chunker_status", pa.string())])
    measure.make()("")  # an unusable tokenizer fails here once, not on every row

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = measure.make()

        def one(value: str | None) -> dict:
            try:
                if value is None:
                    raise ValueError("no text")
                return {"chunked_text": split_text(value, size, overlap, count) if value else [],
                        "chunker_status": SUCCESS}
            except Exception as error:
                return {"chunked_text": [], "chunker_status": f"ERROR: {error}"}

        for batch in batches:  # a few documents and their chunks at a time, however many a batch holds
            for start in range(0, batch.num_rows, SPLIT_ROWS):
                part = batch.slice(start, SPLIT_ROWS)
                chunked = pa.array([one(v.as_py()) for v in part.column("text")], kind)
                yield pa.RecordBatch.from_arrays([part.column("path"), chunked], names=["path", "chunked"])

    return docs.select("path", F.col(text).alias("text")).mapInArrow(run, CHUNKED)


def accepted_chunks(staged: DataFrame) -> DataFrame:
    done = staged.filter(F.col("chunked.chunker_status") == SUCCESS)
    return _explode_chunks(done, F.col("chunked.chunked_text"))


def rejected_chunks(staged: DataFrame) -> DataFrame:
    return staged.filter(~F.col("chunked.chunker_status").eqNullSafe(SUCCESS)).select(
        "path", F.col("chunked.chunker_status").alias("status")
    )


def chunk_recursive(
    docs: DataFrame, size: int, overlap: int, measure: LengthMeasure | None = None, text: str = "parsed_content"
) -> DataFrame:
    return accepted_chunks(stage_recursive(docs, size, overlap, measure, text))


# --- keys ---------------------------------------------------------------------------------


def with_chunk_id(chunks: DataFrame) -> DataFrame:
    return chunks.withColumn("chunk_id", F.md5("chunked_text"))


def unique_chunks(chunks: DataFrame) -> DataFrame:
    """One row per chunk id: the text, the first path it occurs in, and how often it occurs.

    Everything combines before the shuffle, so a text copied into very many
    documents costs no more than any other. All paths are in ``chunk_sources``.
    """
    return chunks.groupBy("chunk_id", "chunked_text").agg(
        F.min("path").alias("path"), F.count(F.lit(1)).alias("n_occurrences")
    )


def chunk_sources(chunks: DataFrame) -> DataFrame:
    """The distinct pairs of chunk id and path."""
    return chunks.select("chunk_id", "path").distinct()
