"""Line-first quality rules.

Each line of a text is judged by itself, failing lines are removed, and a document that loses too much of its
text is rejected. A line fails if it is

* marked up: more than `symbol_share` of its characters are of the set `# * $ % & | < >`;
* navigation: at least `nav_share` of its words are bare separators, or it has under `min_words` words and no
  closing punctuation;
* boilerplate: the fixed phrases in it, letter case aside and no part of longer words, make up `phrase_percent` or more of
  its characters. So a phrase in a sentence of a long line fails nothing.

Lines without words never fail. Besides, whole-text figures are returned, and documents are failed outright that
have under ten words or in which over a fifth of the words stands in repeated windows of five words.

Cases: a null text is an empty one; an empty text has zeros everywhere and fails (under ten words). Repeated rows
are judged each by itself; other columns are not looked at; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from answerloom.llm import texts as T

# Symbols, separators, closing marks and phrases of the line rules.
SYMBOLS = "#*$%&|<>"
SEPARATORS = "|>-*#/"
CLOSING = ".!?:;\"')]}"
PHRASES = (
    "all rights reserved", "privacy policy", "terms of use", "terms of service", "cookie policy",
    "uses cookies", "enable javascript", "lorem ipsum", "click here", "skip to content", "read more",
    "share this", "sign up", "log in", "back to top",
)

WINDOW = 5
MIN_DOC_WORDS = 10
REPEAT_PERCENT = 20


@dataclass(frozen=True)
class LineRules:
    symbol_percent: int = 10
    nav_percent: int = 20
    min_words: int = 4
    lost_percent: int = 40
    phrase_percent: int = 25


def _members(characters: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(characters.encode())] = True
    return out


SYMBOL_BYTE, SEPARATOR_BYTE, CLOSING_BYTE = map(_members, (SYMBOLS, SEPARATORS, CLOSING))
#: Letters, digits, the underscore, and all that is not ASCII: what a phrase may not touch.
INNER_BYTE = np.arange(256) >= 0x80
INNER_BYTE[[*b"0123456789_abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"]] = True
#: One for each byte that begins a code point.
POINT_BYTE = (np.arange(256) & 0xC0) != 0x80

METRICS = pa.schema([
    ("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()),
    ("n_repeat_words", pa.int64()), ("base_failed", pa.bool_()), ("n_lines", pa.int64()),
    ("n_failed_lines", pa.int64()), ("lost_chars", pa.int64()), ("kept", pa.bool_()),
])


def _running(flags: np.ndarray) -> np.ndarray:
    out = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=out[1:])
    return out


def _repeated_words(piece: T.Piece, hashes: np.ndarray, first_word: np.ndarray) -> np.ndarray:
    """Flags of the words that stand in a window found twice or more in their row."""
    starts, row = T.inner_grams(first_word, WINDOW)
    covered = np.zeros(len(hashes) + 1, np.int64)
    if len(starts):
        keys = T.mix(T.gram_hash(hashes, WINDOW)[starts] + row.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))
        order = np.argsort(keys)
        ranked = keys[order]
        same = ranked[1:] == ranked[:-1]
        twice = np.zeros(len(keys), bool)
        twice[1:] |= same
        twice[:-1] |= same
        found = starts[order[twice]]
        np.add.at(covered, found, 1)
        np.add.at(covered, found + WINDOW, -1)
    return np.cumsum(covered)[:-1] > 0


def judge(piece: T.Piece, rules: LineRules) -> tuple[list[np.ndarray], tuple[np.ndarray, ...]]:
    """Columns of METRICS for the rows of a piece; start, end, row and verdict of each line."""
    data, offsets = piece.data, piece.offsets
    starts, ends, first_word = piece.words()
    sums = piece.prefix()
    points = _running(POINT_BYTE[data])
    word_points = _running(POINT_BYTE[data] & T.WORD_BYTE[data])
    symbols = _running(SYMBOL_BYTE[data])
    separators = _running(SEPARATOR_BYTE[data])
    n_words = np.diff(first_word)
    hashes = T.span_hash(sums, starts, ends)

    begin, end, row = piece.lines()
    words_before = np.searchsorted(starts, begin)
    line_words = np.searchsorted(starts, end) - words_before
    has_word = line_words > 0
    bare = _running(separators[ends] - separators[starts] == ends - starts)
    line_bare = bare[words_before + line_words] - bare[words_before]
    line_points = points[end] - points[begin]
    last = data[ends[np.maximum(words_before + line_words - 1, 0)] - 1] if len(ends) else np.zeros(len(begin), np.uint8)
    marked_up = 100 * (symbols[end] - symbols[begin]) > rules.symbol_percent * line_points
    navigation = (100 * line_bare >= rules.nav_percent * line_words) | (
        (line_words < rules.min_words) & ~CLOSING_BYTE[last])
    phrase_points = np.zeros(len(begin), np.int64)
    lowered = T.LOWER_ASCII[data].tobytes()
    for phrase in PHRASES:
        at = lowered.find(phrase.encode())
        while at >= 0:
            line, after = np.searchsorted(begin, at, side="right") - 1, at + len(phrase)
            alone = (at == begin[line] or not INNER_BYTE[data[at - 1]]) and (after == end[line] or (
                after < end[line] and not INNER_BYTE[data[after]]))
            if after <= end[line] and alone:
                phrase_points[line] += len(phrase)
            at = lowered.find(phrase.encode(), at + 1)
    boiler = (phrase_points > 0) & (100 * phrase_points >= rules.phrase_percent * line_points)
    failed = has_word & (marked_up | navigation | boiler)

    # equal lines of one row: as many as are not the first of their kind
    key = T.mix(T.span_hash(sums, begin, end) + row.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))[has_word]
    order = np.argsort(key, kind="stable")
    again = np.zeros(len(key), bool)
    again[order[1:]] = key[order[1:]] == key[order[:-1]]

    def per_row(flags, rows):
        return np.bincount(rows, weights=flags, minlength=piece.rows).astype(np.int64)

    repeat = T.row_sums(_repeated_words(piece, hashes, first_word), first_word)
    word_chars = word_points[offsets[1:]] - word_points[offsets[:-1]]
    lost = per_row((word_points[end] - word_points[begin]) * failed, row)
    base_failed = (n_words < MIN_DOC_WORDS) | (100 * repeat > REPEAT_PERCENT * n_words)
    return [
        n_words, word_chars, symbols[offsets[1:]] - symbols[offsets[:-1]], per_row(again, row[has_word]), repeat,
        base_failed, per_row(has_word, row), per_row(failed, row), lost,
        ~base_failed & (100 * lost <= rules.lost_percent * word_chars),
    ], (begin, end, row, failed)


def _clean(piece: T.Piece, begin, end, row, failed) -> list[str]:
    """The texts of a piece without their failed lines."""
    touched = set(row[failed].tolist())
    bounds = np.searchsorted(row, np.arange(piece.rows + 1))
    out = []
    for i in range(piece.rows):
        if i not in touched:
            out.append(piece.data[piece.offsets[i] : piece.offsets[i + 1]].tobytes().decode())
            continue
        lines = range(bounds[i], bounds[i + 1])
        out.append(b"\n".join(piece.data[begin[j] : end[j]].tobytes() for j in lines if not failed[j]).decode())
    return out


def judge_documents(documents: DataFrame, key: str = "doc_id", text: str = "text",
                    rules: LineRules = LineRules()) -> DataFrame:
    """One row per document: its key and the columns of METRICS."""
    source = documents.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0)
            for piece in T.pieces(batch.column(1)):
                columns, _ = judge(piece, rules)
                yield T.batch_of([keys.slice(piece.first, piece.rows), *columns],
                                 pa.schema([pa.field("key", keys.type), *METRICS]))

    kinds = {pa.int64(): "long", pa.bool_(): "boolean"}
    columns = ", ".join(f"{f.name} {kinds[f.type]}" for f in METRICS)
    schema = f"key {source.schema['key'].dataType.simpleString()}, {columns}"
    return source.mapInArrow(run, schema).withColumnRenamed("key", key)


def clean_documents(documents: DataFrame, text: str = "text", length: str | None = "n_chars",
                    rules: LineRules = LineRules()) -> DataFrame:
    """The kept documents with all their columns; failed lines are gone from the text, and its length follows."""
    source = T.packed(documents, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = batch.column(0)
            for piece in T.pieces(batch.column(1)):
                columns, lines = judge(piece, rules)
                kept = pa.array(columns[-1])
                yield pa.RecordBatch.from_arrays(
                    [whole.slice(piece.first, piece.rows).filter(kept),
                     pa.array(_clean(piece, *lines), pa.string()).filter(kept)], names=["row", "clean"])

    kept = source.mapInArrow(run, f"row {source.schema['row'].dataType.simpleString()}, clean string")
    out = []
    for name in documents.columns:
        value = F.col("clean") if name == text else F.col(f"row.`{name}`")
        if length is not None and name == length:
            value = F.char_length("clean").cast(documents.schema[name].dataType)
        out.append(value.alias(name))
    return kept.select(*out)
