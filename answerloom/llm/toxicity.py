"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

Features are the presence of runs of four to six characters (A-Z in lower case), hashed to `2**bits` buckets.

1. Counts: in how many toxic and in how many other documents each bucket occurs, over all labelled training rows.
2. Ratios: the smoothed logarithm of the two shares; the `features` buckets whose ratio stands out most from its
   sampling error are kept.
3. Weights: logistic regression on the ratios of the buckets present. This fit alone sees a bounded sample, at most
   `sample` labelled rows of each class (those whose ids hash lowest), weighted back to the shares of the classes.
4. Scores: every whole text, with a table of `2**bits` numbers.

Training rows are those with a label whose CRC-32 of the id as text leaves another remainder by `folds` than
`held_out`. The score depends on the text alone.

Cases: a null text is an empty one and gets the score of the intercept. Rows without an id are scored, not learned
from. Of several labels of one id the highest counts; null labels count not at all. Documents repeated with one id
count each in the ratios. Without any training row of both classes every score is 0. An empty table gives no rows;
other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from answerloom.llm import texts as T

SIZES = (4, 5, 6)


@dataclass(frozen=True)
class ToxicitySettings:
    bits: int = 19
    features: int = 2048
    sample: int = 4096
    folds: int = 4
    held_out: int = 2
    threshold: float = 0.3
    penalty: float = 1.0
    steps: int = 250


@dataclass(frozen=True)
class Model:
    bits: int
    intercept: float
    #: Ratio times weight of each bucket; zero where a bucket is not kept.
    values: np.ndarray = field(repr=False)
    trained: bool = True


def characters(piece: T.Piece) -> tuple[np.ndarray, np.ndarray]:
    """Code points of a piece, A-Z in lower case, and where each row starts in them."""
    points = np.frombuffer(piece.data.tobytes().decode().encode("utf-32-le"), "<u4").astype(np.uint64)
    points[(points >= 65) & (points <= 90)] += np.uint64(32)
    begins = np.concatenate([[0], np.cumsum((piece.data & 0xC0) != 0x80)])
    return points, begins[piece.offsets]


def buckets(points: np.ndarray, bits: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each size the bucket of the run that starts at each character."""
    rolling, base = points, np.uint64(0xD6E8FEB86659FD93)
    for size in range(2, max(SIZES) + 1):
        rolling = rolling[:-1] * base + points[size - 1 :] if len(rolling) else rolling
        if size in SIZES:
            mixed = (rolling ^ (rolling >> np.uint64(32)) ^ np.uint64(size)) * np.uint64(0x9E3779B97F4A7C15)
            yield size, (mixed >> np.uint64(64 - bits)).astype(np.int64)


def present(piece: T.Piece, bits: int, kept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, bucket) of the kept buckets that occur in a piece, in order."""
    points, bounds = characters(piece)
    found = []
    for size, bucket in buckets(points, bits):
        at = np.flatnonzero(kept[bucket])
        row = np.searchsorted(bounds, at, side="right") - 1
        inner = at + size <= bounds[row + 1]
        found.append((row[inner] << bits) | bucket[at[inner]])
    pairs = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
    return pairs >> bits, pairs & ((1 << bits) - 1)


def count_presence(labelled: DataFrame, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Counts of toxic and of other documents by bucket, the number of all documents of a class in the last place.

    The result has one row a bucket, whatever the number of documents.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = 1 << bits
        counts, flags = np.zeros((2, size + 1), np.int64), np.zeros(size, bool)
        for batch in batches:
            toxic = batch.column(1).to_numpy(zero_copy_only=False)
            for piece in T.pieces(batch.column(0)):
                points, bounds = characters(piece)
                runs = list(buckets(points, bits))
                for i in range(piece.rows):
                    for length, bucket in runs:
                        flags[bucket[bounds[i] : max(bounds[i], bounds[i + 1] - length + 1)]] = True
                    own = np.flatnonzero(flags)
                    kind = int(toxic[piece.first + i] > 0)
                    counts[kind, own] += 1
                    counts[kind, size] += 1
                    flags[own] = False
        some = np.flatnonzero(counts.any(axis=0))
        for start in range(0, len(some), 10_000):
            part = some[start : start + 10_000]
            yield pa.RecordBatch.from_pydict({"bucket": pa.array(part), "other": pa.array(counts[0, part]),
                                              "toxic": pa.array(counts[1, part])})

    summed = labelled.select("text", "toxic").mapInArrow(run, "bucket long, other long, toxic long").groupBy(
        "bucket").agg(F.sum("other").alias("other"), F.sum("toxic").alias("toxic")).toArrow()
    out = np.zeros((2, (1 << bits) + 1), np.int64)
    at = summed["bucket"].to_numpy()
    out[0, at], out[1, at] = summed["other"].to_numpy(), summed["toxic"].to_numpy()
    return out[1], out[0]


def ratios(toxic: np.ndarray, other: np.ndarray, features: int) -> np.ndarray:
    """Log-count ratio by bucket, zero but for the buckets that stand out most."""
    p, q, n_toxic, n_other = toxic[:-1] + 1.0, other[:-1] + 1.0, toxic[-1] + 2.0, other[-1] + 2.0
    ratio = np.log(p / n_toxic) - np.log(q / n_other)
    error = np.sqrt(1 / p - 1 / n_toxic + 1 / q - 1 / n_other)
    strength = np.where(toxic[:-1] + other[:-1] > 0, np.abs(ratio) / np.maximum(error, 1e-9), 0)
    kept = np.argsort(-strength, kind="stable")[:features]
    out = np.zeros(len(ratio))
    out[kept] = ratio[kept] * (strength[kept] > 0)
    return out


def fit_weights(rows: np.ndarray, columns: np.ndarray, ratio: np.ndarray, label: np.ndarray, weight: np.ndarray,
                penalty: float, steps: int) -> tuple[float, np.ndarray]:
    """Logistic regression with a penalty on the distance of the weights from zero; Adam on all rows at once."""
    x, n = ratio[columns], len(label)
    theta, first, second = (np.zeros(len(ratio) + 1) for _ in range(3))
    share = np.clip((weight * label).sum() / weight.sum(), 1e-6, 1 - 1e-6)
    theta[-1] = np.log(share / (1 - share))
    scale = weight / weight.sum()
    for step in range(1, steps + 1):
        z = np.bincount(rows, x * theta[columns], n) + theta[-1]
        error = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - label) * scale
        slope = np.append(np.bincount(columns, x * error[rows], len(ratio)) + penalty * theta[:-1] / n, error.sum())
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope**2
        theta -= 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-9)
    return float(theta[-1]), theta[:-1]


def train(documents: DataFrame, labels: DataFrame, settings: ToxicitySettings = ToxicitySettings(),
          key: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    bits = settings.bits
    marks = (
        labels.select(F.col(key).alias("key"), F.col(label).alias("toxic")).where("key IS NOT NULL AND toxic IS NOT NULL")
        .where(T.training_rest("key", settings.folds) != settings.held_out)
        .groupBy("key").agg((F.max("toxic") > 0).cast("int").alias("toxic")))
    texts = documents.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text")).where(
        T.training_rest("key", settings.folds) != settings.held_out)
    # one plan at every size, and few partial tables of counts
    labelled = texts.join(marks.hint("merge"), "key").coalesce(2 * documents.sparkSession.sparkContext.defaultParallelism)
    toxic, other = count_presence(labelled, bits)
    if not (toxic[-1] and other[-1]):
        return Model(bits, 0.0, np.zeros(1 << bits), trained=False)
    ratio = ratios(toxic, other, settings.features)
    kept = ratio != 0

    chosen = None  # at most `sample` ids of each class
    for kind in (0, 1):
        part = marks.where(F.col("toxic") == kind).orderBy(F.xxhash64("key"), "key").limit(settings.sample)
        chosen = part if chosen is None else chosen.unionByName(part)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in T.pieces(batch.column(0)):
                row, bucket = present(piece, bits, kept)
                bounds = np.searchsorted(row, np.arange(piece.rows + 1)).astype(np.int32)
                yield pa.RecordBatch.from_pydict({
                    "toxic": batch.column(1).slice(piece.first, piece.rows),
                    "buckets": pa.ListArray.from_arrays(pa.array(bounds), pa.array(bucket.astype(np.int32)))})

    seen = texts.join(F.broadcast(chosen), "key").select("text", "toxic").mapInArrow(
        run, "toxic int, buckets array<int>").toArrow().combine_chunks()
    label_of = seen["toxic"].to_numpy()
    lists = seen["buckets"].combine_chunks() if seen["buckets"].num_chunks != 1 else seen["buckets"].chunk(0)
    columns = lists.flatten().to_numpy()
    rows = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
    order = np.flatnonzero(kept)
    place = np.zeros(1 << bits, np.int64)
    place[order] = np.arange(len(order))
    sampled = np.bincount(label_of, minlength=2)
    weight = np.array([other[-1] / max(1, sampled[0]), toxic[-1] / max(1, sampled[1])])[label_of]
    intercept, weights = fit_weights(rows, place[columns], ratio[order], label_of, weight, settings.penalty,
                                     settings.steps)
    values = np.zeros(1 << bits)
    values[order] = weights * ratio[order]
    return Model(bits, intercept, values)


def score(documents: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The whole rows as `row`, and `score`."""
    held = documents.sparkSession.sparkContext.broadcast(model)
    source = T.packed(documents, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held.value
        kept = own.values != 0
        for batch in batches:
            for piece in T.pieces(batch.column(1)):
                row, bucket = present(piece, own.bits, kept)
                z = np.bincount(row, own.values[bucket], piece.rows) + own.intercept
                result = 1 / (1 + np.exp(-np.clip(z, -40, 40))) if own.trained else np.zeros(piece.rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(piece.first, piece.rows), pa.array(result)], names=["row", "score"])

    return source.mapInArrow(run, f"row {source.schema['row'].dataType.simpleString()}, score double")


def score_documents(documents: DataFrame, labels: DataFrame, settings: ToxicitySettings = ToxicitySettings(),
                    key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, held_out, score and predicted of every document."""
    model = train(documents, labels, settings, key, text)
    scored = score(documents.select(key, text), model, text)
    return scored.select(
        F.col(f"row.{key}").alias(key), (T.training_rest(f"row.{key}", settings.folds) == settings.held_out).alias("held_out"),
        "score", (F.col("score") >= settings.threshold).cast("int").alias("predicted"))


def drop_toxic(documents: DataFrame, model: Model, settings: ToxicitySettings = ToxicitySettings(),
               text: str = "text") -> DataFrame:
    """The documents below the threshold, with all their columns."""
    return score(documents, model, text).where(F.col("score") < settings.threshold).select("row.*")
