"""Text to vectors with a pluggable embedder."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from answerloom.operators.parse import SUCCESS

Embedder = Callable[[Sequence[str]], np.ndarray]

EMBEDDED = T.StructType([
    T.StructField("embedding", T.ArrayType(T.FloatType())),
    T.StructField("status", T.StringType()),
])


@lru_cache(maxsize=500_000)
def _word_code(word: str) -> int:
    return int(hashlib.md5(word.encode()).hexdigest()[:8], 16)


@dataclass(frozen=True)
class HashedWords:
    """Offline embedder: counts of lower-cased words by hash bucket, scaled to length 1."""

    dim: int = 256

    def __call__(self, texts: Sequence[str]) -> np.ndarray:
        rows, buckets = [], []
        for row, text in enumerate(texts):
            codes = [_word_code(w) % self.dim for w in text.lower().split()]
            buckets += codes
            rows += [row] * len(codes)
        flat = np.asarray(rows, dtype=np.int64) * self.dim + np.asarray(buckets, dtype=np.int64)
        counts = np.bincount(flat, minlength=len(texts) * self.dim).reshape(len(texts), self.dim)
        norm = np.sqrt((counts**2).sum(axis=1, keepdims=True))
        return counts / np.where(norm == 0, 1, norm)


def embed(df: DataFrame, text: str, embedder: Embedder | None = None) -> DataFrame:
    """Add ``embedding`` and ``embed_status``; a text that fails gets no vector and an error status.

    Only the text column travels to Python. The function is marked as not
    deterministic so that a later filter on the status does not run it twice.
    """
    embedder = embedder or HashedWords()

    def halved(texts: list[str | None]) -> list[tuple[np.ndarray | None, str]]:
        """A failed batch is halved until its bad texts stand alone, so good ones are asked again a few times at most."""
        try:
            if None in texts:
                raise ValueError("no text")
            return [(v, SUCCESS) for v in np.asarray(embedder(texts), dtype=np.float32)]
        except Exception as error:
            if len(texts) == 1:
                return [(None, f"ERROR: {error}")]
            half = len(texts) // 2
            return halved(texts[:half]) + halved(texts[half:])

    @F.arrow_udf(EMBEDDED)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            texts = batch.to_pylist()
            try:
                if None in texts:
                    raise ValueError("no text")
                vectors = np.asarray(embedder(texts), dtype=np.float32)
                offsets = np.arange(len(texts) + 1, dtype=np.int32) * vectors.shape[1]
                lists = pa.ListArray.from_arrays(offsets, vectors.ravel())
                status = pa.array([SUCCESS] * len(texts), pa.string())
            except Exception:
                half = max(1, len(texts) // 2)
                results = [r for part in (texts[:half], texts[half:]) if part for r in halved(part)]
                lists = pa.array([None if v is None else v.tolist() for v, _ in results], pa.list_(pa.float32()))
                status = pa.array([s for _, s in results], pa.string())
            yield pa.StructArray.from_arrays([lists, status], ["embedding", "status"])

    return (
        df.withColumn("_embedded", run.asNondeterministic()(F.col(text)))
        .withColumn("embedding", F.col("_embedded.embedding"))
        .withColumn("embed_status", F.col("_embedded.status"))
        .drop("_embedded")
    )
