import pytest
from pyspark.sql import types as S

DOCUMENTS = S.StructType([
    S.StructField("doc_id", S.LongType()), S.StructField("text", S.StringType()), S.StructField("lang", S.StringType()),
    S.StructField("source", S.StringType()), S.StructField("n_chars", S.LongType()),
    # names that operators use for columns of their own
    *[S.StructField(n, S.StringType()) for n in ("key", "row", "score", "kept", "mark", "seeds", "leaves", "salt")],
])


@pytest.fixture(scope="session")
def documents_of(spark):
    """A table of documents from (doc_id, text) rows, with further columns of clashing names."""

    def make(rows):
        filled = [(i, t, "en", None if n % 3 == 0 else f"src{n}", None if t is None else len(t), *["x"] * 8)
                  for n, (i, t) in enumerate(rows)]
        return spark.createDataFrame(filled, DOCUMENTS)

    return make


LONG = " ".join(f"word{i % 977}x{i}" for i in range(60_000))


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and white texts, a very long one, ties and repeated rows."""
    plain = "the quick brown fox jumps over the lazy dog and then goes home to sleep for a while."
    return [(1, plain), (1, plain), (2, None), (3, ""), (4, " \t\n "), (5, LONG), (None, plain + " Again."), (6, plain),
            (None, None), (7, "one"), (8, "Ünïcode — naïve café 漢字 😀 it's 42%")]


@pytest.fixture(scope="session")
def small_documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
