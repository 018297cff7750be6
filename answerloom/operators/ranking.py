"""Keep-first per group, top-k per group and a distributed global rank."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def top_k(df: DataFrame, keys: Sequence[Column | str], order: Sequence[Column], k: int, rank: str = "rank") -> DataFrame:
    """The first k rows of each group, with their rank.

    Catalyst turns the filter into a group limit that runs before the shuffle as
    well, so a hot group sends at most k rows per map task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= k)


def keep_first(df: DataFrame, keys: Sequence[Column | str], order: Sequence[Column]) -> DataFrame:
    """The first row of each group."""
    return top_k(df, keys, order, 1, "_first").drop("_first")


def hash_buckets(df: DataFrame, key: str, hex_digits: int = 3) -> DataFrame:
    """Add the hash of a unique key, its bucket by hash prefix, the bucket's size and the rows before it.

    The table of buckets has at most 16 ** hex_digits rows, whatever the size of
    the input, so its running sum and its broadcast are safe.
    """
    if not 1 <= hex_digits <= 4:
        raise ValueError("hex_digits must lie between 1 and 4")
    hashed = df.withColumn("_hash", F.md5(F.col(key).cast("string"))).withColumn(
        "_bucket", F.substring("_hash", 1, hex_digits)
    )
    counts = hashed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_in_bucket"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = counts.withColumn("_before", F.coalesce(F.sum("_in_bucket").over(before), F.lit(0)))
    return hashed.join(F.broadcast(buckets), "_bucket")


def rank_in_bucket(key: str) -> Column:
    """Rank over all rows of the input, from the rank in the bucket and the rows before it."""
    local = F.row_number().over(Window.partitionBy("_bucket").orderBy("_hash", key))
    return (F.col("_before") + local).cast("bigint")


BUCKET_COLUMNS = ("_hash", "_bucket", "_in_bucket", "_before")


def hash_rank(df: DataFrame, key: str, rank: str = "rank", hex_digits: int = 3) -> DataFrame:
    """Number all rows 1..n by the md5 hash of a unique key, without a global sort."""
    return hash_buckets(df, key, hex_digits).withColumn(rank, rank_in_bucket(key)).drop(*BUCKET_COLUMNS)
