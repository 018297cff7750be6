"""State kept as an append-only log of batches in a folder.

Each micro batch owns one folder, written with overwrite, so a repeated batch
replaces itself and nothing else. Readers reduce the log to the latest state.
Reading and writing never touch the same files, and no state lives in memory.

A long log is compacted by tiers: some neighbouring folders of one tier become one
folder of the next, so a row is written anew a logarithmic number of times and few
folders are left. A list of the folders that count is written last, as one file;
until then readers see the log as before, and the folders that it replaces stay
until the compaction after.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from answerloom.operators.chunk import unique_chunks, with_chunk_id
from answerloom.operators.embed import Embedder, embed
from answerloom.operators.feedback import latest_feedback, latest_retrieval, latest_text
from answerloom.operators.parse import SUCCESS, accepted, rejected, stage_parse
from answerloom.session import write_and_reload

LINKS = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("chunk_id", T.StringType()),
])
VECTORS = T.StructType([
    T.StructField("chunk_id", T.StringType()),
    T.StructField("chunked_text", T.StringType()),
    T.StructField("embedding", T.ArrayType(T.FloatType())),
])

#: What a batch could not take in: files (stage parse) and texts (stage embed). The texts are tried again in later batches.
REJECTS = T.StructType([
    T.StructField("stage", T.StringType()),
    T.StructField("path", T.StringType()),
    T.StructField("chunk_id", T.StringType()),
    T.StructField("chunked_text", T.StringType()),
    T.StructField("status", T.StringType()),
])


def write_batch(df: DataFrame, folder: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(f"{folder}/batch_id={batch_id}")


def open_log(spark: SparkSession, folder: str, schema: T.StructType) -> None:
    """Start a log with an empty batch; does nothing if there is one."""
    spark.createDataFrame([], schema).write.mode("ignore").parquet(f"{folder}/batch_id=-1")


PARTS = "generation int, first long, last long, tier int"
#: So many neighbouring folders of one tier become one of the next.
FANOUT = 8


def for_all_cores(df: DataFrame, key: str) -> DataFrame:
    """Rows dealt by a key for work that takes far longer than its bytes suggest, as parsing and embedding do: a number of
    partitions that adaptive execution does not lower."""
    return df.repartition(2 * df.sparkSession.sparkContext.defaultParallelism, key)


def _names(spark: SparkSession, folder: str) -> list[str]:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in system.listStatus(path)] if system.exists(path) else []


def _remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _batches(spark: SparkSession, folder: str) -> list[int]:
    return sorted(int(n.removeprefix("batch_id=")) for n in _names(spark, folder) if n.startswith("batch_id="))


def _generations(spark: SparkSession, folder: str) -> dict[int, list[tuple[int, int, int]]]:
    """The lists of compacted parts (first, last, tier) by generation."""
    if not _names(spark, f"{folder}-parts"):
        return {}
    rows = spark.read.schema(PARTS).parquet(f"{folder}-parts").collect()  # a few rows a generation, two generations
    return {g: sorted((r["first"], r["last"], r["tier"]) for r in rows if r.generation == g) for g in {r.generation for r in rows}}


def _part(folder: str, first: int, last: int) -> str:
    return f"{folder}-compacted/{first}_{last}"


def log_parts(spark: SparkSession, folder: str) -> list[tuple[int, int, int]]:
    """What readers of a log read: (first, last, tier) of compacted parts, and of the single batches after them (tier 0)."""
    known = _generations(spark, folder)
    parts = known[max(known)] if known else []
    covered = max((last for _, last, _ in parts), default=None)
    return parts + [(b, b, 0) for b in _batches(spark, folder) if covered is None or b > covered]


def read_log(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """All batches of a log with their number; empty before the first batch."""
    full = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
    known = _generations(spark, folder)
    parts = known[max(known)] if known else []
    try:
        log = spark.read.schema(full).parquet(folder)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], full)
    if not parts:
        return log
    compacted = spark.read.schema(full).parquet(*[_part(folder, first, last) for first, last, _ in parts])
    return log.filter(F.col("batch_id") > max(last for _, last, _ in parts)).unionByName(compacted)


def compact_log(
    spark: SparkSession, folder: str, schema: T.StructType, reducer: Callable[[DataFrame], DataFrame] | None = None,
    fanout: int = FANOUT,
) -> bool:
    """Merge neighbouring parts of a log where `fanout` or more have one tier; tells whether there was anything to do.

    The newest batch is left alone, as a stream may repeat it. A reducer gets the rows of neighbouring batches with their
    `batch_id` and leaves out those that a later one of them replaces. One compaction of a log may run at a time.
    """
    if fanout < 2:
        raise ValueError("fanout must be at least 2")
    known = _generations(spark, folder)
    live = log_parts(spark, folder)[:-1]
    merged = [(first, last, tier, [(first, last, tier)]) for first, last, tier in live]
    while True:  # the parts of the lowest tiers stand last
        run = next((i for i in range(len(merged)) if len([p for p in merged[i:] if p[2] == merged[i][2]]) >= fanout), None)
        if run is None:
            break
        group = [p for p in merged[run:] if p[2] == merged[run][2]]
        whole = (group[0][0], group[-1][1], group[0][2] + 1, [s for p in group for s in p[3]])
        merged = merged[:run] + [whole] + merged[run + len(group):]
    if all(len(sources) == 1 for *_, sources in merged):
        return False
    full = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
    for first, last, _, sources in merged:
        if len(sources) > 1:
            folders = [_part(folder, a, b) for a, b, tier in sources if tier]
            rows = spark.read.schema(full).parquet(*folders) if folders else spark.createDataFrame([], full)
            if any(tier == 0 for *_, tier in sources):
                oldest, newest = min(a for a, _, t in sources if t == 0), max(b for _, b, t in sources if t == 0)
                rows = rows.unionByName(spark.read.schema(full).parquet(folder).filter(F.col("batch_id").between(oldest, newest)))
            reduced = reducer(rows) if reducer else rows
            reduced.select(full.fieldNames()).hint("rebalance").write.mode("overwrite").parquet(_part(folder, first, last))
    parts = [(first, last, tier) for first, last, tier, _ in merged if tier > 0]
    generation = max(known, default=-1) + 1
    listed = spark.createDataFrame([(generation, *p) for p in parts], PARTS)
    listed.coalesce(1).write.mode("append").partitionBy("generation").parquet(f"{folder}-parts")
    _remove_replaced(spark, folder, _generations(spark, folder))
    return True


def _remove_replaced(spark: SparkSession, folder: str, known: dict[int, list[tuple[int, int, int]]]) -> None:
    """Remove what neither the newest list nor the one before it reads; the old lists go first."""
    kept = sorted(known)[-2:]
    for generation in sorted(known)[:-2]:
        _remove(spark, f"{folder}-parts/generation={generation}")
    if len(kept) < 2:
        return  # readers may still hold the single batches
    used = {f"{first}_{last}" for g in kept for first, last, _ in known[g]}
    for name in _names(spark, f"{folder}-compacted"):
        if name not in used:
            _remove(spark, f"{folder}-compacted/{name}")
    covered = max((last for _, last, _ in known[kept[0]]), default=None)
    for batch in _batches(spark, folder):
        if covered is not None and batch <= covered:
            _remove(spark, f"{folder}/batch_id={batch}")


# --- index ----------------------------------------------------------------------------------


def upsert_documents(
    spark: SparkSession, folder: str, docs: DataFrame, chunks: DataFrame, batch_id: int,
    embedder: Embedder | None = None, unparsed: DataFrame | None = None,
) -> None:
    """Record the current chunks of the documents in a batch and embed the texts not seen before.

    ``docs`` (path) names every document of the batch, also those whose text no longer
    gives any chunk: their old chunks must go. ``chunks`` has path, chunked_text, chunk_id.
    """
    open_log(spark, f"{folder}/vectors", VECTORS)
    links = chunks.select("path", "chunk_id").distinct()
    emptied = docs.select("path").distinct().join(links.select("path").distinct(), "path", "left_anti")
    write_batch(
        links.unionByName(emptied.withColumn("chunk_id", F.lit(None).cast("string"))), f"{folder}/links", batch_id
    )
    known = read_log(spark, f"{folder}/vectors", VECTORS).filter(F.col("batch_id") < batch_id).select("chunk_id")
    open_log(spark, f"{folder}/rejects", REJECTS)
    earlier = read_log(spark, f"{folder}/rejects", REJECTS).filter(
        (F.col("batch_id") < batch_id) & (F.col("stage") == "embed")).select("chunk_id", "chunked_text", "path")
    wanted = unique_chunks(chunks).select("chunk_id", "chunked_text", "path").unionByName(earlier)
    fresh = for_all_cores(wanted, "chunk_id").join(known, "chunk_id", "left_anti").groupBy("chunk_id").agg(
        F.first("chunked_text").alias("chunked_text"), F.min("path").alias("path"))
    embedded = write_and_reload(embed(fresh, "chunked_text", embedder), "sync-vectors")
    good = F.col("embed_status") == SUCCESS
    write_batch(embedded.filter(good).select("chunk_id", "chunked_text", "embedding"), f"{folder}/vectors", batch_id)
    failed = embedded.filter(~good).select(
        F.lit("embed").alias("stage"), "path", "chunk_id", "chunked_text", F.col("embed_status").alias("status"))
    empty = F.lit(None).cast("string")
    unread = spark.createDataFrame([], REJECTS) if unparsed is None else unparsed.select(
        F.lit("parse").alias("stage"), "path", empty.alias("chunk_id"), empty.alias("chunked_text"), "status")
    write_batch(failed.unionByName(unread), f"{folder}/rejects", batch_id)


def newest_links(links: DataFrame) -> DataFrame:
    """The rows of the last batch that names a document; what earlier ones say of it no longer counts."""
    newest = links.groupBy("path").agg(F.max("batch_id").alias("batch_id"))
    return links.join(newest, ["path", "batch_id"])


def compact_index(spark: SparkSession, folder: str, fanout: int = FANOUT) -> None:
    """Compact the three logs of an index."""
    compact_log(spark, f"{folder}/links", LINKS, newest_links, fanout)
    compact_log(spark, f"{folder}/vectors", VECTORS, None, fanout)
    compact_log(spark, f"{folder}/rejects", REJECTS, None, fanout)


def read_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Files that failed to parse, each time they came, and texts that no batch has embedded so far."""
    log = read_log(spark, f"{folder}/rejects", REJECTS)
    done = read_log(spark, f"{folder}/vectors", VECTORS).select("chunk_id")
    texts = log.filter("stage = 'embed'").groupBy("chunk_id").agg(
        *[F.max_by(c, "batch_id").alias(c) for c in ("stage", "path", "chunked_text", "status", "batch_id")])
    return log.filter("stage = 'parse'").unionByName(texts.join(done, "chunk_id", "left_anti"))


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    """The live index: chunks of the latest version of each document, one row per chunk id."""
    live = (
        newest_links(read_log(spark, f"{folder}/links", LINKS))
        .filter(F.col("chunk_id").isNotNull())
        .groupBy("chunk_id")
        .agg(F.min("path").alias("path"))
    )
    vectors = read_log(spark, f"{folder}/vectors", VECTORS).drop("batch_id")
    return vectors.join(live, "chunk_id").select("chunk_id", "chunked_text", "path", "embedding")


def stream_index_sync(
    raw_stream: DataFrame,
    folder: str,
    chunker: Callable[[DataFrame], DataFrame],
    parser: str = "html",
    embedder: Embedder | None = None,
    fanout: int | None = None,
) -> StreamingQuery:
    """Follow a stream of raw files (path, content, ...): process what is new, then stop.

    If a batch holds one path twice, the later modification time wins. With ``fanout`` the logs are compacted after
    each batch, where so many folders of one tier have come together.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        age = F.coalesce("modificationTime", F.timestamp_seconds(F.lit(0)))
        files = for_all_cores(batch, "path").groupBy("path").agg(F.max_by("content", age).alias("content"))
        # Parsed and chunked rows feed several writes, so both are written once.
        staged = write_and_reload(stage_parse(files, parser), "sync-batch")
        parsed = accepted(staged)
        docs = parsed.select("path", F.col("doc_parsed_contents.parsed_content").alias("parsed_content"))
        chunks = write_and_reload(with_chunk_id(chunker(docs)), "sync-chunks")
        upsert_documents(spark, folder, docs, chunks, batch_id, embedder, rejected(staged))
        if fanout is not None:
            compact_index(spark, folder, fanout)

    return (
        raw_stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", f"{folder}/progress")
        .trigger(availableNow=True)
        .start()
    )


# --- feedback -------------------------------------------------------------------------------


def reduce_feedback(log: DataFrame, ties: tuple[str, ...]) -> DataFrame:
    """The rows of a log that can still matter: the newest per text key and per chunk key."""
    return reduce(DataFrame.unionByName, (
        latest_text(log, ties).withColumn("retrieval_assessment", F.lit(None).cast(
            log.schema["retrieval_assessment"].dataType)),
        latest_retrieval(log, ties).withColumn("text_assessment", F.lit(None).cast(
            log.schema["text_assessment"].dataType)),
    ))


def read_feedback(spark: SparkSession, folder: str, schema: T.StructType, ties: tuple[str, ...]) -> DataFrame:
    """Merged feedback over all batches; event time decides, never the order of arrival."""
    return latest_feedback(read_log(spark, f"{folder}/clicks", schema).drop("batch_id"), ties)


def stream_feedback(stream: DataFrame, folder: str, ties: tuple[str, ...]) -> StreamingQuery:
    """Follow a stream of clicks; each batch keeps only its newest rows per key."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        write_batch(reduce_feedback(batch, ties), f"{folder}/clicks", batch_id)

    return (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", f"{folder}/progress")
        .trigger(availableNow=True)
        .start()
    )


def compact_feedback(
    spark: SparkSession, folder: str, schema: T.StructType, ties: tuple[str, ...], fanout: int = FANOUT
) -> bool:
    """Compact the log of clicks; a merged part keeps the newest rows per key only."""

    def newest(rows: DataFrame) -> DataFrame:
        last = rows.agg(F.max("batch_id")).first()[0]
        return reduce_feedback(rows.drop("batch_id"), ties).withColumn("batch_id", F.lit(last).cast("long"))

    return compact_log(spark, f"{folder}/clicks", schema, newest, fanout)
