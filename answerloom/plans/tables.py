"""The given tables in the shapes the engine reads.

Every function takes (spark, sf_dir) and covers the whole table. Where a shape
needs one number from a table (how many conversations there are), that number
is fetched as a single aggregate row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from answerloom.operators.chunk import chunk_words, with_chunk_id
from answerloom.operators.embed import HashedWords
from answerloom.operators.index import build_index
from answerloom.session import write_and_reload
from answerloom.sources.files import raw_from_pages, spread

CHUNK_WORDS, OVERLAP_WORDS, DIM = 64, 16, 256
TIES = ("event_id",)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored pages as raw files; every 17th gets a byte that is not UTF-8."""
    return spoiled(spread(table(spark, sf_dir, "pages")))


def spoiled(pages: DataFrame) -> DataFrame:
    bad = F.col("page_id") % 17 == 0
    marked = pages.withColumn("html", F.encode("html", "UTF-8"))
    return marked.select(
        F.col("url").alias("path"),
        F.lit(None).cast("timestamp").alias("modificationTime"),
        F.when(bad, F.concat("html", F.unhex(F.lit("FF")))).otherwise(F.col("html")).alias("content"),
    ).select("path", "modificationTime", F.octet_length("content").cast("bigint").alias("length"), "content")


def clean_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_from_pages(spread(table(spark, sf_dir, "pages")))


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        F.concat(F.lit("doc/"), F.col("doc_id")).alias("path"), F.col("text").alias("parsed_content")
    )


def page_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each line of a document as one page."""
    return docs(spark, sf_dir).select("path", F.posexplode(F.split("parsed_content", "\n")).alias("page_no", "text"))


def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_chunk_id(chunk_words(docs(spark, sf_dir), CHUNK_WORDS, OVERLAP_WORDS))


def index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chunk index of all documents, as a written table."""
    return write_and_reload(build_index(chunks(spark, sf_dir), HashedWords(DIM)), "index")


def _next_id(df: DataFrame, column: str) -> int:
    top = df.agg(F.max(column)).first()[0]
    return 0 if top is None else top + 1


def request_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every user turn that an assistant turn follows, with a trace of five documents."""
    turns = table(spark, sf_dir, "conversations")
    documents = table(spark, sf_dir, "documents")
    asked = turns.filter("role = 'user'").select("conv_id", "turn", F.col("text").alias("request"))
    answered = turns.filter("role = 'assistant'").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("response")
    )
    log = asked.join(answered, ["conv_id", "turn"]).withColumn(
        "request_id", F.concat(F.lit("r"), "conv_id", F.lit("_"), "turn")
    )
    n_docs = max(1, _next_id(documents, "doc_id"))
    wanted = log.select("request_id", "conv_id", "turn", F.explode(F.sequence(F.lit(0), F.lit(4))).alias("position"))
    wanted = wanted.select(
        "request_id", "position", ((F.col("conv_id") * 7 + F.col("turn") * 3 + F.col("position")) % n_docs).alias("doc_id")
    )
    # Five chunks per request, so the list below is short whatever the data.
    traces = (
        wanted.join(documents.select("doc_id", F.col("text").alias("content")), "doc_id")
        .groupBy("request_id")
        .agg(F.sort_array(F.collect_list(F.struct(
            "position", F.concat(F.lit("doc/"), "doc_id").alias("doc_uri"), "content"))).alias("c"))
        .select("request_id", F.to_json(F.struct(F.transform(
            "c", lambda c: F.struct(c.doc_uri.alias("doc_uri"), c.content.alias("content"))).alias("chunks"))).alias("trace"))
    )
    return log.join(traces, "request_id", "left").select("request_id", "request", "response", "trace")


def n_conversations(spark: SparkSession, sf_dir: str) -> int:
    return max(1, _next_id(table(spark, sf_dir, "conversations"), "conv_id"))


def assessment_log(events: DataFrame, n_conv: int) -> DataFrame:
    """Each event as a reviewer's click on some request."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    text_event = F.col("event_type").isin("purchase", "error", "signup")

    def rating(value: Column) -> Column:
        return F.create_map(F.lit("answer_correct"), F.struct(value.alias("value")))

    base = events.select(
        "event_id",
        F.concat(
            F.lit("r"), F.col("event_id") % n_conv, F.lit("_"), F.floor(F.col("event_id") / n_conv) % 4
        ).alias("request_id"),
        F.col("ts").alias("timestamp"),
        F.struct(
            F.when(F.col("user_id") % 20 != 0, F.concat(F.lit("u"), F.col("user_id") % 3)).alias("id")
        ).alias("source"),
        k.alias("k"),
        "event_type",
    ).withColumn("step_id", F.concat(F.lit("s"), F.col("k") % 2))
    edit = F.when(F.col("k") % 3 == 1, "").when(F.col("k") % 3 == 2, F.concat(F.lit("edit "), "event_id"))
    vote = F.when(F.col("event_type") == "purchase", "positive").when(
        F.col("event_type") == "error", "negative").otherwise("unknown")
    chunk_vote = F.when(F.col("event_type") == "view", "true").otherwise("false")
    return base.select(
        "event_id", "request_id", "step_id", "timestamp", "source",
        F.when(text_event, F.struct(edit.alias("suggested_output"), rating(vote).alias("ratings"))).alias(
            "text_assessment"),
        F.when(~text_event, F.struct(
            (F.col("k") % 5).cast("int").alias("position"), "step_id", rating(chunk_vote).alias("ratings")
        )).alias("retrieval_assessment"),
    )


def clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assessment_log(table(spark, sf_dir, "events"), n_conversations(spark, sf_dir))


def crawl_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A link graph over all pages by a rule, as links between stored pages do not occur in the data."""
    pages = table(spark, sf_dir, "pages")
    n = max(1, _next_id(pages, "page_id"))
    return pages.filter("page_id % 5 <> 0").select(
        F.col("page_id").alias("src"), F.explode(F.array(F.lit(0), F.lit(1))).alias("j")
    ).select("src", ((F.col("src") * 7 + F.col("j") * 13 + 1) % n).alias("dst"))
