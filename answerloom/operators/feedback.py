"""Reviewer click logs to one merged assessment per request, reviewer and retrieval step."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from answerloom.functions.text import null_if_empty
from answerloom.operators.parse import SUCCESS
from answerloom.operators.ranking import keep_first
from answerloom.session import write_and_reload


def _newest_first(ties: Sequence[str]) -> list[Column]:
    return [F.desc("timestamp"), *(F.desc(t) for t in ties)]


# The reviewer as two columns that are never null, so that one hash partitioning serves
# grouping and joining, and a null reviewer meets a null reviewer.
_REVIEWER = ["_reviewer", "_anonymous"]


def _keyed(log: DataFrame) -> DataFrame:
    reviewer = F.col("source.id")
    return log.withColumns({"_reviewer": F.coalesce(reviewer, F.lit("")), "_anonymous": reviewer.isNull()})


def _latest_text(keyed: DataFrame, ties: Sequence[str]) -> DataFrame:
    rows = keyed.filter(F.col("text_assessment").isNotNull())
    return keep_first(rows, ["request_id", *_REVIEWER], _newest_first(ties))


def _latest_retrieval(keyed: DataFrame, ties: Sequence[str]) -> DataFrame:
    rows = keyed.filter(F.col("retrieval_assessment").isNotNull())
    place = [F.col("retrieval_assessment.position"), F.col("retrieval_assessment.step_id")]
    return keep_first(rows, ["request_id", *_REVIEWER, *place], _newest_first(ties))


def _nest(keyed: DataFrame) -> DataFrame:
    def by_position(a: Column, b: Column) -> Column:
        return (
            F.when(a.position < b.position, -1).when(a.position > b.position, 1)
            .when(a.step_id < b.step_id, -1).when(a.step_id > b.step_id, 1).otherwise(0)
        )

    # Partitioned as the join with the text assessments needs it; grouping by one more column keeps that.
    return keyed.repartition("request_id", *_REVIEWER).groupBy("request_id", *_REVIEWER, "step_id").agg(
        F.max("timestamp").alias("timestamp"),
        F.max_by("source", "timestamp").alias("source"),
        F.array_sort(F.collect_list("retrieval_assessment"), by_position).alias("retrieval_assessments"),
    )


def latest_text(log: DataFrame, ties: Sequence[str] = ("step_id",)) -> DataFrame:
    """The newest text assessment per request and reviewer."""
    return _latest_text(_keyed(log), ties).drop(*_REVIEWER)


def latest_retrieval(log: DataFrame, ties: Sequence[str] = ("step_id",)) -> DataFrame:
    """The newest chunk assessment per request, reviewer, chunk position and retrieval step."""
    return _latest_retrieval(_keyed(log), ties).drop(*_REVIEWER)


def nest_retrieval(latest: DataFrame) -> DataFrame:
    """Chunk assessments of one request, reviewer and step as a list ordered by position.

    The input holds one row per position, so a list is at most as long as the
    retrieved context of its step, however many clicks there were.
    """
    return _nest(_keyed(latest)).drop(*_REVIEWER)


def latest_feedback(log: DataFrame, ties: Sequence[str] = ("step_id",)) -> DataFrame:
    """Text and chunk assessments merged; a null reviewer matches a null reviewer.

    The grain is one row per request, reviewer and retrieval step. ``step_id``
    prefers the step of the text assessment; ``retrieval_step_id`` completes the key.
    Both inputs are already reduced to their keys, so no join key repeats often.
    """
    keyed = _keyed(log)
    text = _latest_text(keyed, ties).alias("a")
    nested = _nest(_latest_retrieval(keyed, ties)).alias("b")
    same = F.col("a.request_id") == F.col("b.request_id")
    for name in _REVIEWER:
        same = same & (F.col(f"a.{name}") == F.col(f"b.{name}"))

    def either(name: str) -> Column:
        return F.coalesce(F.col(f"a.{name}"), F.col(f"b.{name}")).alias(name)

    return text.join(nested, same, "full_outer").select(
        either("request_id"), either("step_id"), either("timestamp"), either("source"),
        F.col("a.text_assessment").alias("text_assessment"),
        F.col("b.retrieval_assessments").alias("retrieval_assessment"),
        F.col("b.step_id").alias("retrieval_step_id"),
    )


def attach_feedback(requests: DataFrame, feedback: DataFrame, request_id: str = "request_id") -> DataFrame:
    """Every request with its ratings; a request without any keeps one row of nulls.

    Written as an inner join plus an anti join: the requests are unique, and in
    an inner join the skew handling may split a request with very many ratings,
    which it may not do on the right side of a left outer join.
    """
    log = requests.withColumnRenamed(request_id, "request_id") if request_id != "request_id" else requests
    ratings = feedback.select(
        "request_id",
        F.col("text_assessment.ratings.answer_correct.value").alias("is_correct"),
        null_if_empty(F.col("text_assessment.suggested_output")).alias("suggested_output"),
        F.col("source.id").alias("source_user"),
        "retrieval_assessment",
        "retrieval_step_id",
    )
    rated = log.join(ratings, "request_id")
    unrated = log.join(feedback.select("request_id").distinct(), "request_id", "left_anti")
    return rated.unionByName(unrated, allowMissingColumns=True)


def label_requests(attached: DataFrame) -> DataFrame:
    """Expected response and tag for all three kinds of rating, in one pass.

    Thumbs up: the reviewer's edit, else the response. Thumbs down: the edit, if
    there is one. Anything else: nothing.
    """
    up, down = F.col("is_correct") == "positive", F.col("is_correct") == "negative"
    return attached.withColumns({
        "expected_response": F.when(up, F.coalesce("suggested_output", "response")).when(down, F.col("suggested_output")),
        "source_tag": F.when(up, "thumbs_up").when(down, "thumbs_down_edited").otherwise("no_feedback_provided"),
        "has_edit": F.col("suggested_output").isNotNull(),
    })


@dataclass(frozen=True)
class TraceLayout:
    """Where a trace holds the retrieved chunks, in rank order: JSON paths to their list, and in each of them to address
    and text."""

    chunks: str = "$.chunks"
    doc_uri: str = "$.doc_uri"
    content: str = "$.content"


NO_TRACE, BROKEN_TRACE, OTHER_TRACE = "no trace", "ERROR: trace is no JSON", "ERROR: trace has no list of chunks"


def read_trace(trace: Column, layout: TraceLayout = TraceLayout()) -> Column:
    """Struct of ``chunks``, an array of (doc_uri, content), and ``status``; a trace that does not fit has a null array."""
    parsed = F.try_parse_json(trace)
    listed = F.try_variant_get(parsed, layout.chunks, "array<variant>")
    chunks = F.transform(listed, lambda c: F.struct(
        F.try_variant_get(c, layout.doc_uri, "string").alias("doc_uri"),
        F.try_variant_get(c, layout.content, "string").alias("content")))
    status = (
        F.when(trace.isNull(), NO_TRACE).when(parsed.isNull(), BROKEN_TRACE).when(listed.isNull(), OTHER_TRACE)
        .otherwise(SUCCESS))
    return F.struct(chunks.alias("chunks"), status.alias("status"))


def retrieved_chunks(trace: Column, layout: TraceLayout = TraceLayout()) -> Column:
    return read_trace(trace, layout).getField("chunks")


def expected_context(labelled: DataFrame, layout: TraceLayout = TraceLayout()) -> DataFrame:
    """Add ``chunk_at_i_relevance`` and ``expected_retrieved_context``.

    A rating belongs to the chunk at its position, so a missing position shifts
    nothing. No chunk rated ``"true"`` gives null. All of it is local to a row.
    """
    ratings = F.transform(
        "retrieval_assessment",
        lambda r: F.struct(r.position.alias("position"), r.ratings["answer_correct"].value.alias("value")),
    )
    prepared = labelled.withColumns({"_chunks": retrieved_chunks(F.col("trace"), layout), "_ratings": ratings})
    relevant = F.filter(
        "_chunks",
        lambda chunk, i: F.exists("_ratings", lambda r: (r.position == i) & (r.value == "true")),
    )
    return (
        prepared.withColumn("_relevant", relevant)
        .withColumns({
            "chunk_at_i_relevance": F.transform("_ratings", lambda r: r.value),
            "expected_retrieved_context": F.when(F.size("_relevant") > 0, F.col("_relevant")),
        })
        .drop("_chunks", "_ratings", "_relevant", "retrieval_assessment")
    )


def potential_evaluation_set(requests: DataFrame, feedback: DataFrame, request_id: str = "request_id",
                             layout: TraceLayout = TraceLayout()) -> DataFrame:
    """Requests with ratings, labels and expected context; all columns kept for inspection."""
    return expected_context(label_requests(attach_feedback(requests, feedback, request_id)), layout)


EVALUATION_COLUMNS = (
    "request", "request_id", "expected_response", "expected_retrieved_context", "source_user", "source_tag",
)


def evaluation_set(requests: DataFrame, log: DataFrame, ties: Sequence[str] = ("step_id",),
                   request_id: str = "request_id", layout: TraceLayout = TraceLayout()) -> DataFrame:
    """The evaluation set of six columns, straight from the two logs.

    The merged feedback is written once, as two joins read it.
    """
    merged = write_and_reload(latest_feedback(log, ties), "feedback")
    return potential_evaluation_set(requests, merged, request_id, layout).select(*EVALUATION_COLUMNS)
