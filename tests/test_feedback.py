import datetime as dt

from pyspark.sql import functions as F

from answerloom.operators import feedback

LOG = ("click int, request_id string, step_id string, timestamp timestamp, source struct<id:string>, "
       "text_assessment struct<suggested_output:string,ratings:map<string,struct<value:string>>>, "
       "retrieval_assessment struct<position:int,step_id:string,ratings:map<string,struct<value:string>>>")
REQUESTS = "request_id string, request string, response string, trace string"
TIES = ("click",)


def at(minute):
    return dt.datetime(2024, 1, 1, 0, minute)


def rating(value):
    return {"answer_correct": {"value": value}}


class Log:
    def __init__(self):
        self.rows = []

    def text(self, request, reviewer, minute, value, edit=None, step="s0"):
        self.rows.append((len(self.rows), request, step, at(minute), {"id": reviewer},
                          {"suggested_output": edit, "ratings": rating(value)}, None))
        return self

    def chunk(self, request, reviewer, minute, position, value, step="s0"):
        self.rows.append((len(self.rows), request, step, at(minute), {"id": reviewer}, None,
                          {"position": position, "step_id": step, "ratings": rating(value)}))
        return self

    def frame(self, spark):
        return spark.createDataFrame(self.rows, LOG)


def requests(spark, *ids):
    trace = '{"chunks":[' + ",".join(f'{{"doc_uri":"d{i}","content":"c{i}"}}' for i in range(4)) + "]}"
    return spark.createDataFrame([(i, f"ask {i}", f"say {i}", trace) for i in ids], REQUESTS)


def evaluate(spark, log, *ids):
    done = feedback.potential_evaluation_set(requests(spark, *ids), feedback.latest_feedback(log.frame(spark), TIES))
    return done.collect()


def test_newest_click_wins_and_ties_are_stable(spark):
    log = Log().text("r", "u", 2, "negative").text("r", "u", 1, "positive").text("r", "v", 3, "positive", "first")
    log.text("r", "v", 3, "positive", "second")
    rows = {r.source.id: r for r in feedback.latest_text(log.frame(spark), TIES).collect()}
    assert rows["u"].text_assessment.ratings["answer_correct"].value == "negative"
    assert rows["v"].text_assessment.suggested_output == "second"


def test_edit_wins_over_response(spark):
    log = (Log().text("edit", "u", 1, "positive", "better").text("empty", "u", 1, "positive", "")
           .text("none", "u", 1, "positive").text("down", "u", 1, "negative")
           .text("fixed", "u", 1, "negative", "right").text("idk", "u", 1, "unknown", "x").text("null", "u", 1, None))
    rows = {r.request_id: r for r in evaluate(spark, log, "edit", "empty", "none", "down", "fixed", "idk", "null", "no")}
    got = {k: (r.expected_response, r.source_tag, r.has_edit) for k, r in rows.items()}
    assert got == {
        "edit": ("better", "thumbs_up", True),
        "empty": ("say empty", "thumbs_up", False),
        "none": ("say none", "thumbs_up", False),
        "down": (None, "thumbs_down_edited", False),
        "fixed": ("right", "thumbs_down_edited", True),
        "idk": (None, "no_feedback_provided", True),
        "null": (None, "no_feedback_provided", False),
        "no": (None, "no_feedback_provided", False),
    }


def test_labels_equal_three_filtered_branches(spark):
    log = Log()
    for i, value in enumerate(["positive", "negative", "unknown", None, "positive", "negative"]):
        log.text(f"r{i}", "u", 1, value, "edit" if i % 2 else None)
    attached = feedback.attach_feedback(requests(spark, *(f"r{i}" for i in range(8))),
                                        feedback.latest_feedback(log.frame(spark), TIES))
    correct = F.col("is_correct")
    parts = [
        attached.filter(correct == "positive").select(
            "request_id", F.coalesce("suggested_output", "response").alias("e"), F.lit("thumbs_up").alias("t")),
        attached.filter(correct == "negative").select(
            "request_id", F.col("suggested_output").alias("e"), F.lit("thumbs_down_edited").alias("t")),
        attached.filter(correct.isNull() | ((correct != "positive") & (correct != "negative"))).select(
            "request_id", F.lit(None).cast("string").alias("e"), F.lit("no_feedback_provided").alias("t")),
    ]
    union = parts[0].unionByName(parts[1]).unionByName(parts[2])
    single = feedback.label_requests(attached).select("request_id", "expected_response", "source_tag")
    assert sorted(map(tuple, single.collect()), key=str) == sorted(map(tuple, union.collect()), key=str)


def test_ratings_stay_on_their_chunk(spark):
    log = Log().chunk("r", "u", 1, 3, "true").chunk("r", "u", 2, 0, "false").chunk("r", "u", 3, 1, "true")
    row, = evaluate(spark, log, "r")
    assert [c.doc_uri for c in row.expected_retrieved_context] == ["d1", "d3"]
    assert row.chunk_at_i_relevance == ["false", "true", "true"]
    none, = evaluate(spark, Log().chunk("r", "u", 1, 0, "false"), "r")
    assert none.expected_retrieved_context is None


def test_later_click_on_a_chunk_replaces_the_earlier(spark):
    log = Log().chunk("r", "u", 1, 2, "true").chunk("r", "u", 5, 2, "false").chunk("r", "u", 1, 0, "true")
    row, = evaluate(spark, log, "r")
    assert [c.doc_uri for c in row.expected_retrieved_context] == ["d0"]


def test_null_reviewer_merges_into_one_row(spark):
    log = Log().text("r", None, 1, "positive").chunk("r", None, 2, 0, "true")
    row, = feedback.latest_feedback(log.frame(spark), TIES).collect()
    assert row.text_assessment is not None and len(row.retrieval_assessment) == 1


def test_grain_is_request_reviewer_and_retrieval_step(spark):
    log = Log().text("r", "u", 1, "positive", step="s9").chunk("r", "u", 2, 0, "true", "s0")
    log.chunk("r", "u", 2, 0, "true", "s1").chunk("r", "v", 2, 0, "true", "s0")
    rows = feedback.latest_feedback(log.frame(spark), TIES).collect()
    keys = [(r.request_id, r.source.id, r.retrieval_step_id) for r in rows]
    assert sorted(keys) == [("r", "u", "s0"), ("r", "u", "s1"), ("r", "v", "s0")]
    assert sorted((r.source.id, r.step_id) for r in rows) == [("u", "s9"), ("u", "s9"), ("v", "s0")]


def test_other_name_of_the_request_key(spark):
    log = Log().text("r", "u", 1, "positive")
    renamed = requests(spark, "r", "q").withColumnRenamed("request_id", "log_request_id")
    done = feedback.evaluation_set(renamed, log.frame(spark), TIES, request_id="log_request_id")
    assert done.columns == list(feedback.EVALUATION_COLUMNS)
    assert {(r.request_id, r.source_tag) for r in done.collect()} == {
        ("r", "thumbs_up"), ("q", "no_feedback_provided")}


def test_a_missing_or_broken_trace_gives_no_context(spark):
    log = Log().chunk("r", "u", 1, 0, "true").chunk("q", "u", 1, 0, "true")
    broken = spark.createDataFrame([("r", "a", "b", None), ("q", "a", "b", "no json")], REQUESTS)
    done = feedback.potential_evaluation_set(broken, feedback.latest_feedback(log.frame(spark), TIES)).collect()
    assert [r.expected_retrieved_context for r in done] == [None, None]
