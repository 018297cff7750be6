import pyarrow as pa
from pyspark.sql import functions as F

from answerloom.operators import chunk
from answerloom.plans import queries
from answerloom.streaming import click_state


def test_rewrite_prompts_of_all_conversations_with_their_sizes(spark, tmp_path):
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", "b"), (1, 2, "system", "c"), (1, 3, "user", "d"), (2, 0, "user", "alone")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    found = queries.chat_rewrite_prompt(spark, str(tmp_path)).orderBy("conv_id", "position").collect()
    assert [(r.conv_id, r.position, r.n_prompt_messages) for r in found] == [
        (1, -1, 4), (1, 0, 4), (1, 1, 4), (1, 2, 4), (1, 3, 4), (2, 0, 2)]
    assert found[-1].content is None and found[2].content == "\nassistant: b"


def test_one_state_for_all_places_of_a_reviewer_on_a_request(spark):
    rating = "map<string,struct<value:string>>"
    log = spark.createDataFrame(
        [(i, "r1", "u", i % 5) for i in range(20)], "event_id long, request_id string, who string, position int").select(
        "event_id", "request_id", F.timestamp_seconds("event_id").alias("timestamp"), F.struct(F.col("who").alias("id")).alias("source"),
        F.lit(None).cast(f"struct<suggested_output:string,ratings:{rating}>").alias("text_assessment"),
        F.struct("position", F.lit("s0").alias("step_id"), F.lit(None).cast(rating).alias("ratings")).alias("retrieval_assessment"))
    clicks = click_state.keyed_clicks(log, ("event_id",))
    assert clicks.select(*click_state.KEY).distinct().count() == 5
    assert clicks.select(*click_state.STATE_KEY).distinct().count() == 1


def test_recursive_splitter_holds_few_documents_at_a_time(spark, monkeypatch):
    """The worker gets a batch of 1,000 documents, and gives out their chunks in parts."""
    docs = spark.range(1000).select(F.col("id").cast("string").alias("path"), F.concat(F.lit("one two "), "id").alias("parsed_content"))
    taken = {}
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, run, schema: taken.update(run=run) or self)
    chunk.stage_recursive(docs, 6, 2)
    batch = pa.RecordBatch.from_pydict({"path": [str(i) for i in range(1000)], "text": [f"one two {i}" for i in range(999)] + [None]})
    parts = list(taken["run"](iter([batch])))
    assert max(p.num_rows for p in parts) <= chunk.SPLIT_ROWS and sum(p.num_rows for p in parts) == 1000
    assert parts[0].column("chunked")[7].as_py() == {"chunked_text": chunk.split_text("one two 7", 6, 2), "chunker_status": "SUCCESS"}
    assert parts[-1].column("chunked")[-1].as_py()["chunker_status"].startswith("ERROR")
