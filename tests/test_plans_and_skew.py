"""Plans have the intended shape, and hot keys change no result."""

import re

import pandas as pd
from pyspark.sql import functions as F

from answerloom.operators import chat, chunk, crawl, embed, feedback, parse, retrieve
from answerloom.plans import tables
from test_feedback import TIES, Log, requests

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_python_runs_once_per_row(spark):
    texts = tables.docs(spark, SF)
    done = embed.embed(texts, "parsed_content").filter("embed_status = 'SUCCESS'").select("path", "embedding")
    assert plan_of(done).count("ArrowEvalPython") == 1
    staged = chunk.stage_recursive(texts, 100, 10)
    assert plan_of(chunk.accepted_chunks(staged)).count("MapInPandas") == 1


def test_scan_reads_only_what_scoring_needs(spark):
    index = tables.index(spark, SF)
    queries = index.select(F.col("chunk_id").alias("query_id"), "embedding").limit(3)
    plan = plan_of(retrieve.knn(queries, index, 2))
    assert re.search(r"ReadSchema: struct<chunk_id:string,embedding:array<float>>", plan)
    assert plan.count("Exchange") == 1  # only the candidates move


def test_rejects_need_no_parsing(spark):
    _, bad = parse.parse_documents(tables.raw_pages(spark, SF))
    assert "script" not in plan_of(bad)


def test_feedback_shuffles(spark):
    plan = plan_of(feedback.latest_feedback(tables.clicks(spark, SF), tables.TIES))
    assert plan.count("Exchange hashpartitioning") == 3
    assert plan.count("row_number(), 1, Partial") == 2  # newest rows are picked before the shuffle


def test_stored_edges_are_not_shuffled(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        edges = crawl.store_edges(spark.range(100).select(
            F.col("id").alias("src"), ((F.col("id") * 3) % 100).alias("dst")), "t_bucketed", 4)
        frontier = spark.range(10).select(F.col("id").alias("src"))
        assert plan_of(frontier.join(edges, "src")).count("Exchange") == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_request_and_hot_reviewer(spark):
    log = Log()
    for i in range(300):
        request = "hot" if i % 3 == 0 else f"r{i % 40}"
        reviewer = None if i % 2 else f"u{i % 50}"
        if i % 5:
            log.text(request, reviewer, i % 59, "positive" if i % 7 else "negative", f"e{i}")
        else:
            log.chunk(request, reviewer, i % 59, i % 4, "true" if i % 2 else "false")
    frame = log.frame(spark)
    merged = feedback.latest_feedback(frame, TIES)
    rows = pd.DataFrame(log.rows, columns=["click", "request", "step", "ts", "source", "text", "chunk"])
    rows["reviewer"] = [s["id"] or "-" for s in rows.source]
    newest = rows[rows.text.notna()].sort_values(["ts", "click"]).groupby(["request", "reviewer"]).tail(1)
    want = {(r.request, r.reviewer, r.text["suggested_output"]) for r in newest.itertuples()}
    got = {(r.request_id, r.source.id or "-", r.text_assessment.suggested_output)
           for r in merged.collect() if r.text_assessment}
    assert got == want
    ids = sorted(set(rows.request)) + ["silent"]
    attached = feedback.attach_feedback(requests(spark, *ids), merged)
    assert attached.count() == merged.count() + 1


def test_hot_text_hot_path_and_hot_conversation(spark):
    rows = [("d0" if i % 3 == 0 else f"d{i}", "copy" if i % 3 == 1 else f"text {i}") for i in range(300)]
    chunks = chunk.with_chunk_id(spark.createDataFrame(rows, "path string, chunked_text string"))
    unique = {r.chunked_text: (r.path, r.n_occurrences) for r in chunk.unique_chunks(chunks).collect()}
    assert len(unique) == 201 and unique["copy"] == (min(p for p, t in rows if t == "copy"), 100)
    assert chunk.chunk_sources(chunks).count() == 300
    turns = [(0, t, "user" if t % 2 == 0 else "assistant", f"t{t}") for t in range(501)]
    turns += [(c, t, "user", f"c{c} t{t}") for c in range(1, 500) for t in range(2)]
    frame = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string")
    split = {r.conv_id: (r.question, r.previous_message, r.n_history) for r in chat.split_turns(frame).collect()}
    assert split[0] == ("t500", "t499", 500) and split[7] == ("c7 t1", "c7 t0", 1)
    assert chat.history_rows(frame).count() == 500 + 499


def test_hub_page(spark):
    edges = [("hub", f"n{i}") for i in range(100)] + [(f"n{i}", "hub") for i in range(100)] + [("n5", "far")]
    reached = crawl.reachable_pages(spark.createDataFrame(edges, "src string, dst string"),
                                    spark.createDataFrame([("hub",)], "url string"))
    assert reached.count() == 102 and reached.filter("url = 'far'").first()["round"] == 2
