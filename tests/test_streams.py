import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from answerloom.operators import chunk, index
from answerloom.operators.feedback import latest_feedback
from answerloom.streaming import incremental
from test_feedback import LOG, TIES, Log

RAW = "path string, modificationTime timestamp, length bigint, content binary"


def windows(docs):
    return chunk.chunk_words(docs, 4, 1)


def index_state(df):
    return {(r.chunk_id, r.chunked_text, r.path) for r in df.collect()}


def test_index_follows_new_and_changed_files(spark, tmp_path):
    source, folder = str(tmp_path / "in"), str(tmp_path / "state")

    def deliver(minute, **pages):
        rows = [(p, dt.datetime(2024, 1, 1, 0, minute), 1, None if t is None else t.encode()) for p, t in pages.items()]
        spark.createDataFrame(rows, RAW).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(RAW).parquet(source)
        incremental.stream_index_sync(stream, folder, windows).awaitTermination()

    def rebuilt(**pages):
        docs = spark.createDataFrame(list(pages.items()), "path string, parsed_content string")
        return index_state(index.build_index(chunk.with_chunk_id(windows(docs))))

    assert index_state(incremental.read_index(spark, folder)) == set()
    deliver(1, a="<p>one two three four five six</p>", b="<p>one two three four</p>")
    first = rebuilt(a="one two three four five six", b="one two three four")
    assert index_state(incremental.read_index(spark, folder)) == first
    deliver(2, a="<p>other words now</p>", c="<p>new page here</p>")
    assert index_state(incremental.read_index(spark, folder)) == rebuilt(
        a="other words now", b="one two three four", c="new page here")
    deliver(3, b="<p> </p>")  # the last document with the shared text no longer has it
    assert index_state(incremental.read_index(spark, folder)) == rebuilt(a="other words now", c="new page here")
    vectors = spark.read.parquet(f"{folder}/vectors")
    assert vectors.count() == vectors.select("chunk_id").distinct().count()


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    docs = spark.createDataFrame([("a", "one two three four five")], "path string, parsed_content string")
    chunks = chunk.with_chunk_id(windows(docs))
    for _ in range(2):
        incremental.upsert_documents(spark, str(tmp_path), docs, chunks, 0)
    assert index_state(incremental.read_index(spark, str(tmp_path))) == index_state(index.build_index(chunks))


def merged(df):
    return {(r.request_id, r.source.id, r.retrieval_step_id, str(r.text_assessment), str(r.retrieval_assessment))
            for r in df.collect()}


def test_feedback_stream_equals_batch_whatever_the_order(spark, tmp_path):
    generator = random.Random(11)
    log = Log()
    for _ in range(120):
        who = generator.choice(["u", "v", None])
        if generator.random() < 0.5:
            log.text(f"r{generator.randint(0, 4)}", who, generator.randint(0, 59), generator.choice(["positive", "negative"]))
        else:
            log.chunk(f"r{generator.randint(0, 4)}", who, generator.randint(0, 59), generator.randint(0, 3),
                      generator.choice(["true", "false"]), generator.choice(["s0", "s1"]))
    rows = log.rows[:]
    generator.shuffle(rows)  # late clicks arrive after newer ones
    source, folder = str(tmp_path / "in"), str(tmp_path / "state")
    for start in range(0, 120, 40):
        spark.createDataFrame(rows[start:start + 40], LOG).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(LOG).parquet(source)
        incremental.stream_feedback(stream, folder, TIES).awaitTermination()
    state = incremental.read_feedback(spark, folder, log.frame(spark).schema, TIES)
    assert merged(state) == merged(latest_feedback(log.frame(spark), TIES))
    schema = log.frame(spark).schema
    assert incremental.compact_feedback(spark, folder, schema, TIES, 2)
    assert [p[:2] for p in incremental.log_parts(spark, f"{folder}/clicks")] == [(0, 1), (2, 2)]
    assert merged(incremental.read_feedback(spark, folder, schema, TIES)) == merged(state)


LINE = "path string, chunk_id string"


def lines(spark, folder):
    rows = incremental.read_log(spark, folder, incremental.LINKS).collect()
    return sorted((r.path, r.chunk_id, r.batch_id) for r in rows)


def add(spark, folder, batch, rows=2):
    incremental.write_batch(spark.createDataFrame([(f"d{batch}-{i}", f"c{i}") for i in range(rows)], LINE), folder, batch)


def test_many_batches_become_few_folders_and_no_row_is_lost(spark, tmp_path):
    folder, want = str(tmp_path / "log"), []
    for batch in range(20):
        add(spark, folder, batch)
        want += [(f"d{batch}-{i}", f"c{i}", batch) for i in range(2)]
        before = incremental.read_log(spark, folder, incremental.LINKS)
        incremental.compact_log(spark, folder, incremental.LINKS, None, 3)
        if batch % 5 == 4:
            assert lines(spark, folder) == sorted(want)
            assert before.count() == len(want)  # a reader that has opened the log before goes on
    parts = incremental.log_parts(spark, folder)
    assert len(parts) <= 7 and [p[0] for p in parts[1:]] == [p[1] + 1 for p in parts[:-1]]
    assert [p[2] for p in parts] == sorted((p[2] for p in parts), reverse=True)
    assert len(os.listdir(folder)) < 14 and len(os.listdir(f"{folder}-parts")) <= 4
    add(spark, folder, 19, 3)  # the newest batch is repeated
    assert len(lines(spark, folder)) == 41


@pytest.mark.parametrize("stopped", ["_part", "coalesce", "_remove_replaced", "_remove"])
def test_a_compaction_that_stops_loses_nothing(spark, tmp_path, monkeypatch, stopped):
    folder = str(tmp_path / "log")
    for batch in range(7):
        add(spark, folder, batch)
        if batch in (2, 4):
            incremental.compact_log(spark, folder, incremental.LINKS, None, 2)
    want = lines(spark, folder)

    def stop(*_, **__):
        raise RuntimeError("stopped")

    with monkeypatch.context() as patch:
        if stopped == "coalesce":
            patch.setattr("pyspark.sql.classic.dataframe.DataFrame.coalesce", stop)
        else:
            patch.setattr(incremental, stopped, stop)
        with pytest.raises(RuntimeError):
            incremental.compact_log(spark, folder, incremental.LINKS, None, 2)
    assert lines(spark, folder) == want
    add(spark, folder, 7)
    incremental.compact_log(spark, folder, incremental.LINKS, None, 2)
    assert lines(spark, folder) == sorted(want + [(f"d7-{i}", f"c{i}", 7) for i in range(2)])


def test_compacted_index_equals_the_batch_index(spark, tmp_path):
    source, folder = str(tmp_path / "in"), str(tmp_path / "state")
    pages = {f"p{i % 5}": f"one two three four five {i} six seven" for i in range(7)}
    for i in range(7):
        row = (f"p{i % 5}", dt.datetime(2024, 1, 1, 0, i), 1, f"<p>{'one two three four five'} {i} six seven</p>".encode())
        spark.createDataFrame([row], RAW).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(RAW).option("maxFilesPerTrigger", 1).parquet(source)
    incremental.stream_index_sync(stream, folder, windows, fanout=2).awaitTermination()
    docs = spark.createDataFrame(list(pages.items()), "path string, parsed_content string")
    whole = index.build_index(chunk.with_chunk_id(windows(docs)))

    def state(df):
        return {(r.chunk_id, r.chunked_text, r.path, tuple(r.embedding)) for r in df.collect()}

    assert state(incremental.read_index(spark, folder)) == state(whole)
    assert len(incremental.log_parts(spark, f"{folder}/links")) < 5
    assert incremental.read_log(spark, f"{folder}/links", incremental.LINKS).count() < 2 * 7 * 3


def test_click_state_equals_batch_whatever_the_order_and_after_a_restart(spark, tmp_path):
    from answerloom.streaming import click_state

    generator = random.Random(12)
    log = Log()
    for _ in range(90):
        who = generator.choice(["u", "v", None, ""])
        if generator.random() < 0.5:
            log.text(f"r{generator.randint(0, 2)}", who, generator.randint(0, 59), generator.choice(["positive", "negative"]))
        else:
            log.chunk(f"r{generator.randint(0, 2)}", who, generator.randint(0, 59), generator.randint(0, 2),
                      generator.choice(["true", "false"]), generator.choice(["s0", "s1"]))
    rows = log.rows[:]
    generator.shuffle(rows)
    source, folder = str(tmp_path / "in"), str(tmp_path / "state")
    passed = 0
    for start in range(0, 90, 30):  # a stop and a restart after each part
        spark.createDataFrame(rows[start:start + 30], LOG).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(LOG).parquet(source)
        click_state.stream_newest_clicks(stream, folder, TIES).awaitTermination()
    schema = log.frame(spark).schema
    assert merged(incremental.read_feedback(spark, folder, schema, TIES)) == merged(latest_feedback(log.frame(spark), TIES))
    passed = incremental.read_log(spark, f"{folder}/clicks", schema).count()
    keys = click_state.keyed_clicks(log.frame(spark), TIES).select(*click_state.KEY).distinct().count()
    assert keys <= passed < 90  # older clicks did not pass


def test_sortable_text_keeps_the_order(spark):
    from answerloom.streaming import click_state

    df = spark.createDataFrame([(-5, "b"), (None, None), (7, ""), (0, "ab"), (2**62, "é"), (-2**63, "a")], "n long, s string")
    for column in ("n", "s"):
        want = [r[0] for r in df.orderBy(column).select(column).collect()]
        key = click_state.sortable(F.col(column), df.schema[column].dataType)
        assert [r[0] for r in df.orderBy(key).select(column).collect()] == want
