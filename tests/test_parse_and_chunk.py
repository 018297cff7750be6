import random

import pytest
from pyspark.sql import functions as F

from answerloom.conf import ChunkSettings, Settings
from answerloom.operators import chunk, parse
from answerloom.plans import jobs
from answerloom.sources import files


def docs_of(spark, *texts):
    return spark.createDataFrame([(f"d{i}", t) for i, t in enumerate(texts)], "path string, parsed_content string")


def test_read_raw_files(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.html").write_text("<p>a</p>")
    (tmp_path / "sub" / "b.html").write_text("<p>bb</p>")
    (tmp_path / "c.txt").write_text("c")
    rows = files.read_raw_files(spark, str(tmp_path), "*.html").collect()
    assert sorted(r.length for r in rows) == [8, 9]
    with pytest.raises(files.EmptySourceError):
        files.read_raw_files(spark, str(tmp_path), "*.pdf")


RAW = "path string, modificationTime timestamp, length bigint, content binary"


def test_parse_quarantines_bad_rows(spark):
    raw = spark.createDataFrame(
        [("ok", None, 1, b"<h1>T</h1>\n\n\n<p>x</p>"), ("bad", None, 1, b"\xff"), ("none", None, 0, None)], RAW)
    good, bad = parse.parse_documents(raw)
    assert [(r.path, r.doc_parsed_contents) for r in good.collect()] == [
        ("ok", {"num_pages": "6", "parsed_content": "# T\n\nx"})]
    assert {r.path: r.status for r in bad.collect()} == {
        "bad": "ERROR: content is not valid utf-8", "none": "ERROR: no content"}
    assert "content" not in good.columns and "content" not in bad.columns


def test_python_parser_keeps_errors_as_values(spark):
    raw = spark.createDataFrame([("a", None, 1, b"p1\fp2"), ("b", None, 1, b"boom"), ("c", None, 0, None)], RAW)

    def read_pages(content):
        if content == b"boom":
            raise ValueError("broken file")
        return content.decode().split("\f")

    good, bad = parse.parse_documents(raw, parse.pages_parser(read_pages))
    assert good.first().doc_parsed_contents == {"num_pages": "2", "parsed_content": "p1\np2"}
    assert {r.path: r.status for r in bad.collect()} == {"b": "ERROR: broken file", "c": "ERROR: no content"}


def test_assemble_pages_in_blocks(spark):
    rows = [("a", n, f"p{n}" if n != 3 else None) for n in range(11)] + [("b", 0, "only")]
    random.Random(1).shuffle(rows)
    pages = spark.createDataFrame(rows, "path string, page_no int, text string")
    got = {r.path: (r.parsed_content, r.num_pages) for r in parse.assemble_pages(pages, block=2).collect()}
    want = "\n".join("" if n == 3 else f"p{n}" for n in range(11))
    assert got == {"a": (want, 11), "b": ("only", 1)}


def test_parse_and_chunk_jobs_report(spark, tmp_path):
    raw = spark.createDataFrame([("ok", None, 1, b"<p>one two three</p>"), ("empty", None, 1, b"<p> </p>"),
                                 ("bad", None, 1, b"\xff")], RAW)
    parsed = jobs.parse_job(raw, "t_parsed")
    chunked = jobs.chunk_job(parsed.accepted, "t_chunks", ChunkSettings(8, 2))
    counts = {(r.stage, r.status): r.n_rows for r in parsed.report.unionByName(chunked.report).collect()}
    assert counts == {("parse", "SUCCESS"): 2, ("parse_rejected", "ERROR: content is not valid utf-8"): 1,
                      ("chunk", "SUCCESS"): 2, ("chunk_empty", "SUCCESS"): 1}
    assert {r.path for r in spark.table("t_chunks").collect()} == {"ok"}
    evaluation = files.documents_for_evaluation(spark, "t_parsed")
    assert {(r.doc_uri, r.content) for r in evaluation.collect()} == {("ok", "one two three"), ("empty", "")}


def test_overwrite_replaces_the_schema(spark):
    files.overwrite_table(spark.range(2), "t_replace")
    again = files.overwrite_table(spark.range(1).withColumn("x", F.lit("y")), "t_replace")
    assert again.columns == ["id", "x"] and again.count() == 1


def test_log_tables_by_quoted_name(spark):
    spark.sql("create database if not exists logs_db")
    for kind in ("request", "assessment"):
        spark.range(1).write.mode("overwrite").saveAsTable(f"logs_db.`pay_load_{kind}_logs`")
    requests, clicks = files.load_feedback_logs(spark, "spark_catalog", "logs_db", "pay_load")
    assert requests.count() == clicks.count() == 1
    assert files.quoted("a", "b", "c`d") == "`a`.`b`.`c``d`"


GOLDENS = [
    ("aaa bbb ccc ddd", 8, 4, ["aaa bbb", "bbb ccc", "ccc ddd"]),
    ("one two\n\nthree four five\nsix", 10, 4, ["one two", "three", "four five", "six"]),
    ("abcdefghijkl xy", 5, 2, ["abcde", "defgh", "ghijk", "jkl", "xy"]),
    ("", 5, 2, []),
    (" \n\n ", 5, 2, []),
]


@pytest.mark.parametrize("text, size, overlap, want", GOLDENS)
def test_splitter_goldens(spark, text, size, overlap, want):
    rows = chunk.chunk_recursive(docs_of(spark, text), size, overlap).orderBy("chunk_pos").collect()
    assert [r.chunked_text for r in rows] == want


def test_splitter_properties():
    generator = random.Random(7)
    for _ in range(3000):
        # Every visible character occurs once, so each has one place in the text.
        text = "".join(generator.choice([chr(0x4E00 + i)] * 3 + [" ", " ", "\n", "\n\n"])
                       for i in range(generator.randint(1, 80)))
        size = generator.randint(2, 20)
        overlap = generator.randint(0, size - 1)
        chunks = chunk.split_text(text, size, overlap)
        visible = [c for c in text if not c.isspace()]
        covered = 0
        for c in chunks:
            assert 0 < len(c) <= size and c in text
            own = [visible.index(x) for x in c if not x.isspace()]
            repeated = [x for x in own if x < covered]
            assert own[0] <= covered and len(repeated) <= overlap
            covered = max(covered, own[-1] + 1)
        assert covered == len(visible)


def test_chunker_errors_are_values(spark):
    def fails(text):
        if "x" in text:
            raise ValueError("no x")
        return len(text)

    docs = docs_of(spark, "aa bb", "xx", None)
    staged = chunk.stage_recursive(docs, 3, 1, chunk.length_measure(fails))
    assert {r.path for r in chunk.accepted_chunks(staged).collect()} == {"d0"}
    assert {r.path: r.status for r in chunk.rejected_chunks(staged).collect()} == {
        "d1": "ERROR: no x", "d2": "ERROR: no text"}


def test_word_measure_and_unknown_measure(spark):
    got = chunk.chunk_recursive(docs_of(spark, "a b c d e"), 3, 1, chunk.length_measure("words")).collect()
    assert all(len(r.chunked_text.split()) <= 3 for r in got)
    with pytest.raises(ValueError):
        chunk.length_measure("nothing")


def test_word_windows(spark):
    def expected(words, size, overlap):
        out, start = [], 0
        while words:
            out.append(" ".join(words[start:start + size]))
            if start + size >= len(words):
                return out
            start += size - overlap
        return out

    texts = [" ".join(f"w{i}" for i in range(n)) for n in (0, 1, 5, 6, 7, 8, 9, 20)] + ["  a\tb c  "]
    got = {}
    for r in chunk.chunk_words(docs_of(spark, *texts), 6, 2).collect():
        got.setdefault(r.path, {})[r.chunk_pos] = r.chunked_text
    for i, t in enumerate(texts):
        assert [v for _, v in sorted(got.get(f"d{i}", {}).items())] == expected(t.split(), 6, 2)


def test_line_packing(spark):
    def expected(text, limit):
        out = []
        for line in text.split("\n"):
            if out and len(out[-1]) + 1 + len(line) <= limit:
                out[-1] += "\n" + line
            else:
                out.append(line)
        return [c for c in out if c.strip()]

    generator = random.Random(3)
    texts = ["\n".join("x" * generator.randint(0, 9) for _ in range(generator.randint(1, 30))) for _ in range(40)]
    got = {}
    for r in chunk.pack_lines(docs_of(spark, *texts), 12).collect():
        got.setdefault(r.path, {})[r.chunk_pos] = r.chunked_text
    for i, t in enumerate(texts):
        assert [v for _, v in sorted(got.get(f"d{i}", {}).items())] == expected(t, 12)


def test_keys_with_copies(spark):
    chunks = chunk.with_chunk_id(spark.createDataFrame(
        [("b", "same"), ("a", "same"), ("a", "same"), ("c", "other")], "path string, chunked_text string"))
    unique = {r.chunked_text: (r.path, r.n_occurrences) for r in chunk.unique_chunks(chunks).collect()}
    assert unique == {"same": ("a", 3), "other": ("c", 1)}
    assert chunk.chunk_sources(chunks).count() == 3


def test_settings():
    with pytest.raises(ValueError):
        ChunkSettings(10, 10)
    with pytest.raises(ValueError):
        ChunkSettings(100, 50, context_window=150)
    for key in ("review_app_evaluation_set_fqn", "evaluation_set_fqn"):
        conf = Settings.from_mapping({
            "data": {"pipeline_config": {"chunker": {"config": {"chunk_size_tokens": 64, "chunk_overlap_tokens": 8}}},
                     "tables_config": {"raw_files_table_name": "a.b"}},
            "rag_chain": {"retriever_config": {"parameters": {"k": 3, "query_type": "ann"},
                                               "schema": {"primary_key": "id"}}},
            "eval": {key: "x.y"}})
        assert (conf.chunk.size, conf.chunk.overlap, conf.tables.raw_files) == (64, 8, "a.b")
        assert (conf.chat.retriever.k, conf.chat.retriever.columns.primary_key) == (3, "id")
        assert conf.tables.feedback_eval_set == "x.y"


def test_chunk_lengths_are_measured_by_the_tokenizer_that_the_settings_name(spark):
    def settings(source, name):
        return Settings.from_mapping({"data": {
            "embedding_config": {"embedding_tokenizer": {"tokenizer_source": source, "tokenizer_model_name": name}},
            "pipeline_config": {"chunker": {"config": {"chunk_size_tokens": 12, "chunk_overlap_tokens": 3}}}}}).chunk

    path = "/opt/tokenizers/byte_bpe_50k.json"
    text = " ".join(f"incomprehensibilities{i}" for i in range(20))
    parsed = spark.createDataFrame([("a", {"num_pages": "1", "parsed_content": text})], "path string, doc_parsed_contents map<string,string>")
    chunks = [r.chunked_text for r in jobs.chunk_job(parsed, "t_tokens", settings("hugging_face", path)).accepted.collect()]
    measure = chunk.length_measure("hugging_face", path).make()
    assert sorted(chunks) == sorted(chunk.split_text(text, 12, 3, measure)) and max(map(len, chunks)) > 24
    for source, name in (("hugging_face", None), ("hugging_face", "/nowhere/t.json"), ("abacus", "x")):
        with pytest.raises(Exception):
            jobs.chunk_job(parsed, "t_tokens", settings(source, name))
