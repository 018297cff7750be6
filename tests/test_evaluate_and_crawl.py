import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from answerloom.operators import crawl, evaluate
from answerloom.plans import jobs
from answerloom.sources import pages as page_files
from answerloom.sources.files import read_raw_files


def test_quota_covers_and_sums(spark):
    for n_docs, n_evals in ((7, 40), (50, 8), (5, 5), (3, 0)):
        docs = spark.createDataFrame([(f"d{i}",) for i in range(n_docs)], "doc_uri string")
        quota = [r.quota for r in evaluate.allot_evals(docs, n_evals).collect()]
        assert len(quota) == n_docs and sum(quota) == n_evals and max(quota) - min(quota) <= 1


def test_synthetic_questions(spark):
    docs = spark.createDataFrame([("a", "One. Two."), ("b", "")], "doc_uri string, content string")
    rows = evaluate.synthetic_evals(docs, 6).orderBy("doc_uri", "eval_no").collect()
    assert [(r.doc_uri, r.eval_no, r.expected_response) for r in rows] == [
        ("a", 0, "One."), ("a", 1, "Two."), ("a", 2, "One."), ("b", 0, ""), ("b", 1, ""), ("b", 2, "")]
    assert len({r.request_id for r in rows}) == 6

    def generator(prompts):
        assert all(p.startswith("be short\nDocument: ") for p in prompts)
        return ["Q?\nline one\nline two" for _ in prompts]

    made = evaluate.synthetic_evals(docs, 2, generator, "be short").first()
    assert (made.request, made.expected_response) == ("Q?", "line one\nline two")


EVALS = "eval_id string, expected_response string, expected_uris array<string>"
ANSWERS = "eval_id string, agent string, answer string, retrieved_uris array<string>"


@pytest.fixture(scope="module")
def scores(spark):
    evals = spark.createDataFrame([
        ("e1", "the red cat", ["a", "b"]), ("e2", "yes", None), ("e3", None, ["c"]), ("e4", None, None)], EVALS)
    answers = spark.createDataFrame([
        ("e1", "x", "the the cat sat", ["z", "b", "b", "y"]), ("e2", "x", " yes ", ["a"]), ("e3", "x", "no", []),
        ("e4", "x", "no", ["a"]),
        ("e1", "y", "", []), ("e2", "y", "no", ["a"]), ("e3", "y", "no", ["c"])], ANSWERS)
    return evaluate.score_answers(evals, answers)


def test_scores_by_hand(scores):
    rows = {(r.eval_id, r.agent): r for r in scores.collect()}
    one = rows["e1", "x"]
    assert (one.doc_recall, one.reciprocal_rank, one.exact_match) == (0.5, 0.5, 0)
    assert one.doc_precision == pytest.approx(1 / 3)
    assert one.token_f1 == pytest.approx(2 * 2 / (3 + 4))
    two = rows["e2", "x"]
    assert (two.doc_recall, two.doc_precision, two.reciprocal_rank) == (None, None, None)
    assert (two.exact_match, two.token_f1) == (1, 1.0)
    three = rows["e3", "x"]
    assert (three.doc_recall, three.doc_precision, three.reciprocal_rank) == (0.0, None, 0.0)
    assert (three.exact_match, three.token_f1) == (None, None)
    assert rows["e1", "y"].token_f1 == 0.0
    assert all(rows["e4", "x"][m] is None for m in evaluate.METRICS)


def test_summary_and_comparison(scores):
    summary = {r.agent: r for r in evaluate.summarise(scores).collect()}
    assert (summary["x"].n_questions, summary["x"].n_expected_response, summary["x"].n_expected_context) == (4, 2, 2)
    assert summary["x"].mean_doc_recall == 0.25 and summary["x"].mean_exact_match == 0.5
    delta = {r.eval_id: r for r in evaluate.compare_agents(scores, "x", "y").collect()}
    assert set(delta) == {"e1", "e2", "e3"}
    assert delta["e2"].delta_exact_match == 1 and delta["e3"].delta_doc_recall == -1.0


def test_judge(scores):
    judged = {(r.eval_id, r.agent): r for r in evaluate.judge_answers(scores).collect()}
    assert judged["e1", "x"].judge_score == pytest.approx(2 / 3, abs=1e-6)
    assert judged["e1", "x"].judge_rationale == "2 of 3 expected words found"

    def odd(cases):
        return ["not a number" for _ in cases]

    assert {r.judge_score for r in evaluate.judge_answers(scores, odd).collect()} == {None}


def test_evaluate_agents_job(spark):
    evals = spark.createDataFrame([("e1", "a", ["u"])], EVALS)
    one = spark.createDataFrame([("e1", "a", ["u"])], "eval_id string, answer string, retrieved_uris array<string>")
    rows, summary = jobs.evaluate_agents(evals, {"good": one, "bad": one.withColumn("answer", F.lit("b"))})
    assert rows.count() == 2
    assert {r.agent: r.mean_exact_match for r in summary.collect()} == {"good": 1.0, "bad": 0.0}


def test_reachable_rounds(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("b", "d"), ("x", "y"), ("a", "d")],
                                  "src string, dst string")
    seeds = spark.createDataFrame([("a",), ("a",)], "url string")
    assert {(r.url, r["round"]) for r in crawl.reachable_pages(edges, seeds).collect()} == {
        ("a", 0), ("b", 1), ("d", 1), ("c", 2)}
    stored = crawl.store_edges(edges, "t_edges", 4)
    assert crawl.reachable_pages(stored, seeds).count() == 4


def test_crawl_reports_missing_pages(spark):
    host = "https://s.example"
    pages = spark.createDataFrame([
        (f"{host}/", '<a href="/a">1</a><a href="https://evil.example/">2</a>'),
        (f"{host}/a", '<a href="/">1</a><a href="gone">2</a>'),
        (f"{host}/lonely", ""),
    ], "url string, html string")
    seeds = spark.createDataFrame([(f"{host}/",)], "url string")
    got = {r.url: (r["round"], r.status) for r in crawl.crawl(pages, seeds).collect()}
    assert got == {f"{host}/": (0, "SUCCESS"), f"{host}/a": (1, "SUCCESS"),
                   f"{host}/gone": (2, "ERROR: page not found")}


def test_saved_pages_are_files_that_can_be_scanned(spark, tmp_path):
    pages = spark.createDataFrame([
        ("https://s.example/a/b", "x"), ("https://s.example/a_b", "y"), ("https://s.example/", "z"), ("https://s.example/n", None),
        ("https://s.example/twice", "q"), ("https://s.example/twice", "p"), ("https://s.example/u", "é" * 100_000)],
        "url string, html string").repartition(4)
    for _ in range(2):  # again: the same files
        clash, = page_files.save_pages(pages, str(tmp_path / "pages")).collect()
    assert (clash.file_name, clash.n_urls, clash.first_url) == ("a_b.html", 2, "https://s.example/a/b")
    files = read_raw_files(spark, str(tmp_path / "pages"), "*.html").collect()
    assert {(f.path.rsplit("/", 1)[1], bytes(f.content).decode()) for f in files} == {
        ("a_b.html", "x"), ("home.html", "z"), ("twice.html", "p"), ("u.html", "é" * 100_000)}
    assert len(files) == 4 and os.path.getsize(tmp_path / "pages" / "n.html") == 0
    assert not [n for n in os.listdir(tmp_path / "pages") if "draft" in n]


def test_token_f1_in_the_row(spark):
    cases = [("a b c", "a b c"), ("a a b", "a b b"), ("x", "y"), ("", "y"), ("", ""), ("One TWO two", "two two two one"), ("é ß", "É")]

    def brute(expected, given):
        e, g = Counter(expected.lower().split()), Counter(given.lower().split())
        return 2 * (e & g).total() / (e.total() + g.total()) if e or g else 0.0

    df = spark.createDataFrame(cases, "e string, g string")
    got = {(r.e, r.g): r.f for r in df.select("e", "g", evaluate.token_f1(F.col("e"), F.col("g")).alias("f")).collect()}
    assert got == {c: pytest.approx(brute(*c)) for c in cases}


def test_scores_take_one_join(spark):
    evals = spark.createDataFrame([("1", "a b", ["u"])], "eval_id string, expected_response string, expected_uris array<string>")
    answers = spark.createDataFrame([("1", "x", "b c", ["v", "u"])], "eval_id string, agent string, answer string, retrieved_uris array<string>")
    scores = evaluate.score_answers(evals, answers)
    plan = scores._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1 and "Aggregate " not in plan and "Generate" not in plan
    assert scores.first().token_f1 == 0.5
