from pyspark.sql import functions as F

from answerloom.conf import ChatSettings, RetrieverSettings
from answerloom.operators import chat, index

REQUESTS = "request_id string, messages array<struct<role:string,content:string>>"
SETTINGS = ChatSettings(retriever=RetrieverSettings(k=2, query_type="exact"))


def small_index(spark):
    chunks = spark.createDataFrame([
        ("fruit", "Pears are green. They are sweet."), ("sky", "The sky is blue. It is wide."),
        ("tool", "A hammer drives nails. It is heavy."),
    ], "path string, chunked_text string").withColumn("chunk_id", F.md5("chunked_text"))
    return index.build_index(chunks)


def requests(spark):
    return spark.createDataFrame([
        ("one", [("user", "why is the sky blue")]),
        ("sys", [("system", "be brief"), ("user", "are pears green")]),
        ("long", [("user", "talk about pears"), ("assistant", "yes {question}"), ("tool", "x"), ("user", "and {context}?")]),
        ("odd", [("user", "q"), ("assistant", "last message wins")]),
    ], REQUESTS)


def test_split_and_history(spark):
    rows = {r.request_id: r for r in chat.split_messages(requests(spark)).collect()}
    assert rows["one"].question == "why is the sky blue" and rows["one"].history == []
    assert [m.role for m in rows["long"].history] == ["user", "assistant", "tool"]
    assert rows["odd"].question == "last message wins"


def test_rewrite_only_with_history(spark):
    seen = []

    def rewriter(prompts):
        seen.extend(prompts)
        return [p.upper() for p in prompts]

    rows = {r.request_id: r.search_query for r in
            chat.with_search_query(chat.split_messages(requests(spark)), rewriter).collect()}
    assert rows["one"] == "why is the sky blue"
    assert "CHAT HISTORY: SYSTEM: BE BRIEF" in rows["sys"]
    assert "YES {QUESTION}" in rows["long"] and rows["long"].endswith("QUESTION: AND {CONTEXT}?")
    offline = {r.request_id: r.search_query for r in chat.with_search_query(chat.split_messages(requests(spark))).collect()}
    assert offline["sys"] == "be brief are pears green" and offline["one"] == "why is the sky blue"


def test_whole_chain_with_a_generator(spark):
    def generator(prompts, max_tokens, temperature):
        assert (max_tokens, temperature) == (1500, 0.01)
        assert all(p[0]["role"] == "system" and p[-1]["role"] == "user" for p in prompts)
        if any("and {context}" in p[-1]["content"] for p in prompts):
            raise ValueError("refused")
        return [str(len(p)) for p in prompts]

    rows = {r.request_id: r for r in
            chat.answer_requests(requests(spark), small_index(spark), SETTINGS, generator=generator).collect()}
    assert rows["one"].answer == "2" and rows["one"].answer_status == "SUCCESS"
    assert rows["sys"].answer == "2"  # a system turn triggers the rewrite but stays out of the prompt
    assert rows["long"].answer is None and rows["long"].answer_status == "ERROR: refused"
    assert rows["one"].context.startswith("Passage: The sky is blue. It is wide.\nPassage: ")
    assert rows["one"].prompt[0].content.endswith("Context: " + rows["one"].context)
    assert [m.role for m in rows["long"].prompt] == ["system", "user", "assistant", "user"]
    assert rows["long"].prompt[-1].content == "and {context}?"


def test_offline_chain_and_plain_agent(spark):
    done = {r.request_id: r for r in chat.answer_requests(requests(spark), small_index(spark), SETTINGS).collect()}
    assert done["one"].answer == "The sky is blue." and done["one"].retrieved_uris[0] == "sky"
    plain = {r.request_id: r for r in chat.answer_requests(requests(spark), None, SETTINGS).collect()}
    assert plain["one"].answer == "why is the sky blue" and plain["one"].retrieved_uris == []


def test_turn_rows_agree_with_message_arrays(spark):
    data = requests(spark)
    turns = data.select(F.col("request_id").alias("conv_id"), F.posexplode("messages").alias("turn", "m")).select(
        "conv_id", F.col("turn").cast("bigint").alias("turn"), "m.role", F.col("m.content").alias("text"))
    split = {r.conv_id: r for r in chat.with_turn_search_query(chat.split_turns(turns)).collect()}
    arrays = {r.request_id: r for r in chat.with_search_query(chat.split_messages(data)).collect()}
    for key, row in arrays.items():
        assert (split[key].question, split[key].search_query, split[key].n_history) == (
            row.question, row.search_query, len(row.history))
    history = {(r.conv_id, r.turn) for r in chat.history_rows(turns).collect()}
    assert history == {(k, i) for k, r in arrays.items() for i in range(len(r.history))}
    by_rows = {r.conv_id: r.answer for r in chat.answer_turns(turns, small_index(spark), SETTINGS).collect()}
    by_arrays = {r.request_id: r.answer for r in chat.answer_requests(data, small_index(spark), SETTINGS).collect()}
    assert by_rows == by_arrays
    contexts = turns.select("conv_id").distinct().withColumn("context", F.lit("C"))
    prompt = chat.prompt_rows(turns, contexts, "S {context}").filter("conv_id = 'long'").orderBy("position").collect()
    assert [(r.role, r.content) for r in prompt] == [
        ("system", "S C"), ("user", "talk about pears"), ("assistant", "yes {question}"), ("user", "and {context}?")]


TURNS = "conv_id long, turn long, role string, text string"


def conversation_rows():
    return [(1, 0, "user", "why is the sky blue"), (2, 0, "system", "be brief"), (2, 1, "user", "are pears {green}"),
            (3, 0, "user", "talk about pears"), (3, 1, "assistant", "yes {question}"), (3, 2, "tool", "x"), (3, 3, "user", "and nails?"),
            (4, 0, "user", "long " * 200), (4, 1, "user", "and the sky?")]


def plugs():
    """A rewriter and a generator, as local functions, which travel to the tasks by value."""

    def shouting(prompts, **_):
        return [p.rsplit("\n", 1)[-1].upper() for p in prompts]

    def counting(prompts, **_):
        return [" | ".join(f"{m['role']}={m['content'][-12:]}" for m in p) for p in prompts]

    return shouting, counting


def test_turns_and_requests_go_through_the_same_chain(spark):
    turns = spark.createDataFrame(conversation_rows(), TURNS).repartition(3)
    requests = [(c, [(r, t) for i, _, r, t in conversation_rows() if i == c]) for c in (1, 2, 3, 4)]
    requests = spark.createDataFrame(requests, REQUESTS.replace("request_id string", "request_id long"))
    documents = small_index(spark)
    shouting, counting = plugs()
    for rewriter, generator in ((shouting, counting), (shouting, None), (None, counting)):
        by_rows = chat.answer_turns(turns, documents, SETTINGS, rewriter=rewriter, generator=generator)
        whole = chat.answer_requests(requests, documents, SETTINGS, rewriter=rewriter, generator=generator)
        columns = ["search_query", "context", "answer", "answer_status"]
        assert {tuple(r) for r in by_rows.select("conv_id", *columns).collect()} == {
            tuple(r) for r in whole.select("request_id", *columns).collect()}


def test_conversations_above_the_bound_keep_a_row_with_a_status(spark):
    turns = spark.createDataFrame(conversation_rows(), TURNS)
    shouting, counting = plugs()
    done = {r.conv_id: r for r in chat.answer_turns(
        turns, small_index(spark), SETTINGS, rewriter=shouting, generator=counting, most_chars=900).collect()}
    assert done[4].answer is None and done[4].answer_status.startswith("ERROR: prompt of ")
    assert all(done[c].answer_status == "SUCCESS" for c in (1, 2, 3))


def test_prompt_rows_make_up_the_prompt(spark):
    turns = spark.createDataFrame(conversation_rows(), TURNS)
    rows = chat.rewrite_prompt_rows(turns, "Q {question} H {chat_history} again {question}").orderBy("conv_id", "position").collect()
    made = {c: "".join(r.content for r in rows if r.conv_id == c) for c in (1, 2, 3)}
    assert made[1] == "" and made[2] == "Q are pears {green} H system: be brief again are pears {green}"
    assert made[3].startswith("Q and nails? H user: talk about pears\nassistant: yes {question}\ntool: x again")


def test_failures_that_pass_are_no_status(spark, tmp_path):
    path = str(tmp_path / "seen")

    def flaky(inputs):
        """Fails the first time that it sees an input; the file keeps what it has seen."""
        with open(path, "a+") as seen:
            seen.seek(0)
            known = set(seen.read().split("\n"))
            seen.writelines(f"{x}\n" for x in inputs)
        if any(x not in known or x == "bad" for x in inputs):
            raise ValueError("not now")
        return [x.upper() for x in inputs]

    df = spark.createDataFrame([("a",), ("b",), ("bad",)], "q string").coalesce(1)
    done = {r.q: r for r in chat.call_model(df, "q", "answer", flaky, wait=0.01).collect()}
    assert (done["a"].answer, done["a"].answer_status) == ("A", "SUCCESS") and done["bad"].answer_status == "ERROR: not now"


def test_one_bad_text_does_not_send_the_others_one_by_one(spark, tmp_path):
    from answerloom.operators.embed import HashedWords, embed

    calls = str(tmp_path / "calls")

    def refusing(texts):
        with open(calls, "a") as out:
            out.write("x")
        if "bad" in texts:
            raise ValueError("no")
        return HashedWords(16)(texts)

    df = spark.createDataFrame([("bad" if i == 700 else f"text {i}",) for i in range(2000)], "t string").coalesce(1)
    done = embed(df, "t", refusing).groupBy("embed_status").count().collect()
    assert {tuple(r) for r in done} == {("SUCCESS", 1999), ("ERROR: no", 1)}
    assert len(open(calls).read()) < 60
