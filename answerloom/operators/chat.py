"""The chat chain over tables of requests or of conversation turns."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from answerloom.conf import ChatSettings
from answerloom.functions.text import fill_template, first_sentence
from answerloom.operators.cells import CellIndex
from answerloom.operators.embed import Embedder
from answerloom.operators.parse import SUCCESS
from answerloom.operators.ranking import top_k
from answerloom.operators.retrieve import search, search_with_failures
from answerloom.session import write_and_reload

# A model call on a batch: list of inputs to list of texts. In the chat chain it also
# receives the keywords max_tokens and temperature.
TextModel = Callable[[Sequence], Sequence[str]]
MESSAGE = "struct<role:string,content:string>"
# Roles that the prompt keeps from the history.
PROMPT_ROLES = ("user", "assistant")


# --- requests that hold their messages in one array -----------------------------------------


def split_messages(requests: DataFrame) -> DataFrame:
    """Add ``question`` (last message, whatever its role) and ``history`` (all before it)."""
    n = F.size("messages")
    return requests.withColumn("question", F.get("messages", n - 1).getField("content")).withColumn(
        "history", F.when(n > 1, F.slice("messages", F.lit(1), n - 1)).otherwise(F.array().cast(f"array<{MESSAGE}>"))
    )


def history_text(history: Column) -> Column:
    """The raw history, one ``role: text`` line per message."""
    return F.array_join(F.transform(history, lambda m: F.concat(m.role, F.lit(": "), m.content)), "\n")


def rewrite_prompt(template: str, history: Column, question: Column) -> Column:
    return fill_template(template, chat_history=history_text(history), question=question)


def prompt_history(history: Column) -> Column:
    """Messages of users and assistants only."""
    return F.filter(history, lambda m: m.role.isin(*PROMPT_ROLES))


def build_prompt(system_template: str, context: Column, history: Column, question: Column) -> Column:
    """Message array: system text with the context, filtered history, the question as asked."""

    def message(role: str, content: Column) -> Column:
        return F.array(F.struct(F.lit(role).alias("role"), content.alias("content")).cast(MESSAGE))

    return F.concat(
        message("system", fill_template(system_template, context=context)),
        prompt_history(history),
        message("user", question),
    )


ANSWERED = T.StructType([T.StructField("text", T.StringType()), T.StructField("status", T.StringType())])
MODEL_ROWS = 256
# What failed in a batch is asked again so many times, after a wait that doubles.
RETRIES = 2
WAIT_SECONDS = 0.1


def call_model(
    df: DataFrame, source: str, target: str, model: TextModel, rows: int = MODEL_ROWS, retries: int = RETRIES,
    wait: float = WAIT_SECONDS,
) -> DataFrame:
    """Run a model over one column in batches of at most ``rows``; adds ``target`` and ``<target>_status``.

    Only the one column travels to Python. A failed batch is halved until its bad inputs stand alone, so good ones
    are asked again a few times at most. The bad ones of a batch are asked again together after a wait, as a failure
    may pass; the last one is their status. A model with a method ``connect`` is connected once per task.
    """

    @F.arrow_udf(ANSWERED)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        connected = model.connect() if hasattr(model, "connect") else model

        def call(inputs: list) -> list[tuple[str | None, str]]:
            try:
                outputs = list(connected(inputs))
                if len(outputs) != len(inputs):
                    raise ValueError("the model returned another number of texts")
                return [(text, SUCCESS) for text in outputs]
            except Exception as error:
                if len(inputs) == 1:
                    return [(None, f"ERROR: {error}")]
                half = len(inputs) // 2
                return call(inputs[:half]) + call(inputs[half:])

        def persistent(inputs: list) -> list[tuple[str | None, str]]:
            done = call(inputs)
            for attempt in range(retries):
                failed = [i for i, (_, status) in enumerate(done) if status != SUCCESS]
                if not failed:
                    break
                time.sleep(wait * 2**attempt)
                for i, result in zip(failed, call([inputs[i] for i in failed])):
                    done[i] = result
            return done

        for batch in batches:
            done = [r for i in range(0, len(batch), rows) for r in persistent(batch.slice(i, rows).to_pylist())]
            texts, states = zip(*done, strict=True) if done else ((), ())
            yield pa.StructArray.from_arrays(
                [pa.array(texts, pa.string()), pa.array(states, pa.string())], ["text", "status"])

    return (
        df.withColumn("_called", run.asNondeterministic()(F.col(source)))
        .withColumn(target, F.col("_called.text"))
        .withColumn(f"{target}_status", F.col("_called.status"))
        .drop("_called")
    )


def with_search_query(
    requests: DataFrame, rewriter: TextModel | None = None, template: str = ChatSettings().rewrite_template
) -> DataFrame:
    """Add ``search_query`` and its status: rewritten if there is any history, else the question itself.

    Without a rewriter the previous message stands before the question.
    """
    has_history = F.size("history") > 0
    if rewriter is None:
        previous = F.get("history", F.size("history") - 1).getField("content")
        return requests.withColumn(
            "search_query",
            F.when(has_history, F.concat_ws(" ", previous, F.col("question"))).otherwise(F.col("question")),
        ).withColumn("search_query_status", F.lit(SUCCESS))
    prompt = F.when(has_history, rewrite_prompt(template, F.col("history"), F.col("question")))
    prompted = requests.withColumn("_rewrite_prompt", prompt)
    # Only requests with a history are sent to the model.
    plain = prompted.filter(F.col("_rewrite_prompt").isNull()).withColumn("search_query", F.col("question")).withColumn(
        "search_query_status", F.lit(SUCCESS))
    rewritten = call_model(
        prompted.filter(F.col("_rewrite_prompt").isNotNull()), "_rewrite_prompt", "search_query", rewriter
    )
    return plain.unionByName(rewritten).drop("_rewrite_prompt")


# --- conversations as rows ------------------------------------------------------------------


def split_turns(turns: DataFrame) -> DataFrame:
    """One row per conversation: question, previous message, number of earlier messages.

    Needs the last two turns and a count only, both combined before the shuffle,
    so the length of a conversation does not matter.
    """
    ends = top_k(turns, ["conv_id"], [F.desc("turn")], 2, "_back")
    last_two = ends.groupBy("conv_id").agg(
        F.max(F.when(F.col("_back") == 1, F.col("text"))).alias("question"),
        F.max(F.when(F.col("_back") == 2, F.col("text"))).alias("previous_message"),
    )
    counts = turns.groupBy("conv_id").agg((F.count(F.lit(1)) - 1).alias("n_history"))
    return last_two.join(counts, "conv_id")


def last_turns(turns: DataFrame) -> DataFrame:
    return turns.groupBy("conv_id").agg(F.max("turn").alias("last_turn"))


def history_rows(turns: DataFrame) -> DataFrame:
    """All turns before the current question, as rows; nothing is gathered per conversation."""
    return turns.join(last_turns(turns), "conv_id").filter(F.col("turn") < F.col("last_turn")).drop("last_turn")


def prompt_rows(turns: DataFrame, contexts: DataFrame, system_template: str) -> DataFrame:
    """The prompt of each conversation as rows (conv_id, position, role, content).

    Position -1 is the system text, with an empty context where there is none; history and question keep their
    turn number, and the question gets the role ``user``.
    """
    marked = turns.join(last_turns(turns), "conv_id").withColumn("_last", F.col("turn") == F.col("last_turn"))
    kept = marked.filter(F.col("_last") | F.col("role").isin(*PROMPT_ROLES)).select(
        "conv_id",
        F.col("turn").alias("position"),
        F.when(F.col("_last"), "user").otherwise(F.col("role")).alias("role"),
        F.col("text").alias("content"),
    )
    every = last_turns(turns).select("conv_id").join(contexts.select("conv_id", "context"), "conv_id", "left")
    system = every.withColumn("context", F.coalesce("context", F.lit(""))).select(
        "conv_id",
        F.lit(-1).cast("bigint").alias("position"),
        F.lit("system").alias("role"),
        fill_template(system_template, context=F.col("context")).alias("content"),
    )
    return system.unionByName(kept)


def rewrite_prompt_rows(turns: DataFrame, template: str) -> DataFrame:
    """The rewrite prompt of each conversation with a history, as rows (conv_id, position, content).

    The contents in the order of their positions make up the prompt: what stands before the history at position -1, a
    line for each earlier turn at its number, the rest at the number of the question.
    """
    if template.count("{chat_history}") != 1:
        raise ValueError("the rewrite template needs one slot {chat_history}")
    before, after = template.split("{chat_history}")
    ends = turns.groupBy("conv_id").agg(F.min("turn").alias("first_turn"), F.max("turn").alias("last_turn"))
    marked = turns.join(ends.filter("first_turn < last_turn"), "conv_id")
    line = F.concat(F.when(F.col("turn") > F.col("first_turn"), "\n").otherwise(""), "role", F.lit(": "), F.coalesce("text", F.lit("")))
    question = F.col("turn") == F.col("last_turn")
    rows = marked.select("conv_id", F.col("turn").alias("position"), F.when(
        question, fill_template(after, question=F.col("text"))).otherwise(line).alias("content"))
    head = marked.filter(question).select("conv_id", F.lit(-1).cast("bigint").alias("position"), fill_template(
        before, question=F.col("text")).alias("content"))
    return head.unionByName(rows)


def prompt_sizes(turns: DataFrame) -> DataFrame:
    """(conv_id, n_prompt_messages): the messages of each prompt, with system text and question; counted, not gathered."""
    shown = history_rows(turns).filter(F.col("role").isin(*PROMPT_ROLES)).groupBy("conv_id").agg(F.count(F.lit(1)).alias("_shown"))
    return last_turns(turns).select("conv_id").join(shown, "conv_id", "left").select(
        "conv_id", (F.lit(2) + F.coalesce("_shown", F.lit(0))).cast("bigint").alias("n_prompt_messages"))


# A model reads one prompt at a time: the most characters that a conversation may have to be put into one.
PROMPT_CHARS = 1_000_000


def gathered(rows: DataFrame, value: Column, name: str, most_chars: int = PROMPT_CHARS) -> DataFrame:
    """(conv_id, ``name``, status): the values of each conversation's rows in an array, by position.

    Conversations are measured first. Those above the bound are never put together: they keep a row with an error
    status, so no task holds more than one prompt of bounded size at a time.
    """
    sizes = rows.groupBy("conv_id").agg(
        F.sum(F.length(F.coalesce("content", F.lit(""))) + 1).alias("_chars"))
    sizes = write_and_reload(sizes, "prompt-sizes")
    over = sizes.filter(F.col("_chars") > most_chars).select("conv_id")
    listed = F.sort_array(F.collect_list(F.struct(F.col("position").alias("p"), value.alias("v"))))
    fitting = rows.join(over, "conv_id", "left_anti").groupBy("conv_id").agg(F.transform(listed, lambda r: r.v).alias(name))
    too_long = sizes.filter(F.col("_chars") > most_chars).select(
        "conv_id", F.lit(None).cast(fitting.schema[name].dataType).alias(name),
        F.format_string(f"ERROR: prompt of %d characters, the most are {most_chars}", "_chars").alias("status"))
    return fitting.withColumn("status", F.lit(SUCCESS)).unionByName(too_long)


def with_turn_search_query(
    split: DataFrame, turns: DataFrame | None = None, rewriter: TextModel | None = None,
    template: str = ChatSettings().rewrite_template, most_chars: int = PROMPT_CHARS,
) -> DataFrame:
    """``search_query`` for split turns: previous message and question, or the question alone.

    With a rewriter, which needs the turns, conversations with a history get its answer to their rewrite prompt, and
    ``search_query_status``.
    """
    if rewriter is None:
        return split.withColumn(
            "search_query",
            F.when(F.col("n_history") > 0, F.concat_ws(" ", "previous_message", "question")).otherwise(F.col("question")),
        )
    prompts = gathered(rewrite_prompt_rows(turns, template), F.col("content"), "_parts", most_chars)
    prompts = prompts.select("conv_id", F.array_join("_parts", "").alias("_prompt"), "status")
    asked = call_model(prompts.filter(F.col("status") == SUCCESS).drop("status"), "_prompt", "search_query", rewriter)
    asked = asked.select("conv_id", "search_query", "search_query_status").unionByName(prompts.filter(
        F.col("status") != SUCCESS).select("conv_id", F.lit(None).cast("string").alias("search_query"),
                                           F.col("status").alias("search_query_status")))
    alone = split.filter(F.col("n_history") == 0).withColumn("search_query", F.col("question")).withColumn(
        "search_query_status", F.lit(SUCCESS))
    return split.filter(F.col("n_history") > 0).join(asked, "conv_id").unionByName(alone)


# --- context and answers --------------------------------------------------------------------


def build_context(hits: DataFrame, template: str, query_key: str = "query_id") -> DataFrame:
    """One context per query: its k hits by template, in rank order, without separator.

    ``hits`` holds at most k rows per query. ``top_chunk`` is the text of the best hit.
    """
    formatted = hits.select(
        query_key,
        F.struct(
            "rank",
            fill_template(template, chunk_text=F.col("chunk_text"), document_uri=F.col("document_uri")).alias("part"),
            F.col("chunk_text").alias("text"),
            F.col("document_uri").alias("uri"),
        ).alias("_hit"),
    )
    gathered = formatted.groupBy(query_key).agg(F.sort_array(F.collect_list("_hit")).alias("_hits"))
    return gathered.select(
        query_key,
        F.array_join(F.transform("_hits", lambda h: h.part), "").alias("context"),
        F.get("_hits", 0).getField("text").alias("top_chunk"),
        F.transform("_hits", lambda h: h.uri).alias("retrieved_uris"),
    )


def extractive_answer(top_chunk: Column) -> Column:
    """Offline answer: the first sentence of the best chunk."""
    return F.coalesce(first_sentence(top_chunk), F.lit(""))


def answer_turns(
    turns: DataFrame,
    index: DataFrame | CellIndex,
    settings: ChatSettings,
    embedder: Embedder | None = None,
    rewriter: TextModel | None = None,
    generator: TextModel | None = None,
    most_chars: int = PROMPT_CHARS,
) -> DataFrame:
    """Answer the last turn of every conversation: search query, context, prompt, answer.

    Turns stay rows. Only for a rewriter or a generator, which read whole prompts, the turns of a conversation are put
    together, and only up to ``most_chars``; longer ones keep their row with a status. Without these plugs the query is
    previous message and question, and the answer the first sentence of the best chunk.
    """
    limits = {"max_tokens": settings.max_tokens, "temperature": settings.temperature}
    split = split_turns(turns)
    if rewriter is None and generator is None:
        asked = with_turn_search_query(split)
        hits = search(asked, index, settings.retriever, embedder, "conv_id", "search_query")
        contexts = build_context(hits, settings.retriever.chunk_template, "conv_id")
        return asked.join(contexts, "conv_id", "left").withColumn("answer", extractive_answer(F.col("top_chunk")))

    if rewriter is None:
        asked = with_turn_search_query(split).withColumn("search_query_status", F.lit(SUCCESS))
    else:
        asked = with_turn_search_query(split, turns, partial(rewriter, **limits), settings.rewrite_template, most_chars)
    asked = write_and_reload(asked, "turn-queries")  # models are not asked twice
    made = asked.filter(F.col("search_query_status") == SUCCESS)
    hits, failed = search_with_failures(made, index, settings.retriever, embedder, "conv_id", "search_query")
    contexts = build_context(hits, settings.retriever.chunk_template, "conv_id")
    found = asked.join(contexts, "conv_id", "left").join(
        failed.withColumnRenamed("status", "_search_failure"), "conv_id", "left").withColumn(
        "search_query_status", F.coalesce("_search_failure", "search_query_status")).drop("_search_failure")
    sound = F.col("search_query_status") == SUCCESS
    if generator is None:
        return found.withColumn("answer", F.when(sound, extractive_answer(F.col("top_chunk")))).withColumn(
            "answer_status", F.col("search_query_status"))
    found = write_and_reload(found, "turn-contexts")
    rows = prompt_rows(turns, found.select("conv_id", "context"), settings.system_template).join(
        found.filter(sound).select("conv_id"), "conv_id", "left_semi")
    prompts = gathered(rows, F.struct("role", "content"), "prompt", most_chars)
    answers = call_model(prompts.filter(F.col("status") == SUCCESS), "prompt", "answer", partial(generator, **limits))
    answers = answers.select("conv_id", "answer", "answer_status").unionByName(prompts.filter(
        F.col("status") != SUCCESS).select("conv_id", F.lit(None).cast("string").alias("answer"),
                                           F.col("status").alias("answer_status")))
    return found.join(answers, "conv_id", "left").withColumn(
        "answer_status", F.coalesce("answer_status", "search_query_status"))


def answer_requests(
    requests: DataFrame,
    index: DataFrame | CellIndex | None,
    settings: ChatSettings,
    request_key: str = "request_id",
    rewriter: TextModel | None = None,
    generator: TextModel | None = None,
    embedder: Embedder | None = None,
) -> DataFrame:
    """The whole chain for requests with a ``messages`` array: search query, context, prompt, answer.

    Splitting a request is local to its row. With a rewriter or a generator the
    part before the model call is written once, so that no model call repeats.
    Without an index the agent answers from the question alone.
    """
    limits = {"max_tokens": settings.max_tokens, "temperature": settings.temperature}
    rewriter = partial(rewriter, **limits) if rewriter is not None else None
    generator = partial(generator, **limits) if generator is not None else None
    asked = with_search_query(split_messages(requests), rewriter, settings.rewrite_template)
    if rewriter is not None:
        asked = write_and_reload(asked, "search-queries")
    if index is None:
        with_context = (
            asked.withColumn("context", F.lit(""))
            .withColumn("top_chunk", F.lit(None).cast("string"))
            .withColumn("retrieved_uris", F.array().cast("array<string>"))
        )
    else:
        # a query that was not made is not searched; one that could not be embedded comes back with its status
        made = asked.filter(F.col("search_query_status") == SUCCESS)
        hits, failed = search_with_failures(made, index, settings.retriever, embedder, request_key, "search_query")
        contexts = build_context(hits, settings.retriever.chunk_template, request_key)
        with_context = asked.join(contexts, request_key, "left").join(
            failed.withColumnRenamed("status", "_search_failure"), request_key, "left").withColumn(
            "search_query_status", F.coalesce("_search_failure", "search_query_status")).drop("_search_failure")
    prompted = with_context.withColumn(
        "prompt",
        build_prompt(
            settings.system_template, F.coalesce("context", F.lit("")), F.col("history"), F.col("question")
        ),
    )
    sound = F.col("search_query_status") == SUCCESS
    if generator is not None:
        # written once: the generator is asked about sound requests only, the others keep their status
        prompted = write_and_reload(prompted, "prompts")
        answered = call_model(prompted.filter(sound), "prompt", "answer", generator)
        return answered.unionByName(prompted.filter(~sound).withColumn("answer", F.lit(None).cast("string")).withColumn(
            "answer_status", F.col("search_query_status")))
    answer = extractive_answer(F.col("top_chunk")) if index is not None else first_sentence(F.col("question"))
    return prompted.withColumn("answer", F.when(sound, answer)).withColumn("answer_status", F.col("search_query_status"))
