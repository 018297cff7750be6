"""The stages as jobs over tables; each can start from a table written elsewhere."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from answerloom.conf import ChunkSettings
from answerloom.operators.chunk import (
    LengthMeasure, length_measure, accepted_chunks, rejected_chunks, stage_recursive, with_chunk_id,
)
from answerloom.operators.evaluate import score_answers, summarise
from answerloom.operators.feedback import evaluation_set
from answerloom.operators.parse import BytesParser, accepted, rejected, run_report, stage_parse
from answerloom.session import write_and_reload
from answerloom.sources.files import overwrite_table, read_raw_files


@dataclass(frozen=True)
class StageResult:
    accepted: DataFrame
    rejected: DataFrame
    report: DataFrame


def load_job(spark: SparkSession, source: str, glob: str, table: str) -> DataFrame:
    """Files to the raw table; fails if there are none."""
    return overwrite_table(read_raw_files(spark, source, glob), table)


def _finish(name: str, good: DataFrame, bad: DataFrame, table: str) -> StageResult:
    done = overwrite_table(good, table)
    quarantine = overwrite_table(bad, f"{table}_rejected")
    return StageResult(done, quarantine, run_report(**{name: done, f"{name}_rejected": quarantine}))


def parse_job(raw: DataFrame, table: str, parser: str | BytesParser = "html") -> StageResult:
    """Parse once into a staging table; accepted and rejected rows are both read from it."""
    staged = write_and_reload(stage_parse(raw, parser), "parse-staging")
    return _finish("parse", accepted(staged), rejected(staged), table)


def chunk_job(
    parsed: DataFrame, table: str, settings: ChunkSettings, measure: LengthMeasure | None = None
) -> StageResult:
    """Chunk once into a staging table, then write the chunks with their ids.

    Lengths are measured as the settings say, or by the measure given. A tokenizer that the settings name and that
    cannot be had fails the job at its start. The report also counts the documents that gave no chunk.
    """
    measure = measure or length_measure(settings.measure, settings.measure_name)
    docs = parsed.select("path", F.col("doc_parsed_contents.parsed_content").alias("parsed_content"))
    staged = write_and_reload(stage_recursive(docs, settings.size, settings.overlap, measure), "chunk-staging")
    chunks = with_chunk_id(accepted_chunks(staged)).select("path", "chunked_text", "chunk_id", "chunk_pos")
    result = _finish("chunk", chunks, rejected_chunks(staged), table)
    refused = result.rejected.select("path").distinct()
    silent = docs.select("path").join(result.accepted.select("path").distinct(), "path", "left_anti").join(
        refused, "path", "left_anti")
    empty = run_report(chunk_empty=silent)
    return StageResult(result.accepted, result.rejected, result.report.unionByName(empty))


def evaluation_set_job(
    requests: DataFrame, clicks: DataFrame, table: str, ties: Sequence[str] = ("step_id",),
    request_id: str = "request_id", fmt: str = "parquet",
) -> DataFrame:
    """Both logs to the evaluation table."""
    return overwrite_table(evaluation_set(requests, clicks, ties, request_id), table, fmt)


def evaluate_agents(evals: DataFrame, agents: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Scores per question and their summary for answers of several agents to the same questions.

    The answers are written once, so that no agent runs twice.
    """
    answers = reduce(
        DataFrame.unionByName,
        (a.withColumn("agent", F.lit(name)).select("eval_id", "agent", "answer", "retrieved_uris")
         for name, a in agents.items()),
    )
    scores = score_answers(evals, write_and_reload(answers, "answers"))
    return scores, summarise(scores)
