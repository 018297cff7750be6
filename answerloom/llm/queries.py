"""Registered queries of the subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from answerloom.llm import (
    bpe, circulant, decontaminate, edit_counts, filter_audit, jaccard, license_scan, merkle, mixing_lm, quality, token_files,
    toxicity, warc,
)

#: Id that op3 puts after each document.
END_ID = 2

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(function: Query) -> Query:
    REGISTRY[function.__name__] = function
    return function


def tokenizer_file(name: str) -> str:
    """Place of a public tokenizer's file, the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op2_quality_rules(spark, sf_dir):
    return quality.judge_documents(_table(spark, sf_dir, "documents"))


@query
def op7_warc(spark, sf_dir):
    return warc.archive_pages(_table(spark, sf_dir, "pages"))


@query
def op5_bpe(spark, sf_dir):
    return bpe.digest_documents(_table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


@query
def op3_token_files(spark, sf_dir):
    return token_files.write_and_read(_table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), END_ID)


@query
def op10_decontamination(spark, sf_dir):
    found = decontaminate.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.drop("mark")


@query
def op1_toxicity(spark, sf_dir):
    return toxicity.score_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@query
def op4_jaccard_join(spark, sf_dir):
    return jaccard.join_documents(_table(spark, sf_dir, "documents"))


@query
def op6_edit_counts(spark, sf_dir):
    return edit_counts.count_masked(_table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


@query
def op8_license_scan(spark, sf_dir):
    return license_scan.scan(_table(spark, sf_dir, "documents"))


@query
def op9_mixing_lm(spark, sf_dir):
    return mixing_lm.score_documents(_table(spark, sf_dir, "documents"))


@query
def op11_filter_audit(spark, sf_dir):
    return filter_audit.audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@query
def op12_merkle_manifest(spark, sf_dir):
    return merkle.verify_documents(_table(spark, sf_dir, "documents"))


@query
def op13_circulant_minhash(spark, sf_dir):
    return circulant.near_copies(_table(spark, sf_dir, "documents"))
