"""Corpus cleaning from documents to token ids, each stage written as Parquet and read again by the next.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it kept. All but the last return the
columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from answerloom.llm import bpe, decontaminate, jaccard, quality, toxicity
from answerloom.llm.queries import tokenizer_file
from answerloom.session import write_and_reload


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines go from the texts; documents that lose too much of theirs go as a whole."""
    return quality.clean_documents(docs)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier predicts as toxic go. It is trained on the labelled rows of all documents."""
    model = toxicity.train(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.drop_toxic(docs, model)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies the document with the smallest id stays."""
    return jaccard.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold passages of the benchmark go."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the decoded texts."""
    return bpe.digest_documents(docs, tokenizer_file("word_bpe_49k.json"))


STAGES = [
    ("quality rules", quality_stage),
    ("toxicity", toxicity_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("BPE encoding and decoding", encoding_stage),
]

ORACLE_SQL = None  # neither the classifier nor the tokenizer has an SQL form; tests hold it to brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = write_and_reload(docs, f"stage-{number}")
    return docs
