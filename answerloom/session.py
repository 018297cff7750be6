"""Shared folders for written tables and checkpoints."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a fresh local one only in local mode."""
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if root is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        root = tempfile.mkdtemp(prefix="answerloom-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return root


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder path below the shared root that no other run uses."""
    return f"{shared_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def write_and_reload(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write a frame once as Parquet in the shared folder and read it back.

    Cuts the lineage, keeps column pruning for every later reader, and survives
    the loss of executors.
    """
    spark = df.sparkSession
    folder = new_folder(spark, name)
    df.write.parquet(folder, compression=compression)
    return spark.read.schema(df.schema).parquet(folder)


def reliable_checkpoint(df: DataFrame) -> DataFrame:
    shared_root(df.sparkSession)
    return df.checkpoint(eager=True)
