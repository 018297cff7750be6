"""Reading raw files and log tables, writing tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class EmptySourceError(ValueError):
    """The source folder holds no matching file."""


def read_raw_files(spark: SparkSession, path: str, glob: str) -> DataFrame:
    """All files below a folder whose name matches, as (path, modificationTime, length, content)."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .load(path)
    )
    return require_rows(files, f"no file below {path} matches {glob}")


def require_rows(df: DataFrame, message: str) -> DataFrame:
    """Fail early on empty input; looks at one row only."""
    if df.isEmpty():
        raise EmptySourceError(message)
    return df


def spread(df: DataFrame) -> DataFrame:
    """Use all cores for a scan that has fewer splits than there are cores.

    Spark cuts files into splits of 4 MB or more until every core has one, so this
    only moves inputs of a few megabytes per core; larger ones are left as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.isStreaming or df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores)


def raw_from_pages(pages: DataFrame) -> DataFrame:
    """A table of stored pages (url, html) in the shape of raw files."""
    content = F.encode("html", "UTF-8")
    return pages.select(
        F.col("url").alias("path"),
        F.lit(None).cast("timestamp").alias("modificationTime"),
        F.octet_length("html").cast("bigint").alias("length"),
        content.alias("content"),
    )


def overwrite_table(df: DataFrame, table: str, fmt: str = "parquet") -> DataFrame:
    """Replace a managed table with its schema, and read it back as a cut in the lineage."""
    (
        df.write.format(fmt)
        .mode("overwrite")
        .option("overwriteSchema", "true")
        .saveAsTable(table)
    )
    return df.sparkSession.table(table)


def quoted(*parts: str) -> str:
    """A table name with every part in back-ticks."""
    return ".".join("`" + part.replace("`", "``") + "`" for part in parts if part)


def load_feedback_logs(
    spark: SparkSession, catalog: str, schema: str, payload_table: str
) -> tuple[DataFrame, DataFrame]:
    """The request log and the assessment log that belong to a payload table."""
    return (
        spark.table(quoted(catalog, schema, f"{payload_table}_request_logs")),
        spark.table(quoted(catalog, schema, f"{payload_table}_assessment_logs")),
    )


def documents_for_evaluation(spark: SparkSession, parsed_table: str) -> DataFrame:
    """Document address and text of a parsed table, for the synthetic questions."""
    return spark.sql(
        "select path as doc_uri, doc_parsed_contents.parsed_content as content from "
        + quoted(*parsed_table.replace("`", "").split("."))
    )
