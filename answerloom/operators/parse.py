"""Raw files to parsed documents, with failed files kept apart."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from answerloom.functions.markup import html_to_markdown
from answerloom.functions.text import utf8_text

SUCCESS = "SUCCESS"
PARSING = T.StructType([
    T.StructField("doc_parsed_contents", T.MapType(T.StringType(), T.StringType())),
    T.StructField("parser_status", T.StringType()),
])

BytesParser = Callable[[bytes], Mapping[str, str]]


def parse_html(content: Column) -> Column:
    """Struct of contents and status for one HTML file; a bad file yields an error status."""
    text = html_to_markdown(utf8_text(content))
    # One-element transform: the text is built once and used for content and length.
    contents = F.get(
        F.transform(
            F.array(text),
            lambda t: F.create_map(
                F.lit("num_pages"), F.coalesce(F.length(t).cast("string"), F.lit("")),
                F.lit("parsed_content"), F.coalesce(t, F.lit("")),
            ),
        ),
        0,
    )
    status = (
        F.when(content.isNull(), "ERROR: no content")
        .when(F.is_valid_utf8(content.cast("string")), SUCCESS)
        .otherwise("ERROR: content is not valid utf-8")
    )
    return F.struct(contents.alias("doc_parsed_contents"), status.alias("parser_status"))


def with_parser(raw: DataFrame, parser: BytesParser, content: str = "content") -> DataFrame:
    """Run a caller-supplied parser over Arrow batches of the content; an exception becomes the row's status."""

    def one(value: bytes | None) -> dict:
        try:
            if value is None:
                raise ValueError("no content")
            fields = [(str(k), str(v)) for k, v in parser(bytes(value)).items()]
            return {"doc_parsed_contents": fields, "parser_status": SUCCESS}
        except Exception as error:
            empty = [("num_pages", ""), ("parsed_content", "")]
            return {"doc_parsed_contents": empty, "parser_status": f"ERROR: {error}"}

    kind = pa.struct([("doc_parsed_contents", pa.map_(pa.string(), pa.string())), ("parser_status", pa.string())])

    @F.arrow_udf(PARSING)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([one(v) for v in batch.to_pylist()], kind)

    return raw.withColumn("parsing", run.asNondeterministic()(F.col(content))).drop(content)


def pages_parser(read_pages: Callable[[bytes], list[str]]) -> BytesParser:
    """Turn a reader of page texts into a parser: pages joined by newlines, and counted."""

    def parse(content: bytes) -> Mapping[str, str]:
        pages = read_pages(content)
        return {"num_pages": str(len(pages)), "parsed_content": "\n".join(pages)}

    return parse


def stage_parse(raw: DataFrame, parser: str | BytesParser = "html") -> DataFrame:
    """Raw files without their bytes, plus the ``parsing`` struct."""
    if parser == "html":
        return raw.withColumn("parsing", parse_html(F.col("content"))).drop("content")
    if callable(parser):
        return with_parser(raw, parser)
    raise ValueError(f"unknown parser {parser!r}")


def accepted(staged: DataFrame) -> DataFrame:
    return (
        staged.filter(F.col("parsing.parser_status") == SUCCESS)
        .withColumn("doc_parsed_contents", F.col("parsing.doc_parsed_contents"))
        .drop("parsing")
    )


def rejected(staged: DataFrame) -> DataFrame:
    """The quarantine rows: failed or unknown status, never silently dropped."""
    return (
        staged.filter(~F.col("parsing.parser_status").eqNullSafe(SUCCESS))
        .withColumn("status", F.col("parsing.parser_status"))
        .drop("parsing")
    )


def parse_documents(raw: DataFrame, parser: str | BytesParser = "html") -> tuple[DataFrame, DataFrame]:
    """Parsed documents and rejected files.

    With the built-in parser the reject filter only needs the encoding check. A
    Python parser would run once per reader, so write ``stage_parse`` to a table
    first (``plans.jobs.parse_job`` does).
    """
    staged = stage_parse(raw, parser)
    return accepted(staged), rejected(staged)


def assemble_pages(page_rows: DataFrame, block: int = 512) -> DataFrame:
    """Documents from their page rows (path, page_no, text), pages joined by newlines in order.

    Pages are first joined in blocks of consecutive numbers, so that a document
    with very many pages is put together by many tasks; the last step only sees
    one string per block. A missing page text counts as an empty page.
    """
    blocks = (
        page_rows.withColumn("_block", F.floor(F.col("page_no") / block))
        .groupBy("path", "_block")
        .agg(_joined("page_no", F.coalesce("text", F.lit(""))).alias("_text"), F.count(F.lit(1)).alias("_pages"))
    )
    return blocks.groupBy("path").agg(
        _joined("_block", F.col("_text")).alias("parsed_content"),
        F.sum("_pages").alias("num_pages"),
    )


def _joined(order: str, text: Column) -> Column:
    rows = F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), text.alias("t"))))
    return F.array_join(F.transform(rows, lambda r: r.t), "\n")


def run_report(**stages: DataFrame) -> DataFrame:
    """Row counts per stage and status. Frames need a ``status`` column, else count as SUCCESS."""

    def statuses(name: str, df: DataFrame) -> DataFrame:
        status = F.col("status") if "status" in df.columns else F.lit(SUCCESS)
        return df.select(F.lit(name).alias("stage"), status.alias("status"))

    rows = reduce(DataFrame.unionByName, (statuses(n, d) for n, d in stages.items()))
    return rows.groupBy("stage", "status").agg(F.count(F.lit(1)).alias("n_rows"))
