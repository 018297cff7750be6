"""Saving crawled pages as files."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from answerloom.functions.urls import page_file_name


def page_file_names(pages: DataFrame) -> DataFrame:
    """Pages with the file name each is saved under."""
    return pages.withColumn("file_name", page_file_name(F.col("url")))


def file_name_collisions(pages: DataFrame, saved: bool = False) -> DataFrame:
    """File names that more than one URL maps to; with ``saved`` the names of files that `save_pages` writes."""
    return (
        (saved_names(pages) if saved else page_file_names(pages))
        .select("file_name", "url")
        .distinct()
        .groupBy("file_name")
        .agg(F.count(F.lit(1)).alias("n_urls"), F.min("url").alias("first_url"))
        .filter("n_urls > 1")
    )


def saved_names(pages: DataFrame) -> DataFrame:
    """The same names, but for those that begin with a dot or a line: Spark's readers pass over such files."""
    named, name = page_file_names(pages), F.col("file_name")
    return named.withColumn("file_name", F.when(name.rlike(r"\A[._]"), F.concat(F.lit("home"), name)).otherwise(name))


def savable_pages(pages: DataFrame) -> DataFrame:
    """file_name and html of the pages that get a file: of several URLs with one name the smallest.

    Names are compared without any page text; only pages of a URL that occurs more than once are put together (the
    smallest text stands).
    """
    named = saved_names(pages).select("file_name", "url")
    counted = named.groupBy("file_name", "url").agg(F.count(F.lit(1)).alias("n"))
    chosen = counted.groupBy("file_name").agg(F.min(F.struct("url", "n")).alias("first")).select("first.*")
    html = F.coalesce("html", F.lit("")).alias("html")
    single = pages.join(chosen.filter("n = 1"), "url", "left_semi").select("url", html)
    several = pages.join(chosen.filter("n > 1"), "url", "left_semi").groupBy("url").agg(F.min(html).alias("html"))
    return saved_names(single.unionByName(several)).select("file_name", "html")


@dataclass
class SavedFiles(WriterCommitMessage):
    files: int


class PageFileWriter(DataSourceArrowWriter):
    """Writes each row (file_name, html) as a file of its own.

    A file is written under a name of its attempt and then moved to its own, so a reader sees whole files only, and an
    attempt that runs again puts the same file in the same place. When all tasks are done, `_SUCCESS` says so.
    """

    def __init__(self, folder: str) -> None:
        self.folder = folder

    def _place(self):
        from pyarrow import fs

        local = "://" not in self.folder and not self.folder.startswith("file:")
        return (fs.LocalFileSystem(), self.folder) if local else fs.FileSystem.from_uri(self.folder)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> SavedFiles:
        system, folder = self._place()
        system.create_dir(folder, recursive=True)
        attempt, files = TaskContext.get().taskAttemptId(), 0
        for batch in iterator:
            for name, html in zip(batch.column("file_name"), batch.column("html")):
                draft = f"{folder}/_draft-{attempt}"  # names that begin so are no input of Spark's readers
                with system.open_output_stream(draft, compression=None) as out:
                    out.write(html.as_buffer())
                system.move(draft, f"{folder}/{name.as_py()}")
                files += 1
        return SavedFiles(files)

    def commit(self, messages: list[SavedFiles | None]) -> None:
        system, folder = self._place()
        system.create_dir(folder, recursive=True)
        with system.open_output_stream(f"{folder}/_SUCCESS") as out:
            out.write(b"")

    def abort(self, messages: list[SavedFiles | None]) -> None:
        """Files that were moved are whole pages under their own names, and stay."""


class PageFiles(DataSource):
    """The format `page_files`: one file a row below the folder of option `path`."""

    @classmethod
    def name(cls) -> str:
        return "page_files"

    def writer(self, schema: StructType, overwrite: bool) -> PageFileWriter:
        return PageFileWriter(self.options["path"])


def save_pages(pages: DataFrame, folder: str) -> DataFrame:
    """Write each page as a file under its name, where `read_raw_files` finds it. Returns the names that several URLs map
    to; only the first URL of each has a file.

    Files of the same names are replaced, others in the folder stay. A page without text is an empty file, which Spark's
    readers pass over.
    """
    pages.sparkSession.dataSource.register(PageFiles)
    savable_pages(pages).write.format("page_files").mode("append").save(folder)
    return file_name_collisions(pages, saved=True)
