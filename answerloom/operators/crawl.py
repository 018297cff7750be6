"""Link graph of stored pages and what is reachable in it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from answerloom.functions.urls import page_links, resolve_url, url_host
from answerloom.session import new_folder, reliable_checkpoint


def link_edges(pages: DataFrame) -> DataFrame:
    """All links as (src, href, dst, same_site); hosts must be equal, a common prefix is not enough."""
    links = pages.select(F.col("url").alias("src"), F.explode(page_links(F.col("html"))).alias("href"))
    resolved = links.filter(F.col("href") != "").withColumn("dst", resolve_url(F.col("src"), F.col("href")))
    return resolved.withColumn("same_site", url_host(F.col("src")) == url_host(F.col("dst")))


def store_edges(edges: DataFrame, table: str, buckets: int) -> DataFrame:
    """Write the edges bucketed by source, so that no round of a long crawl shuffles them again."""
    (
        edges.select("src", "dst").distinct().repartition(buckets, "src")
        .write.mode("overwrite").bucketBy(buckets, "src").sortBy("src").saveAsTable(table)
    )
    return edges.sparkSession.table(table)


def reachable_pages(edges: DataFrame, seeds: DataFrame) -> DataFrame:
    """All nodes reachable from the seeds, with the round in which each is first met.

    ``edges`` has src and dst (best from ``store_edges``), ``seeds`` has url. Each round joins the frontier
    with the edges and drops what was met before. The frontiers are written
    to the shared folder, one part per round, so plans stay short and a lost
    executor costs one round at most. The loop ends when a round meets nothing new.
    """
    spark = edges.sparkSession
    folder = new_folder(spark, "crawl")
    graph = edges.select("src", "dst")
    frontier = seeds.select("url").distinct().withColumn("round", F.lit(0))
    schema = frontier.schema
    number = 0
    while True:
        met = Observation()
        frontier.observe(met, F.count(F.lit(1)).alias("rows")).write.parquet(f"{folder}/part={number}")
        parts = [f"{folder}/part={n}" for n in range(number + 1)]
        seen = spark.read.schema(schema).parquet(*parts)
        if met.get["rows"] == 0:
            return seen
        current = spark.read.schema(schema).parquet(parts[-1])
        number += 1
        frontier = (
            current.select(F.col("url").alias("src"))
            .join(graph, "src")
            .select(F.col("dst").alias("url"))
            .distinct()
            .join(seen.select("url"), "url", "left_anti")
            .withColumn("round", F.lit(number))
        )


def crawl(pages: DataFrame, seeds: DataFrame) -> DataFrame:
    """Follow same-site links over stored pages; a link to a page that is not stored is a failed row.

    A fragment names a place in a page, so links are followed and pages looked up without it.
    """
    plain = F.regexp_extract("dst", r"\A([^#]*)", 1)
    edges = reliable_checkpoint(
        link_edges(pages).filter("same_site").select("src", plain.alias("dst")).distinct())
    visited = reachable_pages(edges, seeds)
    stored = pages.select("url").distinct().withColumn("_stored", F.lit(True))
    return visited.join(stored, "url", "left").select(
        "url", "round", F.when(F.col("_stored"), "SUCCESS").otherwise("ERROR: page not found").alias("status")
    )
