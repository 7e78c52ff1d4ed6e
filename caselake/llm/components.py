"""Connected components of a link table, by alternating star operations.

Each round two aggregations and joins hang every node below the smallest node it
knows; the links of a round are written to the shared folder, which cuts the
lineage and survives lost executors. A hub with very many links is summed before
the shuffle and its rows are only joined to one small row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caselake.llm.storage import discard, materialized


def _least(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return both.join(_least(both), "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("least").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    linked = down.join(_least(down), "a").where(F.col("b") != F.col("least")).select(F.col("b").alias("a"), F.col("least").alias("b"))
    return linked.union(_least(down).select("a", F.col("least").alias("b")))


def connected(links: DataFrame) -> DataFrame:
    """node, root for every node of ``links`` (a, b long): root is the smallest node of its component."""
    links = materialized(links.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    seen = None
    while True:
        state = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if state == seen:
            break
        seen = state
        stars = materialized(_small_star(_large_star(links)).where(F.col("a") != F.col("b")).distinct(), "links")
        discard(links)
        links = stars
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
