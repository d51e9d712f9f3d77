"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import written


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    return down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", "m"))


def _signature(edges: DataFrame):
    return edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``label`` for every node of ``edges`` (a, b): the smallest node that it reaches.

    Each step replaces a node's neighbours by links to its smallest one, so the number of steps grows with the
    logarithm of the longest chain. Aggregates combine before the shuffle and joins may be split by the adaptive
    planner, so a hub with any number of links is no single task. Every step is written to the shared folder.
    """
    edges = written(edges.where("a <> b").distinct())
    last = _signature(edges)
    while last[0]:
        edges = written(_small_star(_large_star(edges).where("a <> b").distinct()).where("a <> b").distinct())
        now = _signature(edges)
        if now == last:
            break
        last = now
    ends = edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return ends.union(ends.select("label", "label")).groupBy("node").agg(F.min("label").alias("label"))
