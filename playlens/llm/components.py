"""Connected components of a link table, by rounds of large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlens.llm import common as C


def _stars(links: DataFrame, upward: bool) -> DataFrame:
    """Link every neighbour of a node (above it, or not above it) to the least of the node and its neighbours."""
    both = links.union(links.select("b", "a")) if upward else links.select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    joined = both.join(least, "a")
    if upward:
        moved = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", "m"))
    return moved.where("a <> b")


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (columns a, b); the root is the least node reachable.

    The links of each round are written to the shared checkpoint folder, so a
    lost executor costs one round at most.
    """
    now, seen = C.cut(links.where("a <> b").select("a", "b").distinct()), None
    while True:
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen or not mark[0]:
            break
        seen = mark
        now = C.cut(_stars(_stars(now, True), False).distinct())
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
