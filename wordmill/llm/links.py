"""Connected components of a table of links, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordmill.llm.common import scratch, written


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b); the root is the least node it reaches.

    Each round links every node to the least of its neighbours: first all larger neighbours to
    it, then all smaller ones. Only minima are aggregated, so a node with very many links is
    reduced before the shuffle. Rounds end when all links lead to roots.
    """
    spark = edges.sparkSession
    folder = scratch(spark)
    links = edges.where("a != b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    links = written(links.distinct(), f"{folder}/0")
    turn = 0
    while True:
        both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        # larger neighbours of a to the least of its neighbourhood
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a != b").distinct()
        # smaller neighbours of a, and a itself, to the least of them
        under = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(under, "a")
        small = small.where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        joined = small.unionAll(under.select("a", F.col("m").alias("b"))).distinct()
        turn += 1
        new = written(joined, f"{folder}/{turn}")
        # done when no node is both under and over another one: all links are stars
        if not new.join(new.select(F.col("b").alias("a")).distinct(), "a", "left_semi").take(1) and (
            new.groupBy("a").agg(F.countDistinct("b").alias("n")).where("n > 1").take(1) == []
        ):
            break
        links = new
    roots = new.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionAll(new.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
