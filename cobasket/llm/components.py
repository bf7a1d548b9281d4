"""Connected components of links between numbers, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cobasket.llm.common import written


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
    return tuple(row)


def connected_components(links: DataFrame) -> DataFrame:
    """node, root: every node of a link (a, b) with the smallest node that it reaches. Nulls give no link.

    Each round links every node's larger neighbours, then its smaller ones, to its smallest: the number of links never
    grows, and the rounds needed follow the logarithm of the longest path. A round's links are stored, so a lost
    executor costs that round's tasks and no more; the driver sees two numbers of them, to know when nothing changes. The
    smallest neighbours are stored before they are joined: both sides of a join are then plain shuffles, so the skew join
    splits a star around a node that a third of all links have.
    """
    edges = written(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                    .filter("a < b").distinct(), "links")
    before, now = None, _state(edges)
    while before != now:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = written(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "least")
        large = both.filter("b > a").join(least, "a").select(F.col("m").alias("a"), "b").distinct()
        large = written(large, "large-stars")
        least = written(large.groupBy("b").agg(F.min("a").alias("m")), "least")
        ends = F.array(F.struct(F.col("m").alias("a"), F.col("b").alias("b")),
                       F.struct(F.col("m").alias("a"), F.col("a").alias("b")))
        small = large.join(least, "b").select(F.explode(ends).alias("e")).select("e.a", "e.b")
        edges = written(small.filter("a < b").distinct(), "links")
        before, now = now, _state(edges)
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(
        edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
