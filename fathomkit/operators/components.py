"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomkit.session import hold


def components(edges: DataFrame) -> DataFrame:
    """node, root: the smallest node that each node of ``edges`` (a, b) is connected with; roots themselves are absent.

    Alternates large and small stars, each an aggregate and a join, until the edges point to roots alone. Every round
    is written out.
    """
    edges = hold(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    mark = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        edges = hold(small.union(low.select("a", F.col("m").alias("b"))).distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if now == mark:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        mark = now
