"""Connected components by alternating star contractions, each round written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import settle


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) for the nodes of ``edges`` (a, b longs); comp is the least node that is reached.

    A node's least neighbour comes from a partial aggregate and goes back to its edges by a join, so
    no neighbour list is ever gathered; the number of rounds grows with the logarithm of the longest path.
    """
    e = settle(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "cc")
    mark = None
    while True:
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark or not now[0]:
            return e.select(F.col("u").alias("node"), F.col("v").alias("comp")).union(
                e.select(F.col("v").alias("node"), F.col("v").alias("comp"))).groupBy("node").agg(F.min("comp").alias("comp"))
        mark = now
        both = e.union(e.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v")).filter("u <> v")
        e = settle(small.distinct(), "cc")
