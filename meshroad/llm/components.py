"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meshroad.llm.common import materialize


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """`id`, `component` (smallest id reachable) for every id in a link; the ids are longs, null ones link with nothing.

    Each step keeps one row for each link at most and is written to the shared folder; neighbours are never
    gathered in one row, only their minimum is. The number of steps grows with the logarithm of the longest path.
    """
    x, y = F.col(f"`{a}`"), F.col(f"`{b}`")
    edges = materialize(links.select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v"))
                        .filter(x.isNotNull() & y.isNotNull() & (x != y)).distinct(), "links")
    while True:
        # Large star: every larger neighbour of a node goes to the node's smallest neighbour.
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # Small star: a node and its smaller neighbours go to the smallest of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("w"), "m").filter("w != m").select(F.col("w").alias("u"), F.col("m").alias("v"))
        after = materialize(small.union(least.select("u", F.col("m").alias("v"))).distinct(), "links")
        # Done when every node has one link, to a node that has none itself.
        chained = after.join(after.select(F.col("u").alias("v")).distinct(), "v", "left_semi")
        if chained.isEmpty():
            roots = after.select(F.col("v").alias("id")).distinct().withColumn("component", F.col("id"))
            return after.select(F.col("u").alias("id"), F.col("v").alias("component")).union(roots)
        edges = after
