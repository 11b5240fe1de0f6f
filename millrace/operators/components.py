"""Connected components of a table of links, by rounds of smallest neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.runtime import stored


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node that has a link; the component is its smallest node.

    ``links`` has two columns ``a`` and ``b`` of one orderable type. In each round a node's
    larger neighbours, and then its smaller ones, are linked to the smallest node that it
    sees. Both steps are an aggregate and an equi-join, so a node with many links is spread
    over tasks; the rounds are about the logarithm of the longest path.
    """
    pairs = links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now, mark = stored(pairs.distinct(), "links"), None
    while True:
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == mark or not seen[0]:
            ends = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(ends)
        mark = seen
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("to"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("to").alias("b"))
        least = large.groupBy("a").agg(F.min("b").alias("to"))
        moved = large.join(least, "a").filter("b > to").select(F.col("b").alias("a"), F.col("to").alias("b"))
        now = stored(moved.union(least.select("a", F.col("to").alias("b"))).distinct(), "links")
