"""Connected components of a link table, by alternating large and small stars.

Every node points to the smallest node it can see; the two kinds of rounds alternate
until nothing changes. Each step is an aggregate with map-side combine and one
equi-join whose hot side AQE may split, so a hub never gathers its neighbours in one
task. Each round is a stored table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import stored


def _large_star(links: DataFrame) -> DataFrame:
    """For each node, links its larger neighbours to the smallest node it sees."""
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return (
        both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    )


def _small_star(links: DataFrame) -> DataFrame:
    """For each node, links its smaller neighbours and itself to the smallest of them.

    ``a > b`` holds in every row, so the neighbours of ``a`` here are the smaller ones.
    """
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b")))


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node that has a link; the component is its smallest node.

    ``links`` has two columns ``a`` and ``b`` of one orderable type. Loops, repeated
    and reversed links and links with a null end are allowed; the last are left out.
    An empty table gives an empty table.
    """
    now = stored(
        links.filter("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "links",
    )
    mark = None
    while True:
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == mark or not seen[0]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                now.select("b", "b").distinct()
            )
        mark = seen
        now = stored(_small_star(_large_star(now)).distinct(), "links")
