"""Connected components of a graph of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.session import materialize


def components(links: DataFrame) -> DataFrame:
    """Smallest node of the component of every node that has a link (columns a, b of one ordered type): node, root.

    Every round joins links with the smallest neighbour of their end (counted before the join) and is written to the
    shared folder; the number of rounds grows with the logarithm of the longest path. Self-links and repeated links do
    no harm; an empty table has no nodes.
    """

    def smallest(df: DataFrame) -> DataFrame:
        return df.groupBy("a").agg(F.least(F.min("a"), F.min("b")).alias("m"))

    def state(df: DataFrame):
        return df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    ordered = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
    current, before = materialize(ordered.distinct(), "links"), None
    after = state(current)
    while before != after:
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = both.where("b > a").join(smallest(both), "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        large = materialize(large, "large-star")
        least = smallest(large)
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
        current, before = materialize(small.where("a <> b").distinct(), "small-star"), after
        after = state(current)
    found = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return found.unionByName(found.select(F.col("root").alias("node"), "root").distinct())
