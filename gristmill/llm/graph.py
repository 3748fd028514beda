"""Connected components by label propagation over checkpointed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.session import cut_lineage


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the least node of each component. Nodes without a link don't appear.

    Large stars are folded to their least neighbour in turn with small ones, so the rounds grow with the logarithm
    of a component's length; nothing but one count a round reaches the driver.
    """
    edges = cut_lineage(links.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        large = cut_lineage(large)
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").filter("v <> m").select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"))
        edges = cut_lineage(small.unionByName(low.select("u", F.col("m").alias("v"))).filter("u <> v").distinct())
        state = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).collect()[0]
        if state == before:
            break
        before = state
    members = edges.groupBy("u").agg(F.min("v").alias("component"))
    roots = members.select(F.col("component").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return members.withColumnRenamed("u", "node").unionByName(roots)
