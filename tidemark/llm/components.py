"""Connected components of a graph given by its edges, by rounds of large-star and small-star joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialise


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hangs the neighbours of each node on its smallest neighbour: the larger ones, or the smaller and itself."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
    low = both.groupBy("a").agg(F.min("b").alias("_low")).withColumn("_low", F.least("a", "_low"))
    joined = both.join(low, "a")
    if large:
        out = joined.where("b > a").select(F.col("b").alias("a"), F.col("_low").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("_low").alias("b")).unionByName(
            low.select("a", F.col("_low").alias("b"))
        )
    return out.where("a != b").distinct()


def components(edges: DataFrame, src: str, dst: str) -> DataFrame:
    """``node, component`` for every node that has an edge; a component is named by its smallest node.

    Each round points edges from the larger node to a smaller one and keeps the components; the number of rounds grows
    with the logarithm of the longest chain. Rounds are written to the shared folder, so lineage stays short, and
    nothing but an equality of two counters reaches the driver.
    """
    now = materialise(
        edges.select(F.greatest(src, dst).alias("a"), F.least(src, dst).alias("b")).where("a != b").distinct(), "star"
    )
    mark = None
    while True:
        then = mark
        now = materialise(_star(_star(now, True), False), "star")
        mark = now.agg(
            F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)"))
        ).first()
        if mark == then:
            break
    nodes = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.unionByName(nodes.select(F.col("component").alias("node"), "component").distinct())
