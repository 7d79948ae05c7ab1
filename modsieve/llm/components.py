"""Connected components of links that never leave the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modsieve.session import cut_lineage

MAX_ROUNDS = 60


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for every node of a link; the component is its smallest node.

    Alternating large and small stars: each node's neighbours are tied to the smallest of
    them, so paths shorten quickly, and a hub's links are combined before they
    move. Repeated links and links to oneself do no harm; null ends are ignored.
    """
    edges = links.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    edges = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    edges = cut_lineage(edges.distinct())  # what made the links runs once
    selves = edges.where("u = v").select("u")
    edges = edges.where("u <> v")
    seen = None
    for _ in range(MAX_ROUNDS):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        # Small star: all smaller neighbours of a node, and the node, go to the smallest.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        edges = cut_lineage(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        state = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError("components did not settle")
    found = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component"))
    selves = selves.select(F.col("u").alias("node"), F.col("u").alias("component"))
    return found.unionByName(roots).unionByName(selves).groupBy("node").agg(F.min("component").alias("component"))
