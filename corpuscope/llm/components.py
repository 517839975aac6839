"""Connected components of a table of links, none of which reaches the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from corpuscope.runtime import written


def _least(pairs: DataFrame) -> DataFrame:
    """Smallest neighbour (or itself) of each node, pre-aggregated before the shuffle and stored.

    Stored, because a join of two plain exchanges is one in which Spark can split a hot node.
    """
    least = pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("least"))
    return written(least, "least")


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` of every node that has a link: the smallest node it can reach.

    Alternates the large-star and small-star steps, which keep the number of links at most and end
    after about log(longest path) rounds. Each round is written to the shared folder. Links of a node
    with itself, repeated links, and links with a null end are ignored.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    edges = edges.filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") > F.col("v"))).distinct()
    edges, before = written(edges, "links"), None
    while True:
        # Large star: every larger neighbour of a node is linked to the node's smallest neighbour.
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        larger = both.filter(F.col("v") > F.col("u")).join(_least(both), "u")
        star = larger.select(F.col("v").alias("u"), F.col("least").alias("v")).filter("u > v").distinct()
        star = written(star, "large-star")
        # Small star: a node's smaller neighbours and itself are linked to the smallest of them.
        least = _least(star)
        smaller = star.join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v"))
        edges = written(smaller.union(least.toDF("u", "v")).filter("u > v").distinct(), "small-star")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == before:
            break
        before = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
