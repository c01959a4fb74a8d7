"""Connected components of a table of links, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.workspace import Workspace


def connected_components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node that is not its component's smallest; links may repeat, point either way or to themselves.

    Large-star and small-star in turn: each node's greater neighbours, then its smaller ones, are linked to the smallest node it knows. The
    links end as stars around the smallest nodes after a number of rounds that grows with the logarithm of the longest path. Each round is
    written as a table; only counts reach the driver.
    """
    work = Workspace(links.sparkSession)
    low, high = F.least(a, b), F.greatest(a, b)
    edges = links.where(F.col(a) != F.col(b)).select(high.alias("u"), low.alias("v")).distinct()
    sign = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    edges, seen = work.materialize(edges, "links-0", sign=sign)
    for k in range(1, 1000):
        if not seen["n_rows"]:
            break
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = large.join(large.groupBy("u").agg(F.min("v").alias("m")), "u")
        hooked = small.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v")))
        edges, now = work.materialize(hooked.distinct(), f"links-{k}", sign=sign)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
