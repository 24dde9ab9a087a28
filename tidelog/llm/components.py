"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.session import stored


def _mark(edges: DataFrame) -> tuple:
    """Number and sum of hashes of the links: equal if nothing has changed."""
    hashed = F.xxhash64("u", "v").cast("decimal(20,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(hashed)).first())


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node, root`` of every node with a link; the root is the least node.

    Large and small stars in turn: every node passes the least node it knows
    to its larger neighbours, then to its smaller ones, until all links point
    at roots. Each round is written to the shared folder; the number of rounds
    grows with the logarithm of the nodes.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    edges = stored(edges, "edges")
    mark = _mark(edges)
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # larger neighbours to the least node
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        # the node and its smaller neighbours to the least of them
        joined = large.join(large.groupBy("u").agg(F.min("v").alias("m")), "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(joined.select("u", F.col("m").alias("v")))
        edges = stored(small.where("u <> v").distinct(), "edges")
        before, mark = mark, _mark(edges)
        if mark == before:
            break
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
