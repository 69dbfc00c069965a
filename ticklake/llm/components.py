"""Connected components of a distributed edge list.

Rounds of large-star and small-star: each links a node's neighbours to the
smallest of them, until every component is a star around its smallest node.
Each round is a few aggregations and joins; every step is written to the
shared checkpoint folder, which cuts the lineage, survives lost executors
and lets the next join split a node with very many neighbours.  Nothing but
a count and a checksum of the edges reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticklake.session import discard, materialize


def _signature(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return r["n"], r["x"]


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node``, ``component`` for every node of an edge: ``component`` is
    the smallest node reachable.  Loops and repeated edges are harmless;
    null nodes link with nothing."""
    u, v = F.col(a), F.col(b)
    now = edges.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).filter(
        u.isNotNull() & v.isNotNull()).filter("u <> v").distinct()
    now = materialize(now, "edges")
    last = _signature(now)
    while last[0]:
        # large star: larger neighbours go to the smallest of all
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        first = materialize(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
        large = both.filter("v > u").join(first, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialize(large.distinct(), "large_star")
        # small star: smaller neighbours and the node itself go to the smallest
        least = materialize(large.groupBy("u").agg(F.min("v").alias("v")), "least")
        small = large.join(least.select("u", F.col("v").alias("m")), "u").filter("v <> m")
        new = least.unionByName(small.select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct()
        new = materialize(new, "edges")
        discard(now, first, large, least)
        now = new
        this = _signature(now)
        if this == last:
            break
        last = this
    leaves = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return leaves.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
