"""Connected components of an edge table, without bringing edges to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star operation: every node hands its smallest neighbour to its other neighbours."""
    if large:
        near = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        near = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = near.groupBy("u").agg(F.min("v").alias("_m")).select("u", F.least("u", "_m").alias("m"))
    met = near.join(least, "u")
    if large:
        out = met.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = met.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.where("u != m").select("u", F.col("m").alias("v")))
    return out.where("u != v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of the undirected ``edges`` ``(u, v)``; root: the smallest node.

    Alternates the large-star and small-star operations until nothing changes, which takes a number
    of rounds that grows with the logarithm of the longest chain. Each round is checkpointed to the
    shared folder. Self-loops, repeated edges and both directions of an edge are allowed; rows with
    a null end are ignored; no edges give no rows. The minimum per node is combined before the
    shuffle, and the join that hands it out is one that Spark splits where a star's centre is hot.
    """
    now = edges.select("u", "v").where("u != v").distinct().checkpoint()
    before = None
    while True:
        now = _star(_star(now, large=True), large=False).checkpoint()
        state = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if state == before:
            break
        before = state
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
