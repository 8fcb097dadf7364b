"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.tables import by_sorting, stored


def connected_components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """(id, root) of every id in `edges`; root is the smallest id it is linked to, directly or through others.

    Edges are undirected; repeated edges and self-loops are allowed, and an edge with a null end is none. No edges, no
    rows. Each round is two joins on node ids whose neighbour minima are pre-aggregated, so no node's neighbours are
    ever gathered, and it is cut from its lineage by a stored table; rounds grow with the logarithm of the longest path.
    What `edges` is made from is read once.
    """
    e = edges.select(F.col(left).alias("u"), F.col(right).alias("v")).where("u is not null and v is not null")
    given = stored(e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    nodes = given.select(F.col("u").alias("id")).union(given.select("v")).distinct()
    e = given.where("u <> v")
    state = _fingerprint(e)
    while True:
        e = _small_star(_large_star(e))
        e = stored(e)
        now = _fingerprint(e)
        if now == state:
            break
        state = now
    return nodes.join(by_sorting(e.select(F.col("u").alias("id"), F.col("v").alias("root"))), "id", "left").select("id", F.coalesce("root", "id").alias("root"))


def _fingerprint(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _large_star(e: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour (or the node itself)."""
    both = e.select("u", "v").union(e.select(F.col("v"), F.col("u"))).toDF("u", "v")
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(by_sorting(least), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, is linked to the smallest of them."""
    least = e.groupBy("u").agg(F.min("v").alias("m"))
    linked = e.join(by_sorting(least), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
    return linked.where("u <> v").distinct()
