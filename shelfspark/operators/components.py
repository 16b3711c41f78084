"""Connected components of an edge list by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.storage import materialize


def _towards_least(edges: DataFrame, only_smaller: bool) -> DataFrame:
    """One star step on edges ``u > v``.

    Large star: every larger neighbour of a node is tied to the least of the node and its neighbours;
    small star: the node and its smaller neighbours are tied to the least of them. The least comes from
    a partially aggregated minimum and a join that can be split, never from a collected neighbourhood.
    """
    sides = edges if only_smaller else edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = sides.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    joined = sides.join(least, "u")
    if only_smaller:
        moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
    else:
        moved = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.where("u > v").distinct()


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 64) -> DataFrame:
    """``node, component`` for every node of an edge; the component is its least node.

    Self-loops, repeated and reversed edges are fine, edges with a null end are ignored, no edges give
    no rows. Rounds grow with the logarithm of the longest path.
    """
    pairs = edges.where(F.col(src).isNotNull() & F.col(dst).isNotNull())
    loops = pairs.where(F.col(src) == F.col(dst)).select(F.col(src).alias("node"))
    now = materialize(
        pairs.select(F.greatest(src, dst).alias("u"), F.least(src, dst).alias("v")).where("u > v").distinct()
    )
    mark = None
    for _ in range(max_rounds):
        now = materialize(_towards_least(_towards_least(now, only_smaller=False), only_smaller=True))
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == mark:
            break
        mark = seen
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    tied = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component"))
    alone = loops.select("node", F.col("node").alias("component")).join(tied, "node", "left_anti")
    return tied.union(roots).union(alone).distinct()
