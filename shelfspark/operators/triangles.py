"""Triangles of a graph, listed from each one's member of least degree."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfspark.storage import materialize


def oriented(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Edges ``u, v, rank`` from the end of smaller (degree, name) to the other, whose place in that order is ``rank``.

    A node has at most root(2 * edges) edges going out, however many it has in all.
    """
    pairs = edges.where(F.col(a) != F.col(b)).select(F.least(a, b).alias("p"), F.greatest(a, b).alias("q")).distinct()
    degrees = pairs.select(F.explode(F.array("p", "q")).alias("node")).groupBy("node").agg(F.count("*").alias("n"))
    for end in ("p", "q"):
        pairs = pairs.join(degrees.select(F.col("node").alias(end), F.struct("n", F.col("node").alias("name")).alias(f"{end}_rank")), end)
    up = F.col("p_rank") < F.col("q_rank")
    return pairs.select(
        F.when(up, F.col("p")).otherwise(F.col("q")).alias("u"), F.when(up, F.col("q")).otherwise(F.col("p")).alias("v"), F.greatest("p_rank", "q_rank").alias("rank")
    )


def wedges(out: DataFrame) -> DataFrame:
    """``u, v, w``: each two edges that go out of one node, in order of their ends; at most root(2) * edges^1.5 rows."""
    right = out.select("u", F.col("v").alias("w"), F.col("rank").alias("w_rank"))
    return out.join(right, "u").where(F.col("rank") < F.col("w_rank")).select("u", "v", "w")


def triangles(edges: DataFrame, a: str = "src", b: str = "dst") -> DataFrame:
    """``u, v, w`` of each three nodes whose pairs are all edges, once, from the least degree to the largest.

    Direction, repeats and loops of edges don't matter; edges with a null end are ignored.
    """
    out = materialize(oriented(edges, a, b))
    return wedges(out).join(out.select(F.col("u").alias("v"), F.col("v").alias("w")), ["v", "w"]).select("u", "v", "w")


def by_part(found: DataFrame, part: Callable[[Column], Column], names: tuple[str, ...]) -> DataFrame:
    """Triangles of a graph of three parts as a column for each part; ``part`` tells a node's."""
    nodes = F.array("u", "v", "w")
    return found.select(*[F.get(F.filter(nodes, lambda n: part(n) == s), F.lit(0)).alias(s) for s in names])  # noqa: B023
