"""Greedy one-to-one assignment of ranked candidates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfspark.storage import materialize


def greedy_one_to_one(candidates: DataFrame, members: list[str], order: list[str], max_rounds: int = 1000) -> DataFrame:
    """What a walk over candidates in ``order`` accepts, if it skips those with a member already taken.

    ``order`` holds columns to sort ascending and must be total over candidates. Each round accepts the
    candidates that come first for all of their members among those left and drops what shares a member with
    them; that gives the walk's result without a sequence, and each round settles every local best.
    """
    left = materialize(candidates.withColumn("_place", F.struct(*order)))
    accepted = None
    for _ in range(max_rounds):
        firsts = left
        for m in members:
            least = F.min("_place").over(Window.partitionBy(m))
            firsts = firsts.withColumn(f"_first_{m}", least == F.col("_place"))
        chosen = materialize(firsts.where(" AND ".join(f"`_first_{m}`" for m in members)).drop(*[f"_first_{m}" for m in members]))
        if chosen.isEmpty():
            break
        accepted = chosen if accepted is None else accepted.unionByName(chosen)
        for m in members:
            left = left.join(chosen.select(m), m, "left_anti")
        left = materialize(left.select(*chosen.columns))
    else:
        raise RuntimeError(f"assignment did not settle in {max_rounds} rounds")
    return (accepted if accepted is not None else left.limit(0)).drop("_place")
