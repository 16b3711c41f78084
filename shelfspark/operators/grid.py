"""Joins of rows that are alike in some columns and near in some measures."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfspark.storage import materialize, small

#: Pairs that one task should form.
PAIRS = 2_000_000


@dataclass(frozen=True)
class Axis:
    """A measure: two rows are near if the larger value is at most ``ratio`` times the smaller.

    A value that isn't a positive finite number is near to any.
    """

    column: str
    ratio: float

    def band(self, prefix: str) -> Column:
        """Number of the value's band of the logarithm; near values lie in one band or in neighbours."""
        c = F.col(f"{prefix}_{self.column}")
        known = F.coalesce((c > 0) & (c < float("inf")), F.lit(False))
        return F.when(known, F.floor(F.log(c) / (math.log(self.ratio) * 1.000001)))


def _cells(df: DataFrame, prefix: str, axes: list[Axis], others: list[int]) -> DataFrame:
    """``df`` in each cell where it may meet the other side, which knows the axes of one of the masks ``others``.

    A cell is a pair of masks and a band on each axis that both sides know. Of the first, third ... axis side a
    also goes to the neighbours of its band, of the others side b, so that two rows meet in one
    cell and a row is in three for two axes.
    """
    bands = [axis.band(prefix) for axis in axes]
    own = sum((F.when(b.isNotNull(), 1 << i).otherwise(0) for i, b in enumerate(bands)), F.lit(0))
    df = df.withColumns({"_own": own} | {f"_band{i}": b for i, b in enumerate(bands)}).withColumn("_other", F.explode(F.array(*[F.lit(m) for m in others or [0]])))
    for i in range(len(axes)):
        c, used = F.col(f"_band{i}"), (F.col("_own").bitwiseAND(F.col("_other")).bitwiseAND(F.lit(1 << i))) != 0
        at = F.array(c - 1, c, c + 1) if (i % 2 == 0) == (prefix == "a") else F.array(c)
        df = df.withColumn(f"_band{i}", F.explode(F.when(used, at).otherwise(F.array(F.lit(0).cast("long")))))
    left, right = ("_own", "_other") if prefix == "a" else ("_other", "_own")
    return df.withColumns({"_a": F.col(left), "_b": F.col(right)}).drop("_own", "_other")


def _masks(a: DataFrame, b: DataFrame, axes: list[Axis]) -> tuple[list[int], list[int]]:
    """Which axes are known together in the rows of either side: at most two to the number of axes."""
    if not axes:
        return [0], [0]
    own = lambda p: sum((F.when(axis.band(p).isNotNull(), 1 << i).otherwise(0) for i, axis in enumerate(axes)), F.lit(0))
    found = a.select(F.lit("a").alias("side"), own("a").alias("m")).union(b.select(F.lit("b"), own("b"))).distinct().collect()
    return sorted(r.m for r in found if r.side == "a"), sorted(r.m for r in found if r.side == "b")


def grid_join(a: DataFrame, b: DataFrame, alike: list[str], axes: list[Axis], row: str, residual: Column, pairs: int = PAIRS) -> DataFrame:
    """Pairs of rows of ``a`` (columns a_*) and ``b`` (b_*) with equal ``alike`` columns that may be near on all axes.

    Every near pair is found once; pairs up to two bands apart come along, so the caller's ``residual`` should hold the exact
    test. Rows with a null in ``alike`` pair with none. Cells are counted before the join: it gets as many partitions as
    its pairs need, and a cell of more than ``pairs`` pairs is dealt out, a's rows by ``row`` and b's to each part.
    Both sides should be cheap to read, as they are read for the count and for the join.
    """
    masks_a, masks_b = _masks(a, b, axes)
    a, b = _cells(a, "a", axes, masks_b), _cells(b, "b", axes, masks_a)
    keys = [f"_key{i}" for i in range(len(alike))]
    # Without columns that hold one value: Spark drops those from a join's keys, and then deals its rows out anew.
    used = [i for i in range(len(axes)) if any(m & n & (1 << i) for m in masks_a for n in masks_b)]
    cell = [*keys, *(["_a"] if len(masks_a) > 1 else []), *(["_b"] if len(masks_b) > 1 else []), *[f"_band{i}" for i in used]]
    a = a.withColumns({k: F.col(f"a_{c}") for k, c in zip(keys, alike, strict=True)})
    b = b.withColumns({k: F.col(f"b_{c}") for k, c in zip(keys, alike, strict=True)})

    counted = a.groupBy(*cell).agg(F.count("*").alias("_n")).join(b.groupBy(*cell).agg(F.count("*").alias("_m")), cell)
    cells = counted.select(*cell, (F.col("_n") * F.col("_m")).alias("_pairs"))
    total, most = cells.agg(F.coalesce(F.sum("_pairs"), F.lit(0)), F.coalesce(F.max("_pairs"), F.lit(0))).first()
    usual = int(a.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(usual, -(-total // pairs))
    if most > pairs:
        hot = small(materialize(cells.where(F.col("_pairs") > pairs).select(*cell, F.ceil(F.col("_pairs") / pairs).cast("int").alias("_parts"))))
        n = F.coalesce("_parts", F.lit(1))
        a = a.join(hot, cell, "left").withColumn("_part", F.pmod(F.xxhash64(f"a_{row}"), n).cast("int")).drop("_parts")
        b = b.join(hot, cell, "left").withColumn("_part", F.explode(F.sequence(F.lit(0), n - 1))).drop("_parts")
        cell = [*cell, "_part"]
    # Dealt out by count: pairs are many where rows are few, so partitions must not be merged by their bytes.
    # Many pairs of few rows must not become a broadcast join either, which reads the dealt rows where they were made.
    drop = {*cell, "_a", "_b", *[f"_band{i}" for i in range(len(axes))]}
    a, b = (df.drop(*(drop - set(cell))) for df in (a, b))
    return a.repartition(parts, *cell).join(b.hint("merge") if parts > usual else b, cell).drop(*cell).where(residual)
