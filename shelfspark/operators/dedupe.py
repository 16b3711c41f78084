"""Deterministic de-duplication, ranks and audits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _ranked(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def first_wins(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key in ``order``, which should be total."""
    return _ranked(df, keys, [F.col(c).asc_nulls_last() for c in order], 1)


def last_wins(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    return _ranked(df, keys, [F.col(c).desc_nulls_last() for c in order], 1)


def top_n(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """The first ``n`` rows of each key; Spark limits groups before the shuffle."""
    return _ranked(df, keys, order, n)


def qualify_best(df: DataFrame, keys: list[str], score: str, tiebreak: list[str]) -> DataFrame:
    """The row of the highest score of each key, nulls last."""
    return _ranked(df, keys, [F.col(score).desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in tiebreak]], 1)


def excess_usage(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys used more than once, with ``n``."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def assert_single_use(df: DataFrame, keys: list[str]) -> DataFrame:
    """``df``, or an error while its rows are read if a key repeats."""
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    return df.withColumn("_n", n).where(F.when(F.col("_n") > 1, F.raise_error(F.lit(f"{keys} used more than once")).cast("boolean")).otherwise(True)).drop("_n")


def coverage(matched: Column, total: Column) -> Column:
    """Percent, 0 of nothing."""
    from shelfspark.functions.numbers import round2

    return F.coalesce(round2(F.try_divide(matched * 100.0, total)), F.lit(0.0))
