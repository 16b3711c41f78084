"""Warehouse writes on Parquet: merges, snapshots, history."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def upsert(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """The target after a merge that updates all columns of matched rows and inserts the rest.

    Keys compare with ``=``: a row with a null key never matches, so it is inserted by every run. Columns of
    the target that the source lacks are kept on update and null on insert.
    """
    t = target.select(F.lit(True).alias("_t"), *[F.col(c).alias(f"_t_{c}") for c in target.columns])
    s = source.select(F.lit(True).alias("_s"), *[F.col(c).alias(f"_s_{c}") for c in source.columns])
    on = None
    for k in keys:
        same = F.col(f"_t_{k}") == F.col(f"_s_{k}")
        on = same if on is None else on & same
    pick = lambda c: F.when(F.col("_s"), F.col(f"_s_{c}")).otherwise(F.col(f"_t_{c}")) if c in source.columns else F.col(f"_t_{c}")
    return t.join(s, on, "full_outer").select(*[pick(c).alias(c) for c in target.columns])


def update_only(target: DataFrame, source: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """The target with ``columns`` taken from the source where a key matches; nothing is inserted."""
    s = source.select(*keys, F.lit(True).alias("_hit"), *[F.col(c).alias(f"_s_{c}") for c in columns])
    picked = [F.when(F.col("_hit"), F.col(f"_s_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in target.columns]
    return target.join(s, keys, "left").select(*picked)


def with_columns_if_absent(df: DataFrame, **types: str) -> DataFrame:
    """Schema evolution: columns that aren't there yet, null."""
    return df.withColumns({c: F.lit(None).cast(t) for c, t in types.items() if c not in df.columns})


@contextmanager
def dynamic_overwrite(spark: SparkSession) -> Iterator[None]:
    """Overwrites replace the partitions that they write to and no others."""
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        yield
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)


def replace_snapshot(spark: SparkSession, rows: DataFrame, table: str, date: dt.date, column: str = "snapshot_date") -> None:
    """Replace one day of a date-partitioned Parquet table; other days stay, and no rows clear the day."""
    day = rows.withColumn(column, F.lit(date)) if column not in rows.columns else rows.where(F.col(column) == F.lit(date))
    names = spark.table(table).columns
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({column} = DATE '{date.isoformat()}')")
    with dynamic_overwrite(spark):
        day.select(*names).write.mode("overwrite").insertInto(table, overwrite=True)


def snapshot_replaced(kept: DataFrame, today: DataFrame, date: str, column: str = "snapshot_date") -> DataFrame:
    """The rows of a table once a date has been replaced."""
    return kept.where(F.col(column) != F.lit(date).cast("date")).unionByName(today.where(F.col(column) == F.lit(date).cast("date")))


def append_history(history: str, entry, date: str = "date"):
    """The array column ``history`` without entries of the new entry's date, and the entry at its end."""
    kept = F.filter(F.col(history), lambda h: ~h[date].eqNullSafe(entry[date]))
    return F.concat(F.coalesce(kept, F.slice(F.array(entry), 1, 0)), F.array(entry))


def within_stores(history: str, stores: tuple[str, ...], prices: str = "stores_prices"):
    """History entries whose stores are all known."""
    known = F.array(*[F.lit(s) for s in stores])
    return F.filter(F.col(history), lambda h: F.forall(F.map_keys(h[prices]), lambda k: F.array_contains(known, k)))


def cardinality(target: DataFrame, source: DataFrame, target_key: str, source_key: str) -> DataFrame:
    """Source keys that don't match exactly one target row, with ``matches``."""
    joined = source.select(F.col(source_key).alias("key")).join(target.select(F.col(target_key).alias("hit")), F.col("key") == F.col("hit"), "left")
    return joined.groupBy("key").agg(F.count("hit").alias("matches")).where("matches <> 1")
