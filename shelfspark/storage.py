"""Cutting lineage through the cluster's shared folder, and broadcasts behind a size check."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Frames of at most this many rows and bytes may be broadcast after both have been measured.
BROADCAST_ROWS, BROADCAST_BYTES = 1_000_000, 64 << 20

#: Size of a batch of wide rows between the JVM and a Python worker.
BATCH_BYTES = 4_000_000


def shared_dir(spark: SparkSession) -> str:
    """A fresh folder below the cluster's shared checkpoint folder (a default only in local mode, where that is unset)."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        base = f"{tempfile.gettempdir()}/shelfspark-checkpoints"
    return f"{base.rstrip('/')}/shelfspark-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` below the shared folder and read it back.

    Cuts the lineage and survives lost executors; later readers share one result.
    """
    spark, schema, path = df.sparkSession, df.schema, shared_dir(df.sparkSession)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(schema).parquet(path)


def bounded_batches(spark: SparkSession) -> None:
    """Let Arrow batches hold ``BATCH_BYTES`` at most, a row at least (a session setting, changed only where it has Spark's default)."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key) == "67108864b":
        spark.conf.set(key, str(BATCH_BYTES))


def _bytes(c: Column, kind: T.DataType) -> Column:
    """About the bytes of a value."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0)) + 16
    if isinstance(kind, T.ArrayType):
        if isinstance(kind.elementType, (T.StringType, T.BinaryType, T.ArrayType, T.StructType, T.MapType)):
            return F.coalesce(F.octet_length(F.to_json(c)), F.lit(0)) + 16
        return F.coalesce(F.array_size(c), F.lit(0)) * 8 + 16
    if isinstance(kind, (T.StructType, T.MapType)):
        return F.coalesce(F.octet_length(F.to_json(c)), F.lit(0)) + 16
    return F.lit(8)


def small(df: DataFrame, limit: int = BROADCAST_ROWS, most: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if it holds at most ``limit`` rows of ``most`` bytes in all, else unchanged (shuffle join).

    ``df`` should be cheap to read: a written table or a tiny input.
    """
    width = sum((_bytes(F.col(f"`{f.name}`"), f.dataType) for f in df.schema), F.lit(0)).cast("long")
    size = df.limit(limit + 1).agg(F.count("*").alias("n"), F.coalesce(F.sum(width), F.lit(0)).alias("bytes")).first()
    return F.broadcast(df) if size["n"] <= limit and size["bytes"] <= most else df
