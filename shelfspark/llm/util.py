"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfspark.storage import BROADCAST_ROWS, materialize, shared_dir, small

__all__ = ["BROADCAST_ROWS", "CHUNK_BYTES", "chunks", "held_out", "mapped", "materialize", "shared_dir", "small"]

#: Text handed to one vectorised step inside a Python worker.
CHUNK_BYTES = 1_000_000

#: Size of a record batch between the JVM and a Python worker.
BATCH_BYTES = 4_000_000


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """True where crc32 of the decimal id falls in ``fold`` of ``folds``; null ids count as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds == fold


def chunks(batches: Iterator[pa.RecordBatch], text: int, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Split record batches so that column ``text`` holds about ``limit`` bytes (one row at least)."""
    for batch in batches:
        start, size = 0, 0
        column = batch.column(text)
        for i, n in enumerate(pa.compute.binary_length(column).to_pylist()):
            n = n or 0
            if i > start and size + n > limit:
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += n
        if batch.num_rows > start:
            yield batch.slice(start)


def mapped(run: Callable[[Iterator], Iterator], schema, drop: Callable[[], None] | None = None) -> Callable[[DataFrame], DataFrame]:
    """For ``DataFrame.transform``: ``mapInArrow`` within bounded memory.

    Batches hold ``BATCH_BYTES`` at most (a session setting, changed only where it has Spark's default). After a partition the
    worker's memory goes back to the system: Python workers are used again by later stages, and what they keep
    would add up over a long job. ``drop`` empties what the operator itself has cached.
    """

    @wraps(run)
    def released(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            if drop is not None:
                drop()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)

    def apply(df: DataFrame) -> DataFrame:
        conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
        if conf.get(key) == "67108864b":
            conf.set(key, str(BATCH_BYTES))
        return df.mapInArrow(released, schema)

    return apply
