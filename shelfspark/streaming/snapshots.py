"""Optional: silver rows as a stream, each batch replacing its days of a snapshot table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shelfspark.operators.merge import dynamic_overwrite


def stream_snapshots(rows: DataFrame, table: str, checkpoint: str, key: str = "id", date: str = "snapshot_date") -> StreamingQuery:
    """Runs through what is there and stops. Within a batch the last row in ``ts`` order of a (day, key) stays."""

    def write(batch: DataFrame, _: int) -> None:
        last = batch.groupBy(date, key).agg(*[F.max_by(c, "ts").alias(c) for c in batch.columns if c not in (date, key)])
        names = batch.sparkSession.table(table).columns
        # One write replaces every day of the batch and no other.
        with dynamic_overwrite(batch.sparkSession):
            last.select(*names).write.mode("overwrite").insertInto(table, overwrite=True)

    return rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
