"""Incremental publishing: each micro-batch of records goes through the same plan as a daily batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..plans.publish import publish_to


def publish_stream(records: DataFrame, root: str, checkpoint: str, day_column: str = "publish_date") -> DataStreamWriter:
    """A writer that publishes each micro-batch of ``records`` (business columns, ``seq`` and a date), one day after the
    other. A day may come in several batches: its list is that of all of them. A batch that is delivered twice changes
    nothing: a second run of a day counts no listing again."""

    def each(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            for (day,) in batch.select(F.col(day_column).cast("string")).distinct().orderBy(day_column).collect():
                publish_to(batch.filter(F.col(day_column).cast("string") == day).drop(day_column), root, day, now=f"{day}T00:00:00Z", parts=True)
        finally:
            batch.unpersist()

    return records.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)


def windowed_counts(events: DataFrame, time: str, late: str = "10 minutes", window: str = "1 hour") -> DataFrame:
    """Records per portal and window of event time; rows later than ``late`` behind the watermark go."""
    return events.withWatermark(time, late).groupBy(F.window(time, window), "portal").agg(F.count("*").alias("n"))
