"""Kafka or dropped files -> raw log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from paylake.sources import files
from paylake.sources.tables import Lake

RAW_EVENTS = "raw_events"

#: Topics whose files a task keeps open at once; with more it sorts the rest.
OPEN_FILES = 16


def append_stream(
    df: DataFrame, target: str, checkpoint: str, fmt: str = "parquet"
) -> StreamingQuery:
    """Append a stream to a table until the source is drained.

    ``target`` is a catalog name, or a folder if it contains a slash. A folder
    is partitioned by topic, so that a reader of one topic opens only its files.
    """
    writer = (
        df.writeStream.format(fmt)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    if fmt == "parquet":
        writer = writer.option("compression", files.CODEC)
        # The sink takes no other options of a write. A file for each topic is open in each task.
        if df.sparkSession.conf.get(files.ROW_GROUP_SETTING, None) is None:
            df.sparkSession.conf.set(files.ROW_GROUP_SETTING, str(files.ROW_GROUP))
    if "topic" in df.columns:
        writer = writer.partitionBy("topic")
        # A file for each topic stays open, so the text of the records is not sorted by topic before it is written.
        df.sparkSession.conf.set("spark.sql.maxConcurrentOutputFileWriters", str(OPEN_FILES))
    return writer.start(target) if "/" in target else writer.toTable(target)


def ingest(bronze: DataFrame, lake: Lake, checkpoint: str) -> None:
    """Append the prepared stream to the raw log and wait for the drain."""
    target = lake.location("bronze", RAW_EVENTS)
    append_stream(bronze, target, checkpoint, lake.fmt).awaitTermination()
