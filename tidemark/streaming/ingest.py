"""Continuous ingest of messages into the event table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tidemark.sources.messages import decode_messages, rejected_messages


def run(writer: DataStreamWriter, checkpoint: str, continuous: bool) -> StreamingQuery:
    """Start a stream; without ``continuous`` it takes what is there and ends.

    The checkpoint keeps the position in the source, in place of a consumer group.
    """
    writer = writer.option("checkpointLocation", checkpoint)
    if not continuous:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def run_of(batch: DataFrame) -> str:
    """The id of the stream that a micro-batch belongs to; it is kept in the checkpoint."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"


def ingest_all(values: DataFrame, path: str, rejects: str, checkpoint: str, continuous: bool = False) -> StreamingQuery:
    """Events and rejects from one reading of the messages.

    Each micro-batch replaces its own folder of either output, so a replayed one counts once.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        folder = f"run={run_of(batch)}/batch_id={batch_id}"
        batch = batch.persist()
        try:
            events = decode_messages(batch).withColumn("event_date", F.to_date("timestamp"))
            events.write.mode("overwrite").partitionBy("event_date").parquet(f"{path}/{folder}")
            rejected_messages(batch).write.mode("overwrite").text(f"{rejects}/{folder}")
        finally:
            batch.unpersist()

    return run(values.writeStream.foreachBatch(write), checkpoint, continuous)


def ingest(values: DataFrame, path: str, checkpoint: str, continuous: bool = False) -> StreamingQuery:
    """Append decoded events, one folder per day, each message exactly once."""
    events = decode_messages(values).withColumn("event_date", F.to_date("timestamp"))
    writer = events.writeStream.format("parquet").partitionBy("event_date").option("path", path)
    return run(writer, checkpoint, continuous)


def store_rejects(values: DataFrame, path: str, checkpoint: str, continuous: bool = False) -> StreamingQuery:
    """Keep the text of messages that do not decode."""
    writer = rejected_messages(values).writeStream.format("text").option("path", path)
    return run(writer, checkpoint, continuous)
