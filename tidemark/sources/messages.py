"""JSON messages from a topic (or, without a broker, from text files)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.time import parse_utc, trunc_millis


def kafka_options(servers: str, topic: str, starting_offsets: str = "earliest", **options: str) -> dict[str, str]:
    """Options of the source. A first run begins at ``starting_offsets``; later ones go on from their checkpoint."""
    return {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting_offsets, **options}


def kafka_messages(
    spark: SparkSession, servers: str, topic: str, starting_offsets: str = "earliest", **options: str
) -> DataFrame:
    """Message values of a topic. Needs the Kafka connector on the classpath."""
    stream = spark.readStream.format("kafka").options(**kafka_options(servers, topic, starting_offsets, **options)).load()
    return stream.select(F.col("value").cast("string").alias("value"))


def file_messages(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The same one-column stream from newline-separated files."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path).select("value")


def _decoded(values: DataFrame) -> DataFrame:
    # one parse per message; a generator also keeps filters on its output from
    # being rewritten into further parses
    fields = values.select("value", F.json_tuple("value", "user_id", "ts", "event_type").alias("user", "ts", "type"))
    # nor is the time worked out anew for each filter and function of it
    timed = fields.select("value", "user", "type", F.inline(F.array(F.struct(trunc_millis(parse_utc(F.col("ts"))).alias("timestamp")))))
    return timed.select(
        "value",
        F.col("user").try_cast("int").alias("user_id"),
        "timestamp",
        F.col("type").alias("event_type"),
    )


_USABLE = "timestamp IS NOT NULL AND event_type IS NOT NULL"


def decode_messages(values: DataFrame) -> DataFrame:
    """Typed events of the readable messages; works on batch and stream frames.

    A ``user_id`` outside 32 bits becomes NULL; a message without a usable time
    or type is left to :func:`rejected_messages`.
    """
    return _decoded(values).filter(_USABLE).drop("value")


def rejected_messages(values: DataFrame) -> DataFrame:
    """The raw text of every message that :func:`decode_messages` leaves out."""
    return _decoded(values).filter(f"NOT ({_USABLE})").select("value")
