"""Rollups maintained from a stream.

Each micro-batch writes its own partial rows under ``source=S/run=R/batch_id=N``, as a further
version when the batch is replayed. The run of a stream is the id that its
checkpoint holds, so a stream begun anew writes beside what is there. Partials
merge in any order, so late events need no watermark and no state is kept between
batches. :mod:`tidemark.sinks.state` reads and compacts the folders.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.time import yyyymm
from tidemark.operators.rollups import counts_of, day_state, members_of, rollup_minute
from tidemark.sinks.state import next_version
from tidemark.streaming.ingest import run, run_of

BatchWriter = Callable[[DataFrame, int], None]


def write_batch(rows: DataFrame, time_key: str, path: str, source: str, run_id: str, batch_id: int) -> None:
    """Write partial rows as the newest version of a batch; busy months get several files, quiet ones share a task."""
    folder = next_version(rows.sparkSession, path, source, run_id, batch_id)
    monthly = rows.withColumn("month", yyyymm(F.col(time_key))).hint("rebalance", "month")
    monthly.write.mode("overwrite").partitionBy("month").parquet(folder)


def write_minute_batch(events: DataFrame, path: str, source: str, run_id: str, batch_id: int) -> None:
    """Partial minute counts of one batch; also for batch jobs, a backfill for example."""
    write_batch(rollup_minute(events), "minute", path, source, run_id, batch_id)


def minute_writer(path: str, source: str = "stream") -> BatchWriter:
    """:func:`write_minute_batch` for a stream."""

    def write(batch: DataFrame, batch_id: int) -> None:
        write_minute_batch(batch, path, source, run_of(batch), batch_id)

    return write


def write_day_batch(events: DataFrame, path: str, source: str, batch_id: int, run_id: str = "batch") -> None:
    """Partial day counts and members of one batch of one source, from one aggregation of its events.

    Also for batch jobs: each copy into a serving table adds its batch.
    """
    write_day_state(day_state(events), path, source, batch_id, run_id)


def write_day_state(state: DataFrame, path: str, source: str, batch_id: int, run_id: str) -> None:
    """Counts and members of a :func:`day_state` as a batch."""
    state = state.persist()
    try:
        write_batch(counts_of(state), "date", f"{path}/counts", source, run_id, batch_id)
        write_batch(members_of(state), "date", f"{path}/members", source, run_id, batch_id)
    finally:
        state.unpersist()


def day_writer(path: str, source: str) -> BatchWriter:
    """:func:`write_day_batch` for a stream."""

    def write(batch: DataFrame, batch_id: int) -> None:
        write_day_batch(batch, path, source, batch_id, run_of(batch))

    return write


def maintain(events: DataFrame, writer: BatchWriter, checkpoint: str, continuous: bool = False) -> StreamingQuery:
    """Run a batch writer over a stream of events."""
    return run(events.writeStream.foreachBatch(writer), checkpoint, continuous)
