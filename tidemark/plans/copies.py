"""Copies from the lake to serving and stream tables."""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.time import Moment, day, moment, trunc_millis
from tidemark.operators.events import after_until, between, project_serving
from tidemark.operators.rollups import day_state, difference, rollup_minute
from tidemark.plans.reads import last_event_date
from tidemark.session import list_paths, path_exists, remove_paths
from tidemark.sinks.state import ONCE, open_folder
from tidemark.sinks.tables import ServingTable
from tidemark.streaming.rollups import write_batch, write_day_state


def copy_historic(lake: DataFrame, from_ts: Moment, to_ts: Moment) -> DataFrame:
    """Serving rows with from_ts < created_at <= to_ts."""
    return project_serving(after_until(lake, from_ts, to_ts))


def copy_rt(
    lake: DataFrame,
    from_ts: Moment | None = None,
    to_ts: Moment | None = None,
    high_water: DataFrame | None = None,
    floor: Moment | None = None,
) -> DataFrame:
    """An explicit range, else everything after the ``last_date`` of ``high_water``.

    The high-water mark is a scalar subquery, known only when the query runs.
    ``floor``, a time the mark cannot be below, prunes partitions at planning.
    """
    if from_ts is not None and to_ts is not None:
        return copy_historic(lake, from_ts, to_ts)
    if high_water is None:
        raise ValueError("give both from_ts and to_ts, or a high-water frame")
    mark = high_water.select("last_date").scalar()
    # the mark is cut to milliseconds like the rows it comes from: what shares its
    # millisecond has been copied already
    newer = lake.filter(F.col("created_at") >= mark + F.expr("INTERVAL 0.001 SECOND"))
    if "event_date" in lake.columns:
        newer = newer.filter(F.col("event_date") >= F.to_date(mark))
        if floor is not None:
            newer = newer.filter(F.col("event_date") >= F.lit(moment(floor).date()))
    return project_serving(newer)


def copy_days(lake: DataFrame, first_day: dt.date | str, last_day: dt.date | str) -> DataFrame:
    """What one copy per day over both days and all between would give, as one plan.

    The daily windows are open at the start and closed at the end, so they tile
    (first_day 00:00, last_day + 1 day 00:00] without overlap.
    """
    midnight = dt.time()
    return copy_historic(
        lake,
        dt.datetime.combine(day(first_day), midnight),
        dt.datetime.combine(day(last_day), midnight) + dt.timedelta(days=1),
    )


def backfill(messages: DataFrame, from_ts: Moment, to_ts: Moment) -> DataFrame:
    """Stored messages of a closed time range in the shape of the streamed table."""
    return between(messages, from_ts, to_ts, "ts").select(
        F.col("user_id").try_cast("int").alias("user_id"),
        trunc_millis(F.col("ts")).alias("timestamp"),
        "event_type",
    )


def _taken_back(spark: SparkSession, place: str, state: Callable[[], DataFrame]) -> tuple[DataFrame, int]:
    """What a run had contributed before its transaction began, and the number of the transaction.

    Stored by the first attempt; further ones, after a failure, find it. The number is a time, so a later
    transaction of the run has another.
    """
    stored = [path for path, _ in list_paths(spark, f"{place}/batch_id=*/_SUCCESS")]
    if not stored:
        remove_paths(spark, [place])
        number = int(time.time() * 1000)
        frame = state()
        frame.write.parquet(f"{place}/batch_id={number}")
        return spark.read.schema(frame.schema).parquet(f"{place}/batch_id={number}"), number
    folder = stored[0].rsplit("/", 1)[0]
    return spark.read.schema(state().schema).parquet(folder), int(folder.rsplit("=", 1)[1])


def append_copy(rows: DataFrame, serving: ServingTable, rollup: str, source: str, run_id: str) -> None:
    """Copy rows into the serving table and the daily rollup under ``rollup``, exactly once for each run.

    The serving table keeps the rows under their run, and the rollup takes what the run has there now less what it
    had before. Repeating a run replaces its rows, with what ``rows`` are then, and moves the rollup by the difference; it may
    fail anywhere and be called again, with compactions in between. What it takes back is stored first and removed last; in between the run is
    open and its batches are not merged. A run must not be repeated after retention has dropped days of it.
    """
    before, number = begin_copy(rows, serving, rollup, source, run_id)
    run = f"{ONCE}{run_id}"
    write_day_state(difference(day_state(serving.run_rows(run)), before), rollup, source, number, run)
    remove_paths(rows.sparkSession, _open_folders(rollup, source, run)[::-1])


def begin_copy(rows: DataFrame, serving: ServingTable, rollup: str, source: str, run_id: str) -> tuple[DataFrame, int]:
    """The first half of :func:`append_copy`: what the run had before is stored, and its rows are in the table.

    The run stays open until the whole copy is called, with these rows or others.
    """
    spark, run = rows.sparkSession, f"{ONCE}{run_id}"
    places = _open_folders(rollup, source, run)
    before, number = _taken_back(spark, places[0], lambda: day_state(serving.run_rows(run)))
    spark.createDataFrame([], "open INT").write.mode("overwrite").parquet(places[1])  # marks the other state
    serving.replace_run(rows, run)
    return before, number


def _open_folders(rollup: str, source: str, run: str) -> list[str]:
    return [open_folder(f"{rollup}/{part}", source, run) for part in ("counts", "members")]


def _stamp(value: Moment) -> str:
    return f"{moment(value):%Y%m%dT%H%M%S.%f}"


def append_historic(lake: DataFrame, serving: ServingTable, rollup: str, from_ts: Moment, to_ts: Moment) -> None:
    """Copy (from_ts, to_ts] of the lake into a serving table and its rollup; the same range again replaces its rows."""
    run_id = f"historic-{_stamp(from_ts)}-{_stamp(to_ts)}"
    append_copy(copy_historic(lake, from_ts, to_ts), serving, rollup, "historic", run_id)


def append_recent(lake: DataFrame, recent: ServingTable, historic: DataFrame, rollup: str, as_of: Moment) -> dt.datetime:
    """Copy what is newer than both serving tables into the recent one and its rollup; returns the mark used.

    A second run finds its mark at the newest row of the first and adds nothing. A run that failed is finished first: its
    mark is in its name, so rows of it that did arrive do not move the mark.
    """
    last = _unfinished_mark(recent.spark, rollup)
    if last is None:
        last = last_event_date(recent.read(), historic, as_of).first()["last_date"]
    mark = recent.spark.createDataFrame([(last,)], "last_date TIMESTAMP_NTZ")
    rows = copy_rt(lake, high_water=mark, floor=last)
    append_copy(rows, recent, rollup, "rt", f"rt-after-{_stamp(last)}")
    return last


def _unfinished_mark(spark: SparkSession, rollup: str) -> dt.datetime | None:
    open_runs = [path for path, _ in list_paths(spark, open_folder(f"{rollup}/counts", "rt", f"{ONCE}rt-after-*"))]
    stamps = sorted(path.rsplit("-after-", 1)[1] for path in open_runs)
    return dt.datetime.strptime(stamps[0], "%Y%m%dT%H%M%S.%f") if stamps else None


def append_backfill(messages: DataFrame, events: str, minutes: str, from_ts: Moment, to_ts: Moment) -> None:
    """Put stored messages of a closed range beside the streamed events, and into the minute rollup, exactly once.

    Repeating it replaces what the same range wrote before, as :func:`append_copy` does.
    """
    spark, run = messages.sparkSession, f"{ONCE}backfill-{_stamp(from_ts)}-{_stamp(to_ts)}"
    folder = f"{events}/run={run}/batch_id=0"
    rows = backfill(messages, from_ts, to_ts)

    def stored() -> DataFrame:
        there = path_exists(spark, folder)
        return spark.read.schema(rows.schema).parquet(folder) if there else spark.createDataFrame([], rows.schema)

    place = open_folder(minutes, "backfill", run)
    before, number = _taken_back(spark, place, lambda: rollup_minute(stored()))
    dated = rows.withColumn("event_date", F.to_date("timestamp"))
    dated.write.mode("overwrite").partitionBy("event_date").parquet(folder)
    write_batch(difference(rollup_minute(stored()), before), "minute", minutes, "backfill", run, number)
    remove_paths(spark, [place])
