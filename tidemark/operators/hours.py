"""Which archive hours are still to load."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.time import Moment, ntz, start_of_hour
from tidemark.operators.events import DISTANT
from tidemark.sources.archive import ARCHIVE_NAME


def _hours(first: Column, stop: Column) -> Column:
    """Every hour of [first, stop); none when the range is empty."""
    last = stop - F.expr("INTERVAL 1 HOUR")
    return F.explode(F.when(first <= last, F.sequence(first, last, F.expr("INTERVAL 1 HOUR")))).alias("hour")


def pending_hours(high_water: DataFrame, now: Moment) -> DataFrame:
    """Hours after the one holding ``last_date`` and before the running hour."""
    first = start_of_hour(F.col("last_date")) + F.expr("INTERVAL 1 HOUR")
    return high_water.select(_hours(first, start_of_hour(ntz(now))))


def pending_hours_range(bounds: DataFrame) -> DataFrame:
    """Hours from ``start`` (inclusive) to ``end`` (exclusive) of each row."""
    return bounds.select(_hours(start_of_hour(F.col("start")), start_of_hour(F.col("end"))))


def row_hours(events: DataFrame) -> DataFrame:
    """The ``hour`` of each row; a lake table answers from its partition columns, and reads only the times of distant rows."""
    read = start_of_hour(F.col("created_at")).alias("hour")
    if not {"event_date", "event_hour"} <= set(events.columns):
        return events.select(read)
    midnight = F.col("event_date").cast("timestamp_ntz")
    own = events.filter(F.col("event_hour") != DISTANT).select((midnight + F.make_dt_interval(hours=F.col("event_hour"))).alias("hour"))
    return own.unionByName(events.filter(F.col("event_hour") == DISTANT).select(read))


def missing_hours(events: DataFrame) -> DataFrame:
    """Hours between the first and last loaded one that hold no event.

    Events shrink to their distinct hours, and these are taken out of the calendar between the first and the last by
    an anti join; no hour needs its neighbours.
    """
    loaded = row_hours(events).filter("hour IS NOT NULL").distinct()
    bounds = loaded.agg(F.min("hour").alias("start"), F.max("hour").alias("end"))
    return unloaded_hours(pending_hours_range(bounds), loaded)


def unloaded_hours(calendar: DataFrame, loaded: DataFrame) -> DataFrame:
    """The hours of ``calendar`` that are not among the ``hour`` of ``loaded``."""
    return calendar.join(loaded.select("hour"), "hour", "left_anti")


def plan_loads(hours: DataFrame, name: str = ARCHIVE_NAME) -> DataFrame:
    """Dry run: the archive each hour would be read from."""
    before, after = name.split("{stem}")
    stem = F.concat(F.to_date("hour").cast("string"), F.lit("-"), F.hour("hour").cast("string"))
    return hours.select("hour", F.concat(F.lit(before), stem, F.lit(after)).alias("archive"))
