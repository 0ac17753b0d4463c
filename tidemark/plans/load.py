"""Load landed archives into the lake: one job per call, repeatable."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.time import Moment, day, moment
from tidemark.operators.hours import pending_hours_range, unloaded_hours
from tidemark.schemas import RAW_EVENT
from tidemark.sinks.tables import LakeTable, SliceReport
from tidemark.sources.archive import ARCHIVE_NAME, archive_paths, landed_hours, read_archive, typed_events


@dataclass(frozen=True)
class LoadReport:
    """Counts of one load, the hours whose archive had not landed, and the rows left out as a frame to store or inspect."""

    slice: SliceReport
    absent: list[dt.datetime]
    rejects: DataFrame


HOUR = dt.timedelta(hours=1)


def load_archives(table: LakeTable, landing: str, hours: Sequence[dt.datetime], name: str = ARCHIVE_NAME) -> LoadReport:
    """Replace what the lake holds of the archives of some hours with what has landed of them.

    An archive is read by one task, which writes what it read; nothing is shuffled. A row
    belongs to the archive that it came in, however far from the archive's hour it lies, so loads by hour, day and range
    agree, in any order, and rows of other archives stay. An archive that has not landed is reported and keeps
    what the table has. Fails when not one has landed.

    Lines that do not parse, or have no usable time, are the rejects. The ledger gets a row for each archive, last,
    so that a load that failed counts as not done.
    """
    present = landed_hours(table.spark, archive_paths(landing, hours, name))
    absent = sorted(set(hours) - set(present))
    events = typed_events(read_archive(table.spark, archive_paths(landing, present, name), with_hour=True))
    sound = F.col("_corrupt_record").isNull() & F.col("created_at").isNotNull()
    report = table.replace_archives(events, present, sound)
    # a line counts as corrupt by the columns that are parsed, so the rejects need all of them, whatever is selected later
    every = F.xxhash64(*RAW_EVENT.fieldNames()) >= F.lit(-(1 << 63))
    rejects = events.filter(every & ~sound)
    table.ledger().record(present, table.archive_counts(present), rejects if report.outside else None)
    return LoadReport(report, absent, rejects.drop("archive_hour"))


def load_slice(
    table: LakeTable, landing: str, start: Moment, end: Moment, name: str = ARCHIVE_NAME
) -> LoadReport:
    """:func:`load_archives` for the hours of [start, end)."""
    start, end = moment(start), moment(end)
    return load_archives(table, landing, [start + k * HOUR for k in range(int((end - start) / HOUR))], name)


def load_hour(
    table: LakeTable, landing: str, date: dt.date | str, hour: int, name: str = ARCHIVE_NAME
) -> LoadReport:
    start = dt.datetime.combine(day(date), dt.time(hour))
    return load_slice(table, landing, start, start + dt.timedelta(hours=1), name)


def load_day(table: LakeTable, landing: str, date: dt.date | str, name: str = ARCHIVE_NAME) -> LoadReport:
    return load_range(table, landing, date, date, name)


def load_range(
    table: LakeTable,
    landing: str,
    from_date: dt.date | str,
    to_date: dt.date | str,
    name: str = ARCHIVE_NAME,
) -> LoadReport:
    """All days from ``from_date`` to ``to_date``, both included, as one job."""
    start = dt.datetime.combine(day(from_date), dt.time())
    end = dt.datetime.combine(day(to_date), dt.time()) + dt.timedelta(days=1)
    return load_slice(table, landing, start, end, name)


def load_pending(
    table: LakeTable, landing: str, high_water: DataFrame, now: Moment, name: str = ARCHIVE_NAME
) -> LoadReport | None:
    """Catch up: all hours after the one holding ``last_date`` and before the running one, as one job.

    The mark moves past hours that had not landed; the report names them, and :func:`load_missing` finds them later.
    """
    last = high_water.select("last_date").first()[0]
    start = last.replace(minute=0, second=0, microsecond=0) + dt.timedelta(hours=1)
    end = moment(now).replace(minute=0, second=0, microsecond=0)
    return load_slice(table, landing, start, end, name) if start < end else None


def load_missing(
    table: LakeTable, landing: str, since: Moment, now: Moment, name: str = ARCHIVE_NAME
) -> LoadReport | None:
    """Catch up by the ledger: all archives from ``since`` to the running hour that were never loaded and have landed.

    Finds archives that land after later ones were loaded, which a mark has passed. None if there is nothing to do.
    """
    calendar = table.spark.createDataFrame([(moment(since), moment(now))], "start TIMESTAMP_NTZ, end TIMESTAMP_NTZ")
    missing = unloaded_hours(pending_hours_range(calendar), table.ledger().read())
    hours = [row["hour"] for row in missing.orderBy("hour").collect()]  # of the calendar, 8,760 a year
    if not hours or not (present := landed_hours(table.spark, archive_paths(landing, hours, name), strict=False)):
        return None
    return load_archives(table, landing, present, name)


def rows_per_archive(events: DataFrame) -> DataFrame:
    """Rows read from each archive hour; a scan of the archives, see :meth:`LakeTable.archive_counts` for what was loaded."""
    return events.groupBy("archive_hour").agg(F.count("*").alias("rows"))
