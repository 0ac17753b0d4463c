"""Hourly gzip JSON archives, named ``YYYY-MM-DD-H.json.gz`` by UTC hour."""

from __future__ import annotations

import calendar
import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.payload import derive_columns
from tidemark.functions.time import Moment, moment, parse_utc
from tidemark.schemas import LAKE, RAW_EVENT
from tidemark.session import list_paths

# The archive name (hour without leading zero) and its pattern.
ARCHIVE_NAME = "{stem}.json.gz"
_STEM_PATTERN = r"(\d{4}-\d{2}-\d{2})-(\d{1,2})\.json\.gz"


def archive_stems(start: Moment, end: Moment) -> list[str]:
    """Glob stems covering every hour of [start, end).

    Whole years, months and days become one stem each, so a range of decades
    still gives a short list.
    """
    cursor, end = moment(start), moment(end)
    stems = []
    while cursor < end:
        hour = dt.timedelta(hours=1)
        midnight = cursor.hour == 0
        units = (
            (midnight and cursor.month == cursor.day == 1,
             dt.timedelta(days=366 if calendar.isleap(cursor.year) else 365), f"{cursor:%Y}-*"),
            (midnight and cursor.day == 1,
             dt.timedelta(days=calendar.monthrange(cursor.year, cursor.month)[1]), f"{cursor:%Y-%m}-*"),
            (midnight, dt.timedelta(days=1), f"{cursor:%Y-%m-%d}-*"),
            (True, hour, f"{cursor:%Y-%m-%d}-{cursor.hour}"),
        )
        length, stem = next((n, s) for aligned, n, s in units if aligned and (n == hour or cursor + n <= end))
        stems.append(stem)
        cursor += length
    return stems


def archive_glob(landing: str, start: Moment, end: Moment, name: str = ARCHIVE_NAME) -> str:
    """One path pattern for all archives of [start, end); hours not landed are simply absent."""
    names = [name.format(stem=stem) for stem in archive_stems(start, end)]
    pattern = names[0] if len(names) == 1 else "{" + ",".join(names) + "}"
    return f"{landing.rstrip('/')}/{pattern}"


def archive_paths(landing: str, hours: Sequence[dt.datetime], name: str = ARCHIVE_NAME) -> list[str]:
    """Path patterns for the archives of some hours: one for each stretch of them without a gap."""
    ordered, paths, first = sorted(set(hours)), [], 0
    for i, hour in enumerate(ordered):
        if i + 1 == len(ordered) or ordered[i + 1] != hour + dt.timedelta(hours=1):
            paths.append(archive_glob(landing, ordered[first], hour + dt.timedelta(hours=1), name))
            first = i + 1
    return paths


def _archive_hour(path: Column) -> Column:
    name = F.regexp_extract(path, _STEM_PATTERN, 0)  # one match for each row
    date, hour = F.substring(name, 1, 10), F.substring_index(F.substring(name, 12, 3), ".", 1)
    return F.concat(date, F.lit(" "), F.lpad(hour, 2, "0"), F.lit(":00:00")).try_cast("timestamp_ntz")


def landed_hours(spark: SparkSession, paths: list[str], strict: bool = True) -> list[dt.datetime]:
    """Hours whose archive is there, from the listing alone; one row per hour of the calendar at most.

    Fails when there is none, unless not ``strict``.
    """
    there = [path for path in paths if list_paths(spark, path)]
    if not there and not strict:
        return []
    files = spark.read.format("binaryFile").load(there or paths).select(_archive_hour(F.col("path")).alias("hour"))
    return sorted(row["hour"] for row in files.distinct().collect() if row["hour"] is not None)


def read_archive(spark: SparkSession, paths: str | list[str], with_hour: bool = False) -> DataFrame:
    """Scan archives with the fixed schema (no inference pass), fields matched by name.

    ``with_hour`` adds ``archive_hour``, taken from the path. Unparsable lines
    keep their text in ``_corrupt_record``. A gzip file is one task: the
    parallelism of a load is its number of hours.
    """
    raw = spark.read.schema(RAW_EVENT).json(paths)
    if not with_hour:
        return raw
    return raw.withColumn("archive_hour", _archive_hour(F.col("_metadata.file_path")))


def typed_events(raw: DataFrame) -> DataFrame:
    """Archive rows with a parsed event time and the payload-derived columns."""
    return derive_columns(raw.withColumn("created_at", parse_utc(F.col("created_at"))))


def conform_to_lake(events: DataFrame) -> DataFrame:
    """The pinned lake columns, in order, nested fields matched by name."""
    return events.to(LAKE)
