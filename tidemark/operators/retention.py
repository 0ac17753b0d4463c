"""One-month retention of the recent-events table."""

from __future__ import annotations

import calendar
import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.time import Moment, moment, ntz


def _month_later(date: dt.date) -> dt.date:
    year, month = date.year + date.month // 12, date.month % 12 + 1
    return dt.date(year, month, min(date.day, calendar.monthrange(year, month)[1]))


def retention_floor(as_of: Moment) -> dt.date:
    """The first date that still lives at ``as_of``: date + 1 month > as_of.

    Adding a clamped month never decreases, so the rule is one lower bound on
    the date, which a scan can prune by.
    """
    as_of = moment(as_of)
    date = as_of.date() - dt.timedelta(days=32)
    while dt.datetime.combine(_month_later(date), dt.time()) <= as_of:
        date += dt.timedelta(days=1)
    return date


def retain_one_month(events: DataFrame, as_of: Moment) -> DataFrame:
    """Rows whose date plus one month lies after ``as_of``."""
    floor = retention_floor(as_of)
    kept = events.filter(F.col("created_at") >= ntz(dt.datetime.combine(floor, dt.time())))
    if "event_date" in events.columns:
        kept = kept.filter(F.col("event_date") >= F.lit(floor))
    return kept
