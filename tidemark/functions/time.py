"""Time expressions over UTC wall-clock timestamps."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

Moment = dt.datetime | str


def moment(value: Moment) -> dt.datetime:
    """Accept a naive UTC datetime or its ISO text."""
    parsed = dt.datetime.fromisoformat(value) if isinstance(value, str) else value
    if parsed.tzinfo is not None:
        parsed = parsed.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return parsed


def day(value: dt.date | str) -> dt.date:
    return dt.date.fromisoformat(value) if isinstance(value, str) else value


def ntz(value: Moment) -> Column:
    """A TIMESTAMP_NTZ literal (a plain datetime literal would carry a time zone)."""
    return F.lit(moment(value).isoformat(sep=" ")).cast("timestamp_ntz")


_ZONE = r"(?:\s*(?:Z|UTC|GMT)|\s*(?:UTC|GMT)?([+-])(\d{1,2})(?::?(\d{2}))?)$"
#: A zone by name, which the text alone does not turn into an offset.
_NAMED = r":\d{1,2}(?:\.\d*)?\s*\[?[A-Za-z]"
_DATE_FIRST = r"^\s*[+-]?\d{4,6}-\d"
#: Text whose cast is the answer: date and time, in UTC by ``Z`` or by default.
_PLAIN = r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}:\d{2}(?:\.\d{1,6})?Z?\z"


def parse_utc(text: Column) -> Column:
    """Timestamp text to UTC wall-clock time; NULL when it does not parse, has no date, or names a zone.

    The offset is taken from the text, so the session zone plays no part. Text
    without one is UTC already. ``Z``, ``UTC`` and ``GMT`` are offsets; other names, as ``PST`` or ``Europe/Paris``,
    would be dropped by the cast and are refused. Plain text takes one match and one cast; only other text is taken apart.
    """
    timed = text.rlike(_DATE_FIRST) & text.rlike(r"\d:")  # a bare date ends in what looks like an offset
    local = F.when(timed, F.regexp_replace(text, _ZONE, "")).when(text.rlike(_DATE_FIRST), text)
    sign = F.when(timed, F.regexp_extract(text, _ZONE, 1))
    hours = F.regexp_extract(text, _ZONE, 2).try_cast("int")
    minutes = F.coalesce(F.regexp_extract(text, _ZONE, 3).try_cast("int"), F.lit(0))
    offset = F.make_dt_interval(hours=hours, mins=minutes)
    parsed = F.when(~local.rlike(_NAMED), local).try_cast("timestamp_ntz")
    other = F.when(sign == "+", parsed - offset).when(sign == "-", parsed + offset).otherwise(parsed)
    return F.when(text.rlike(_PLAIN), text.try_cast("timestamp_ntz")).otherwise(other)


# date_trunc would go through TIMESTAMP and so through the session zone, which
# has hours that do not exist; fields of a TIMESTAMP_NTZ do not depend on it.


def _second(ts: Column) -> Column:
    """Seconds of the minute with their fraction."""
    return F.extract(F.lit("SECOND"), ts)


def trunc_millis(ts: Column) -> Column:
    seconds = _second(ts)
    return ts - F.make_dt_interval(secs=seconds - F.floor(seconds * 1000) / 1000)


def start_of_minute(ts: Column) -> Column:
    return ts - F.make_dt_interval(secs=_second(ts))


def start_of_hour(ts: Column) -> Column:
    return ts - F.make_dt_interval(mins=F.minute(ts), secs=_second(ts))


def yyyymm(ts: Column) -> Column:
    return F.year(ts) * 100 + F.month(ts)


def within(ts: Column, start: Moment, end: Moment) -> Column:
    """start <= ts < end, as a plain range so that it reaches the scan."""
    return (ts >= ntz(start)) & (ts < ntz(end))
