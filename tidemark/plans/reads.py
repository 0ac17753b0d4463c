"""Parameterised reads over rollups and serving tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.time import Moment, day, moment, ntz
from tidemark.operators.rollups import merge_counts
from tidemark.schemas import DAY_KEYS, MINUTE_KEYS
from tidemark.sinks.hierarchy import CoarseRollup

# Default window and row limit of the top report.
DEFAULT_START = dt.date(2025, 4, 12)
DEFAULT_END = dt.date(2025, 5, 16)
DEFAULT_LIMIT = 10


def _months(start: dt.date, end: dt.date) -> Column:
    """The month partitions that a closed range touches."""
    return F.col("month").between(start.year * 100 + start.month, end.year * 100 + end.month)


def top_repos(
    rollup: DataFrame,
    start_date: dt.date | str = DEFAULT_START,
    end_date: dt.date | str = DEFAULT_END,
    repo_names: Sequence[str] | None = None,
    event_types: Sequence[str] | None = None,
    group_by: Sequence[str] = (),
    limit: int = DEFAULT_LIMIT,
) -> DataFrame:
    """Largest merged counts over a closed date range, by the chosen columns.

    Without ``group_by`` the answer is the grand total, 0 for an empty range.
    Equal counts are ordered by the grouping columns.
    """
    _check_columns(group_by, DAY_KEYS)
    start, end = day(start_date), day(end_date)
    conditions = [F.col("date").between(start, end)]
    if "month" in rollup.columns:
        conditions.append(_months(start, end))
    return _report(rollup.filter(reduce(and_, conditions)), repo_names, event_types, group_by, limit)


def top_repos_coarse(
    rollup: CoarseRollup,
    start_date: dt.date | str = DEFAULT_START,
    end_date: dt.date | str = DEFAULT_END,
    repo_names: Sequence[str] | None = None,
    event_types: Sequence[str] | None = None,
    group_by: Sequence[str] = (),
    limit: int = DEFAULT_LIMIT,
) -> DataFrame:
    """:func:`top_repos` from year and month partials, with days at the edges only; it cannot group by date."""
    _check_columns(group_by, [name for name in DAY_KEYS if name != "date"])
    return _report(rollup.rows(start_date, end_date), repo_names, event_types, group_by, limit)


def _check_columns(group_by: Sequence[str], known: Sequence[str]) -> None:
    unknown = [name for name in group_by if name not in known]
    if unknown:
        raise ValueError(f"cannot group by {unknown}; choose from {list(known)}")


def _report(
    rows: DataFrame, repo_names: Sequence[str] | None, event_types: Sequence[str] | None, group_by: Sequence[str], limit: int
) -> DataFrame:
    for name, values in (("repo_name", repo_names), ("event_type", event_types)):
        if values is not None:
            rows = rows.filter(F.col(name).isin(list(values)))
    if not group_by:
        total = rows.agg(F.coalesce(F.sum("cnt"), F.lit(0)).cast("bigint").alias("count"))
        return total.limit(limit)
    return merge_counts(rows, *group_by).orderBy(F.desc("count"), *group_by).limit(limit)


def events_stats(rollup: DataFrame, start_ts: Moment, end_ts: Moment) -> DataFrame:
    """Merged counts per minute and type over a closed range, largest first."""
    start, end = moment(start_ts), moment(end_ts)
    condition = F.col("minute").between(ntz(start), ntz(end))
    if "month" in rollup.columns:
        condition &= _months(start, end)
    rows = rollup.filter(condition)
    return merge_counts(rows, *MINUTE_KEYS).orderBy(F.desc("count"), *MINUTE_KEYS)


def last_event_date(recent: DataFrame, historic: DataFrame, as_of: Moment) -> DataFrame:
    """The latest event of both tables, but no earlier than a month before ``as_of``.

    Rows at or below that floor cannot be the answer, so they are filtered out
    before the maximum: the scan touches the last month only.
    """
    floor = ntz(as_of) - F.expr("INTERVAL 1 MONTH")

    def latest(events: DataFrame) -> DataFrame:
        newer = events.filter(F.col("created_at") > floor)
        if "event_date" in events.columns:
            newer = newer.filter(F.col("event_date") >= F.to_date(floor))
        return newer.agg(F.max("created_at").alias("last_date"))

    both = latest(recent).unionByName(latest(historic))
    return both.agg(F.greatest(F.max("last_date"), floor).alias("last_date"))
