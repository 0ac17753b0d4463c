"""Projection and range selection of event rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.time import Moment, moment, ntz, trunc_millis, within

#: The ``event_hour`` of lake rows outside the hour of their archive. Those of an archive and date share one partition,
#: so an archive has few partitions however many hours its rows are spread over.
DISTANT = -1


def project_serving(lake: DataFrame) -> DataFrame:
    """The five serving columns of lake rows, event time cut to milliseconds.

    Only two nested leaves are named, so the scan reads just those.
    """
    return lake.filter(F.col("created_at").isNotNull()).select(
        F.col("type").alias("event_type"),
        F.col("actor.login").alias("actor_login"),
        F.col("repo.name").alias("repo_name"),
        trunc_millis(F.col("created_at")).alias("created_at"),
        "action",
    )


def default_empty(serving: DataFrame) -> DataFrame:
    """Absent actor and repository names become ''."""
    return serving.withColumns(
        {name: F.coalesce(F.col(name), F.lit("")) for name in ("actor_login", "repo_name")}
    )


def partition_bounds(events: DataFrame, lower: Moment | None, upper: Moment | None, open_end: bool = True) -> list[Column]:
    """The bounds on event_date and event_hour implied by a time range, where the table is partitioned by them.

    Distant rows of the first and last date may lie in the range whatever its hours.
    ``open_end`` excludes ``upper`` itself; a range that ends at midnight then opens no
    folder of the next day.
    """
    if "event_date" not in events.columns:
        return []
    date, bounds = F.col("event_date"), []
    hour = F.col("event_hour") if "event_hour" in events.columns else None
    if lower is not None:
        low = moment(lower)
        bounds.append(date >= F.lit(low.date()))
        if hour is not None and low.hour:
            bounds.append((date > F.lit(low.date())) | (hour >= low.hour) | (hour == DISTANT))
    if upper is not None:
        high = moment(upper) - dt.timedelta(microseconds=1 if open_end else 0)
        bounds.append(date <= F.lit(high.date()))
        if hour is not None and high.hour < 23:
            bounds.append((date < F.lit(high.date())) | (hour <= high.hour))
    return bounds


def _filtered(events: DataFrame, conditions: list[Column]) -> DataFrame:
    for condition in conditions:
        events = events.filter(condition)
    return events


def after_until(events: DataFrame, from_ts: Moment, to_ts: Moment, column: str = "created_at") -> DataFrame:
    """from_ts < column <= to_ts."""
    ts = F.col(column)
    return _filtered(events, [ts > ntz(from_ts), ts <= ntz(to_ts), *partition_bounds(events, from_ts, to_ts, open_end=False)])


def between(events: DataFrame, from_ts: Moment, to_ts: Moment, column: str = "created_at") -> DataFrame:
    """from_ts <= column <= to_ts."""
    return _filtered(
        events, [F.col(column).between(ntz(from_ts), ntz(to_ts)), *partition_bounds(events, from_ts, to_ts, open_end=False)]
    )


def time_slice(events: DataFrame, start: Moment, end: Moment, column: str = "created_at") -> DataFrame:
    """start <= column < end."""
    return _filtered(events, [within(F.col(column), start, end), *partition_bounds(events, start, end)])
