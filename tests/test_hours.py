"""Pending and missing hours, and the archives they name."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import content
from tidemark.operators.hours import missing_hours, pending_hours, pending_hours_range, plan_loads

D = dt.datetime


def _frame(spark, name, *stamps):
    return spark.createDataFrame([(s,) for s in stamps], f"{name} STRING").select(
        F.col(name).cast("timestamp_ntz").alias(name)
    )


def _hours(frame):
    return sorted(row["hour"] for row in frame.collect())


@pytest.mark.parametrize(
    "last, now, expected",
    [
        ("2024-01-01 05:59:59", "2024-01-01 08:30:00", [D(2024, 1, 1, 6), D(2024, 1, 1, 7)]),
        ("2024-01-01 05:00:00", "2024-01-01 05:10:00", []),
        ("2024-01-01 04:59:00", "2024-01-01 05:10:00", []),
        ("2024-01-01 09:00:00", "2024-01-01 05:10:00", []),
        ("2023-12-31 22:15:00", "2024-01-01 01:00:00", [D(2023, 12, 31, 23), D(2024, 1, 1, 0)]),
        (None, "2024-01-01 01:00:00", []),
    ],
)
def test_pending_after_the_loaded_hour_and_before_the_running_one(spark, last, now, expected):
    assert _hours(pending_hours(_frame(spark, "last_date", last), now)) == expected


def test_manual_range_includes_start_and_excludes_end(spark):
    end = F.lit("2024-01-02 01:00:00").cast("timestamp_ntz")
    bounds = _frame(spark, "start", "2024-01-01 22:00:00").withColumn("end", end)
    assert _hours(pending_hours_range(bounds)) == [D(2024, 1, 1, 22), D(2024, 1, 1, 23), D(2024, 1, 2, 0)]


def test_archive_names_have_no_leading_zero(spark):
    hours = _frame(spark, "hour", "2023-12-31 23:00:00", "2024-01-01 00:00:00")
    assert content(plan_loads(hours), "archive") == [("2023-12-31-23.json.gz",), ("2024-01-01-0.json.gz",)]


@given(offsets=st.sets(st.integers(0, 60), max_size=12))
@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_missing_hours_fill_every_gap(spark, offsets):
    start = D(2023, 12, 30, 20)
    loaded = {start + dt.timedelta(hours=o) for o in offsets}
    stamps = [(h + dt.timedelta(minutes=m)).isoformat(" ") for h in loaded for m in (0, 59)]
    span = (max(loaded) - min(loaded)).total_seconds() / 3600 if loaded else 0
    want = {min(loaded) + dt.timedelta(hours=i) for i in range(int(span))} - loaded if loaded else set()
    assert _hours(missing_hours(_frame(spark, "created_at", *stamps))) == sorted(want)
