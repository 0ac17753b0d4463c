"""Time text: offsets count, names of zones are refused."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import session_conf
from tidemark.functions.time import parse_utc
from tidemark.operators.rollups import rollup_minute
from tidemark.sources.messages import decode_messages, rejected_messages

D = dt.datetime


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_zones_in_time_text(spark, zone):
    want = {
        "2024-01-01 10:00:00": D(2024, 1, 1, 10), "2024-01-01T10:00:00Z": D(2024, 1, 1, 10),
        "2024-01-01 10:00:00.25 UTC": D(2024, 1, 1, 10, 0, 0, 250000), "2024-01-01 10:00:00 GMT": D(2024, 1, 1, 10),
        "2024-01-01 10:00:00+01:30": D(2024, 1, 1, 8, 30), "2024-01-01T10:00-5": D(2024, 1, 1, 15),
        "2024-01-01 10:00:00 UTC+1": D(2024, 1, 1, 9), "2024-01-01": D(2024, 1, 1),
        "2024-01-01 10:00:00 Europe/Paris": None, "2024-01-01 10:00:00 PST": None, "2024-01-01T10:00:00[Asia/Tokyo]": None,
        "2024-01-01T10:00:00+01:00[Europe/Paris]": None, "2024-01-01 10:00 EST5EDT": None, "10:00:00": None, "?": None, None: None,
    }
    rows = spark.createDataFrame([(text,) for text in want], "t STRING")
    with session_conf(spark, spark__sql__session__timeZone=zone):
        assert dict(rows.select("t", parse_utc(F.col("t"))).collect()) == want


def test_plain_text_is_no_other_time_than_before(spark):
    """Text with date and time takes a short way; its neighbours in form do not, and agree with it."""
    want = {
        "2024-01-01T10:00:00.123456Z": D(2024, 1, 1, 10, 0, 0, 123456), "2024-01-01 10:00:00.5": D(2024, 1, 1, 10, 0, 0, 500000),
        "2024-01-01 10:00:00.1234567": D(2024, 1, 1, 10, 0, 0, 123456), " 2024-01-01 10:00:00Z ": None,
        "2024-01-01 10:00:00\n": D(2024, 1, 1, 10), "2024-01-01 10:00:00Z\n": D(2024, 1, 1, 10), "2024-13-01 10:00:00": None,
        "2024-02-30T10:00:00Z": None, "2024-01-01 24:00:00": None, "2024-01-01 10:00:00z": None, "": None,
    }
    rows = spark.createDataFrame([(text,) for text in want], "t STRING")
    assert dict(rows.select("t", parse_utc(F.col("t"))).collect()) == want


def test_the_time_of_a_message_is_worked_out_once(spark, tmp_path):
    """However many filters and functions use it."""
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text('{"user_id":1,"ts":"2024-01-01 10:00:01","event_type":"x"}\n')
    rows = decode_messages(spark.read.text(str(tmp_path / "in")))
    plan = rollup_minute(rows.filter(F.second("timestamp") == 1))._jdf.queryExecution().optimizedPlan().toString()
    assert sum("RLIKE" in line for line in plan.splitlines()) == 1
    assert rollup_minute(rows.filter(F.second("timestamp") == 1)).first()["cnt"] == 1


def test_messages_with_a_named_zone_are_rejected(spark):
    text = '{"user_id":1,"ts":"2024-01-01 10:00:00 Europe/Paris","event_type":"x"}'
    values = spark.createDataFrame([(text,)], "value STRING")
    assert decode_messages(values).isEmpty()
    assert rejected_messages(values).first()["value"] == text
