"""Archive scan, derived columns and archive names."""

import datetime as dt
import json
from fnmatch import fnmatchcase

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import content, event, write_archive
from tidemark.schemas import LAKE
from tidemark.functions.payload import derive_columns, derive_from_variant, with_variant
from tidemark.sources.archive import archive_glob, archive_stems, conform_to_lake, read_archive, typed_events
from workload.adapters import archive_lines

HOUR = "2024-03-05-7"


def _read(spark, tmp_path, rows):
    write_archive(tmp_path, HOUR, rows)
    return typed_events(read_archive(spark, f"{tmp_path}/{HOUR}.json.gz"))


def test_derived_columns_by_type(spark, tmp_path):
    payload = {"action": "opened", "ref": "refs/heads/x", "ref_type": "branch", "number": 12}
    kinds = (
        "IssuesEvent PullRequestEvent IssueCommentEvent WatchEvent PushEvent CreateEvent DeleteEvent ForkEvent".split()
    )
    rows = [event("2024-03-05T07:00:00Z", kind, payload) for kind in kinds]
    got = {r["type"]: r for r in _read(spark, tmp_path, rows).collect()}
    assert {k for k in kinds if got[k]["action"]} == {
        "IssuesEvent", "PullRequestEvent", "IssueCommentEvent", "WatchEvent"}
    assert {k for k in kinds if got[k]["ref"]} == {"PushEvent", "CreateEvent", "DeleteEvent"}
    assert {k for k in kinds if got[k]["ref_type"]} == {"CreateEvent", "DeleteEvent"}
    assert {k: got[k]["number"] for k in kinds if got[k]["number"]} == {"IssuesEvent": 12, "PullRequestEvent": 12}


def test_payload_field_absent_in_the_whole_file(spark, tmp_path):
    rows = [event("2024-03-05T07:00:00Z", "CreateEvent", {"ref": "x"})]
    (row,) = _read(spark, tmp_path, rows).collect()
    assert (row["ref"], row["ref_type"]) == ("x", None)


def test_number_that_is_no_integer_is_null(spark, tmp_path):
    rows = [event("2024-03-05T07:00:00Z", "IssuesEvent", {"number": value}) for value in ("abc", 3000000000, None, 5)]
    assert [r["number"] for r in _read(spark, tmp_path, rows).orderBy("id").collect()].count(None) == 3


def test_payload_keeps_its_text(spark, tmp_path):
    payload = {"zeta": 1, "alpha": {"b": None, "a": [1, 2.50]}}
    (row,) = _read(spark, tmp_path, [event("2024-03-05T07:00:00Z", payload=payload)]).collect()
    assert json.loads(row["payload"]) == payload
    assert row["payload"].index("zeta") < row["payload"].index("alpha")


def test_absent_blocks_are_null_and_numbers_become_text(spark, tmp_path):
    rows = [event("2024-03-05T07:00:00Z", actor=None), event("2024-03-05T07:00:00Z")]
    first, second = conform_to_lake(_read(spark, tmp_path, rows)).orderBy(F.col("id").cast("int")).collect()
    assert first["actor"] is None and first["org"] is None
    assert second["actor"]["id"] == "1" and second["actor"]["display_login"] is None


def test_nested_fields_are_matched_by_name(spark, tmp_path):
    events = _read(spark, tmp_path, [event("2024-03-05T07:00:00Z")])
    names = LAKE["actor"].dataType.names
    conformed = conform_to_lake(events.withColumn("actor", F.struct(*[F.col(f"actor.{n}") for n in sorted(names)])))
    assert content(conformed, "actor.login", "actor.url") == [("ann", "u")]
    assert conformed.schema["actor"].dataType.names == names


def test_time_with_offset_and_bad_time(spark, tmp_path):
    rows = [event("2024-03-05T09:30:00+02:00"), event("soon")]
    got = [r["created_at"] for r in _read(spark, tmp_path, rows).orderBy(F.col("id").cast("int")).collect()]
    assert got == [dt.datetime(2024, 3, 5, 7, 30), None]


def test_unparsable_line_is_kept_as_text(spark, tmp_path):
    got = _read(spark, tmp_path, ["{broken", event("2024-03-05T07:00:00Z")])
    assert content(got.filter("id IS NULL"), "_corrupt_record") == [("{broken",)]


def test_archive_hour_comes_from_the_name(spark, tmp_path):
    for stem in ("2023-12-31-23", "2024-01-01-0"):
        write_archive(tmp_path, stem, [event("2024-01-01T00:00:00Z")])
    frame = read_archive(spark, f"{tmp_path}/*.json.gz", with_hour=True)
    assert content(frame, "archive_hour") == [(dt.datetime(2023, 12, 31, 23),), (dt.datetime(2024, 1, 1),)]


@pytest.mark.parametrize(
    "start, end, stems",
    [
        ("2024-01-01 05:00:00", "2024-01-01 07:00:00", ["2024-01-01-5", "2024-01-01-6"]),
        ("2023-12-31 23:00:00", "2024-01-01 01:00:00", ["2023-12-31-23", "2024-01-01-0"]),
        ("2024-01-31", "2024-03-01", ["2024-01-31-*", "2024-02-*"]),
        ("2023-01-01", "2025-01-02", ["2023-*", "2024-*", "2025-01-01-*"]),
        ("2024-01-01", "2024-01-01", []),
    ],
)
def test_stems(start, end, stems):
    assert archive_stems(start, end) == stems


@given(
    st.datetimes(dt.datetime(2015, 1, 1), dt.datetime(2018, 1, 1)),
    st.integers(1, 30000),
)
@settings(max_examples=60, deadline=None)
def test_stems_cover_each_hour_once(first, hours):
    start = first.replace(minute=0, second=0, microsecond=0)
    stems = archive_stems(start, start + dt.timedelta(hours=hours))
    assert len(stems) < 120
    probes = {-1: 0, 0: 1, hours // 2: 1, hours - 1: 1, hours: 0}
    for offset, expected in probes.items():
        moment = start + dt.timedelta(hours=offset)
        stem = f"{moment:%Y-%m-%d}-{moment.hour}"
        assert sum(fnmatchcase(stem, s) for s in stems) == expected


def test_glob_of_one_and_of_several():
    assert archive_glob("/in/", "2024-01-01", "2024-01-02") == "/in/2024-01-01-*.json.gz"
    assert archive_glob("/in", "2024-01-01", "2024-01-03") == "/in/{2024-01-01-*.json.gz,2024-01-02-*.json.gz}"


def test_fields_from_a_parsed_payload_equal_those_from_text(spark):
    payloads = [
        '{"action":"opened","ref":"r","ref_type":"tag","number":7}', '{"action":null,"number":"12"}', '{"number":"x","ref":5}',
        '{"number":3000000000}', "{}", "not json", None, '{"action":"é \\"q\\"","nested":{"action":"no"}}',
    ]
    kinds = ("PushEvent", "IssuesEvent", "CreateEvent", "WatchEvent", "ForkEvent")
    rows = spark.createDataFrame([(k, p) for k in kinds for p in payloads], "type STRING, payload STRING")
    columns = ("type", "payload", "action", "ref", "ref_type", "number")
    from_text = content(derive_columns(rows), *columns)
    assert content(derive_from_variant(with_variant(rows)), *columns) == from_text
    assert with_variant(rows).filter("payload_variant IS NULL").select("payload").distinct().count() == 2


def test_lines_of_archives_are_built_after_the_shuffle(spark):
    """An input of one task must not build all lines alone, and rows are shorter than lines."""
    stamps = ("2024-03-05 07:10:00", "2024-03-05 23:59:59", None)
    events = spark.createDataFrame([(97 * i, s, 5, "click", '{"k": 3}') for i, s in enumerate(stamps)], "event_id BIGINT, ts STRING, user_id BIGINT, event_type STRING, props STRING")
    events = events.withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    plan = archive_lines(events)._jdf.queryExecution().executedPlan().toString()
    above, below = plan.split("Exchange", 1)
    assert "get_json_object" in above and "get_json_object" not in below
    found = {archive: json.loads(line) for line, archive in archive_lines(events).collect() if archive}
    assert {archive: row["id"] for archive, row in found.items()} == {"2024-03-05-7.json.gz": "0", "2024-03-05-23.json.gz": "97"}
    distant = archive_lines(events, distant=True).select("archive").collect()
    assert sorted(row["archive"] or "" for row in distant) == ["", "2024-03-04-7.json.gz", "2024-03-06-23.json.gz"]
