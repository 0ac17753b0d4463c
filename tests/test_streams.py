"""Streamed tables and rollups equal the batch answer, whatever the delivery."""

import datetime as dt
import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from helpers import content, session_conf
from tidemark.operators.rollups import merge_counts, merge_day, rollup_minute
from tidemark.plans.copies import backfill
from tidemark.schemas import DAY_KEYS, DAY_MEMBER, DAY_PARTIAL, MINUTE_KEYS, MINUTE_PARTIAL
from tidemark.session import scratch_dir
from tidemark.sinks.state import RollupState
from tidemark.sources.messages import decode_messages, file_messages
from tidemark.streaming.ingest import ingest, ingest_all, store_rejects
from tidemark.streaming.rollups import day_writer, maintain, minute_writer
from workload import adapters

D = dt.datetime


def _message(minute, second=0, kind="x"):
    return json.dumps({"user_id": 1, "ts": f"2024-01-01 00:{minute:02d}:{second:02d}", "event_type": kind})


def _land(folder, name, *texts):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(t + "\n" for t in texts))


def _run_minutes(spark, folder, path, checkpoint, writer=None):
    events = decode_messages(file_messages(spark, str(folder), max_files_per_trigger=1))
    maintain(events, writer or minute_writer(path), checkpoint).awaitTermination()
    state = RollupState(spark, path, MINUTE_PARTIAL, MINUTE_KEYS)
    return content(merge_counts(state.read(), *MINUTE_KEYS), *MINUTE_KEYS, "count")


def _batch_answer(spark, folder):
    events = decode_messages(spark.read.text(str(folder)))
    return content(merge_counts(rollup_minute(events), *MINUTE_KEYS), *MINUTE_KEYS, "count")


def test_late_events_and_restart(spark, tmp_path):
    folder, path, checkpoint = tmp_path / "in", scratch_dir(spark, "m"), scratch_dir(spark, "c")
    _land(folder, "a.txt", _message(5), _message(6))
    assert len(_run_minutes(spark, folder, path, checkpoint)) == 2
    _land(folder, "b.txt", _message(0), _message(5, 30), "garbage")
    got = _run_minutes(spark, folder, path, checkpoint)
    assert got == [(D(2024, 1, 1, 0, 0), "x", 1), (D(2024, 1, 1, 0, 5), "x", 2), (D(2024, 1, 1, 0, 6), "x", 1)]
    assert got == _batch_answer(spark, folder)


@given(
    files=st.lists(
        st.lists(st.tuples(st.integers(0, 5), st.integers(0, 59), st.sampled_from("ab")), max_size=6),
        min_size=1,
        max_size=3,
    )
)
@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_replayed_batches_equal_the_batch_answer(spark, tmp_path_factory, files):
    folder = tmp_path_factory.mktemp("stream") / "in"
    for i, rows in enumerate(files):
        _land(folder, f"{i}.txt", *[_message(*row) for row in rows])
    path = scratch_dir(spark, "m")
    write = minute_writer(path)

    def twice(batch, batch_id):
        write(batch, batch_id)
        write(batch, batch_id)

    if any(files):
        assert _run_minutes(spark, folder, path, scratch_dir(spark, "c"), twice) == _batch_answer(spark, folder)


def test_restart_after_a_failure_between_write_and_commit(spark, tmp_path):
    folder, path, checkpoint = tmp_path / "in", scratch_dir(spark, "m"), scratch_dir(spark, "c")
    _land(folder, "a.txt", _message(1), _message(1, 1))
    _land(folder, "b.txt", _message(1, 2), _message(2))
    write = minute_writer(path)

    def fails_once_written(batch, batch_id):
        write(batch, batch_id)
        if batch_id == 1:
            raise RuntimeError("lost before the commit")

    with pytest.raises(Exception, match="lost before the commit"):
        _run_minutes(spark, folder, path, checkpoint, fails_once_written)
    assert _run_minutes(spark, folder, path, checkpoint) == _batch_answer(spark, folder)


def test_ingest_and_rejects_share_the_messages(spark, tmp_path):
    folder = tmp_path / "in"
    _land(folder, "a.txt", _message(1), "garbage")
    _land(folder, "b.txt", _message(2))
    good, bad = scratch_dir(spark, "good"), scratch_dir(spark, "bad")
    ingest(file_messages(spark, str(folder)), good, scratch_dir(spark, "c")).awaitTermination()
    store_rejects(file_messages(spark, str(folder)), bad, scratch_dir(spark, "c")).awaitTermination()
    table = spark.read.parquet(good)
    assert content(table, "timestamp", "event_date") == [
        (D(2024, 1, 1, 0, m), dt.date(2024, 1, 1)) for m in (1, 2)]
    assert content(spark.read.text(bad), "value") == [("garbage",)]
    stored = spark.createDataFrame([(1, D(2024, 1, 1, 0, 1), "x")], "user_id INT, ts TIMESTAMP_NTZ, event_type STRING")
    both = table.drop("event_date").unionByName(backfill(stored, "2024-01-01", "2024-01-02"))
    assert both.count() == 3


def test_day_rollup_of_two_sources(spark, tmp_path):
    schema = "event_type STRING, actor_login STRING, repo_name STRING, created_at TIMESTAMP_NTZ"
    rows = [("T", "u", "r", D(2024, 1, 1, 5)), ("T", None, "r", D(2024, 1, 1, 6)), ("T", "v", "r", D(2024, 1, 2))]
    source = str(tmp_path / "events")
    spark.createDataFrame(rows, schema).repartition(2).write.parquet(source)
    path = scratch_dir(spark, "days")
    for name in ("historic", "rt"):
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
        maintain(stream, day_writer(path, name), scratch_dir(spark, "c")).awaitTermination()
    parts = (("counts", DAY_PARTIAL), ("members", DAY_MEMBER))
    merged = merge_day(*(RollupState(spark, f"{path}/{name}", schema, DAY_KEYS).read() for name, schema in parts))
    assert content(merged, *DAY_KEYS, "count", "actor_count") == [
        (dt.date(2024, 1, 1), "T", "r", 4, 1), (dt.date(2024, 1, 2), "T", "r", 2, 1)]


def test_a_new_checkpoint_writes_beside_what_is_there(spark, tmp_path):
    folder, path = tmp_path / "in", scratch_dir(spark, "m")
    _land(folder, "a.txt", _message(1), _message(2))
    _run_minutes(spark, folder, path, scratch_dir(spark, "c"))
    other = tmp_path / "other"
    _land(other, "b.txt", _message(2))
    got = _run_minutes(spark, other, path, scratch_dir(spark, "c"))
    assert got == [(D(2024, 1, 1, 0, 1), "x", 1), (D(2024, 1, 1, 0, 2), "x", 2)]


def test_events_and_rejects_from_one_stream(spark, tmp_path):
    folder, checkpoint = tmp_path / "in", scratch_dir(spark, "c")
    good, bad = scratch_dir(spark, "good"), scratch_dir(spark, "bad")
    for name, *texts in (("a.txt", _message(1), "garbage"), ("b.txt", _message(2))):
        _land(folder, name, *texts)
        ingest_all(file_messages(spark, str(folder)), good, bad, checkpoint).awaitTermination()
    assert content(spark.read.parquet(good), "timestamp") == [(D(2024, 1, 1, 0, m),) for m in (1, 2)]
    assert content(spark.read.text(bad), "value") == [("garbage",)]


def test_input_files_follow_bytes_not_tasks(spark, tmp_path):
    """Many input tasks make no more and smaller files, so a stream has no more batches."""
    rows = spark.range(0, 4000, 1, 40).selectExpr(
        "id AS event_id", "TIMESTAMP_NTZ '2024-01-10 00:00:00' + make_dt_interval(0, 0, 0, id) AS ts", "id % 50 AS user_id",
        "'view' AS event_type", "1.0D AS value", "concat('{\"k\": ', id % 9, '}') AS props",
    )
    rows.write.parquet(str(tmp_path / "events.parquet"))
    with session_conf(spark, spark__sql__adaptive__advisoryPartitionSizeInBytes="64m", spark__sql__files__openCostInBytes="64m"):
        assert len(spark.read.parquet(str(tmp_path / "events.parquet")).inputFiles()) == 40
        files = spark.read.text(adapters.message_files(spark, str(tmp_path))).inputFiles()
        assert len(files) == 4
        stored = adapters.serving_files(spark, str(tmp_path))
        assert len(spark.read.parquet(f"{stored}/historic").inputFiles()) == 4
    assert spark.read.parquet(f"{stored}/historic").count() == 4000
