"""Slice replacement, loads, layout and retention."""

import datetime as dt
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from helpers import content, event, lake, serving, session_conf, write_archive
from tidemark.functions.time import ntz
from tidemark.operators.events import time_slice
from tidemark.operators.hours import missing_hours
from tidemark.operators.retention import retain_one_month, retention_floor
from tidemark.plans.load import load_day, load_hour, load_missing, load_pending, load_range
from tidemark.sinks.tables import cluster_by_time
from tidemark.sources.archive import conform_to_lake, read_archive

D = dt.datetime
DAY = "2024-03-05"


def rows(spark, *events):
    """Lake rows from (id, created_at, type)."""
    frame = spark.createDataFrame(list(events), "id STRING, created_at STRING, type STRING")
    return conform_to_lake(frame.withColumn("created_at", F.col("created_at").cast("timestamp_ntz")))


def ids(table):
    return [i for (i,) in content(table.read(), "id")]


@pytest.fixture
def filled(spark, tmp_path):
    table = lake(spark, tmp_path)
    table.append(
        rows(
            spark,
            ("a", "2024-03-04 23:59:59.999", "PushEvent"),
            ("b", "2024-03-05 00:00:00", "PushEvent"),
            ("c", "2024-03-05 07:00:00", "ForkEvent"),
            ("d", "2024-03-05 07:59:59.999999", "PushEvent"),
            ("e", "2024-03-05 08:00:00", "PushEvent"),
            ("f", "2024-03-06 00:00:00", "PushEvent"),
        )
    )
    return table


def test_create_twice_keeps_content(filled):
    filled.create()
    assert len(ids(filled)) == 6


def test_replace_hour_bounds_and_vanished_type(spark, filled):
    new = rows(spark, ("x", "2024-03-05 07:30:00", "PushEvent"), ("out", "2024-03-05 08:00:00", "PushEvent"))
    for _ in range(2):
        report = filled.replace_slice(new, f"{DAY} 07:00:00", f"{DAY} 08:00:00")
        assert (report.written, report.outside, report.emptied) == (1, 1, [])
        assert ids(filled) == ["a", "b", "e", "f", "x"]


def test_replace_day_empties_hours_without_rows(spark, filled):
    report = filled.replace_slice(rows(spark, ("x", f"{DAY} 12:00:00", "PushEvent")), DAY, "2024-03-06")
    assert report.emptied == [D(2024, 3, 5, 0), D(2024, 3, 5, 7), D(2024, 3, 5, 8)]
    assert ids(filled) == ["a", "f", "x"]


def test_replace_with_nothing(spark, filled):
    report = filled.replace_slice(rows(spark, ("x", "2020-01-01 00:00:00", "T")), DAY, "2024-03-06")
    assert (report.written, report.outside) == (0, 1)
    assert ids(filled) == ["a", "f"]
    assert filled.slice_count(DAY, "2024-03-06") == 0


def test_replace_from_its_own_rows(spark, filled):
    start, end = f"{DAY} 07:00:00", f"{DAY} 08:00:00"
    kept = filled.read().filter("type = 'PushEvent'")
    filled.replace_slice(kept, start, end)
    assert ids(filled) == ["a", "b", "d", "e", "f"]


def test_failed_replace_keeps_old_rows_and_can_be_repeated(spark, filled):
    good = rows(spark, ("x", f"{DAY} 07:30:00", "PushEvent"))
    bad = good.withColumn("type", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        filled.replace_slice(bad, f"{DAY} 07:00:00", f"{DAY} 08:00:00")
    assert len(ids(filled)) == 6
    filled.replace_slice(good, f"{DAY} 07:00:00", f"{DAY} 08:00:00")
    assert ids(filled) == ["a", "b", "e", "f", "x"]


def test_slice_must_be_whole_hours(spark, filled):
    with pytest.raises(ValueError, match="full hour"):
        filled.replace_slice(filled.read(), f"{DAY} 07:30:00", f"{DAY} 08:00:00")


def test_hours_replaced_at_the_same_time(spark, filled):
    """Parallel jobs on different hours of one table do not touch each other."""

    def replace(hour):
        new = rows(spark, *[(f"{hour}-{i}", f"{DAY} {hour:02d}:00:00", "T") for i in range(50)])
        start = D.fromisoformat(DAY) + dt.timedelta(hours=hour)
        return filled.replace_slice(new, start, start + dt.timedelta(hours=1)).written

    with ThreadPoolExecutor(6) as pool:
        assert list(pool.map(replace, range(7, 13))) == [50] * 6
    counts = filled.read().filter(f"event_date = '{DAY}' AND event_hour >= 7").groupBy("event_hour").count()
    assert content(counts, "event_hour", "count") == sorted(((h, 50) for h in range(7, 13)), key=repr)
    assert {"a", "b", "f"} < set(ids(filled))


def test_table_without_the_overwrite_option_is_refused(spark, tmp_path, filled):
    plain = lake(spark, tmp_path)
    spark.sql(f"DROP TABLE {plain.name}")
    spark.sql(
        f"CREATE TABLE {plain.name} USING parquet PARTITIONED BY (event_date, event_hour) "
        f"AS SELECT * FROM {filled.name}"
    )
    with pytest.raises(ValueError, match="partitionOverwriteMode"):
        plain.create().replace_slice(filled.read(), DAY, "2024-03-06")
    assert len(ids(plain)) == 6


def test_load_writes_without_a_shuffle(spark, tmp_path):
    """Every archive becomes one file of its partition."""
    landing = tmp_path / "landing"
    _land_two_days(landing)
    table = lake(spark, tmp_path)
    load_range(table, str(landing), "2024-03-05", "2024-03-06")
    folders = list(Path(table.location).glob("event_date=*/event_hour=*"))
    assert len(folders) == 48
    assert all(len(list(folder.glob("*/*.parquet"))) == 1 for folder in folders)


def test_rows_without_time_do_not_disturb_replacement(spark, filled):
    filled.append(rows(spark, ("n", None, "PushEvent")))
    filled.replace_slice(rows(spark, ("x", f"{DAY} 07:30:00", "T")), "2024-03-01", "2024-04-01")
    assert ids(filled) == ["n", "x"]


def test_slice_filter_prunes_partitions(filled):
    plan = time_slice(filled.read(), DAY, "2024-03-06")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(created_at), GreaterThanOrEqual(created_at" in plan
    assert "event_date" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_missing_hours_of_a_lake_read_only_partition_columns(filled):
    found = missing_hours(filled.read())
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in plan
    hours = sorted(row["hour"] for row in found.collect())
    plain = missing_hours(filled.read().select("created_at"))
    assert hours == sorted(row["hour"] for row in plain.collect())
    assert (len(hours), hours[0], hours[-1]) == (21, D(2024, 3, 5, 1), D(2024, 3, 5, 23))


def test_hot_hour_is_split_and_each_file_sorted(spark, tmp_path):
    """One hour with almost all rows is written by several tasks, sorted by type."""
    table = lake(spark, tmp_path)
    n = 60000
    many = spark.range(n).select(
        F.uuid().alias("id"),
        F.concat(F.lit("T"), (F.col("id") % 5).cast("string")).alias("type"),
        (ntz(f"{DAY} 07:00:00") + F.make_dt_interval(secs=F.col("id") % 3600)).alias("created_at"),
    )
    few = many.limit(3).withColumn("created_at", ntz("2024-03-09 01:00:00"))
    report = table.replace_slice(conform_to_lake(many.union(few)), "2024-03-01", "2024-04-01")
    assert report.written == n + 3
    files = list(Path(table.location).glob("event_date=2024-03-05/event_hour=7/*/*.parquet"))
    assert len(files) > 1
    for file in files:
        types = [r["type"] for r in spark.read.parquet(str(file)).select("type").collect()]
        assert types == sorted(types)
    assert table.read().count() == n + 3


def test_time_clustering_spreads_one_hot_instant(spark):
    hot = spark.range(0, 40000, 1, 8).select(ntz(DAY).alias("created_at"), F.col("id"))
    with session_conf(spark, spark__sql__adaptive__coalescePartitions__enabled="false"):
        tasks = cluster_by_time(hot).groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in tasks) == 40000
    assert max(r["count"] for r in tasks) < 20000


def _land_two_days(folder):
    for date in ("2024-03-05", "2024-03-06"):
        for hour in range(24):
            stamp = f"{date}T{hour:02d}"
            write_archive(
                folder,
                f"{date}-{hour}",
                [event(f"{stamp}:00:00Z", "PushEvent"), event(f"{stamp}:59:59Z", "WatchEvent", {"action": "started"})],
            )


def test_loads_in_any_order_and_size_give_one_table(spark, tmp_path):
    landing = tmp_path / "landing"
    _land_two_days(landing)
    whole = lake(spark, tmp_path)
    report = load_range(whole, str(landing), "2024-03-05", "2024-03-06")
    assert (report.slice.written, report.slice.outside, len(report.slice.hours)) == (96, 0, 48)
    want = content(whole.read(), "id", "action", "event_date", "event_hour")
    pieces = lake(spark, tmp_path)
    load_day(pieces, str(landing), "2024-03-06")
    load_hour(pieces, str(landing), "2024-03-06", 23)
    load_day(pieces, str(landing), "2024-03-05")
    for hour in (5, 0, 5):
        load_hour(pieces, str(landing), dt.date(2024, 3, 5), hour)
    assert content(pieces.read(), "id", "action", "event_date", "event_hour") == want


def test_lines_without_time_or_form_go_to_the_rejects(spark, tmp_path):
    landing = tmp_path / "landing"
    outside = event("2024-03-05T08:00:00Z")
    write_archive(landing, "2024-03-05-7", [event("2024-03-05T07:00:00Z"), outside, event("?"), "{broken"])
    table = lake(spark, tmp_path)
    report = load_hour(table, str(landing), DAY, 7)
    assert (report.slice.written, report.slice.outside) == (2, 2)
    assert report.rejects.count() == 2
    assert outside["id"] in ids(table)  # a row of the archive, wherever it lies
    assert content(table.ledger().read(), "hour", "rows", "rejects") == [(D(2024, 3, 5, 7), 2, 2)]


def test_catching_up_loads_only_pending_hours(spark, tmp_path):
    landing = tmp_path / "landing"
    for hour in (5, 6, 7, 8):
        write_archive(landing, f"2024-03-05-{hour}", [event(f"2024-03-05T{hour:02d}:10:00Z")])
    table = lake(spark, tmp_path)
    load_hour(table, str(landing), DAY, 5)
    mark = table.read().agg(F.max("created_at").alias("last_date"))
    report = load_pending(table, str(landing), mark, f"{DAY} 08:30:00")
    assert report.slice.hours == [D(2024, 3, 5, 6), D(2024, 3, 5, 7)]
    assert len(ids(table)) == 3
    mark = table.read().agg(F.max("created_at").alias("last_date"))
    assert load_pending(table, str(landing), mark, f"{DAY} 08:30:00") is None


def test_load_without_any_archive_fails(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        load_hour(lake(spark, tmp_path), str(tmp_path), DAY, 7)


def _serving_rows(spark, *stamps):
    frame = spark.createDataFrame([(s,) for s in stamps], "created_at STRING")
    return frame.select(F.col("created_at").cast("timestamp_ntz").alias("created_at")).withColumns(
        {n: F.lit("x") for n in ("event_type", "actor_login", "repo_name", "action")}
    )


@pytest.mark.parametrize(
    "as_of",
    [
        "2024-03-01 00:00:00",
        "2024-03-01 00:00:01",
        "2024-02-29 12:00:00",
        "2023-03-01 00:00:00",
        "2024-03-31 05:00:00",
        "2024-12-31 23:59:59",
        "2025-01-01 00:00:00",
    ],
)
def test_retention_floor_equals_the_row_rule(spark, as_of):
    days = spark.sql("SELECT explode(sequence(DATE'2022-12-01', DATE'2025-02-01')) AS d")
    first = days.filter(f"d + INTERVAL 1 MONTH > TIMESTAMP_NTZ'{as_of}'").agg(F.min("d")).first()[0]
    assert retention_floor(as_of) == first


def test_retention_of_rows_and_partitions(spark, tmp_path):
    stamps = ("2024-01-29 10:00:00", "2024-01-31 23:59:59", "2024-02-01 00:00:00", "2024-02-10 00:00:00")
    table = serving(spark, tmp_path)
    table.append(_serving_rows(spark, *stamps))
    as_of = "2024-03-01 00:00:00"
    kept = content(retain_one_month(table.read(), as_of), "created_at")
    assert [k.isoformat(" ") for (k,) in kept] == list(stamps[3:])
    assert table.drop_expired(as_of) == ["2024-01-29", "2024-01-31", "2024-02-01"]
    assert content(table.read(), "created_at") == kept
    assert table.drop_expired(as_of) == []


def test_archive_that_left_landing_keeps_its_hour(spark, tmp_path):
    landing = tmp_path / "landing"
    for hour in (5, 6, 7):
        write_archive(landing, f"2024-03-05-{hour}", [event(f"2024-03-05T{hour:02d}:10:00Z")])
    table = lake(spark, tmp_path)
    load_day(table, str(landing), DAY)
    before = ids(table)
    (landing / "2024-03-05-6.json.gz").rename(tmp_path / "away.gz")
    report = load_day(table, str(landing), DAY)
    assert ids(table) == before and report.slice.emptied == []
    assert D(2024, 3, 5, 6) in report.absent and len(report.absent) == 22


def test_archive_without_lines_empties_its_hour(spark, tmp_path):
    landing = tmp_path / "landing"
    for hour in (5, 6):
        write_archive(landing, f"2024-03-05-{hour}", [event(f"2024-03-05T{hour:02d}:10:00Z")])
    table = lake(spark, tmp_path)
    load_day(table, str(landing), DAY)
    write_archive(landing, "2024-03-05-6", [])
    assert load_day(table, str(landing), DAY).slice.emptied == [D(2024, 3, 5, 6)]
    assert len(ids(table)) == 1


def test_edge_rows_are_in_day_and_hour_loads(spark, tmp_path):
    landing = tmp_path / "landing"
    write_archive(landing, "2024-03-05-7", [event("2024-03-05T07:10:00Z"), event("2024-03-05T08:00:00Z")])
    write_archive(landing, "2024-03-05-8", [event("2024-03-05T08:10:00Z"), event("2024-03-05T07:59:59Z")])
    write_archive(landing, "2024-03-04-23", [event("2024-03-05T00:00:00Z")])
    write_archive(landing, "2024-03-05-0", [event("2024-03-05T00:30:00Z")])
    whole, hourly = lake(spark, tmp_path), lake(spark, tmp_path)
    load_day(whole, str(landing), DAY)
    assert len(ids(whole)) == 5
    for hour in (8, 7, 0):
        load_hour(hourly, str(landing), DAY, hour)
    assert ids(hourly) == ids(whole)
    # the row of the next day comes with its own archive
    for table in (whole, hourly):
        load_hour(table, str(landing), "2024-03-04", 23)
        assert len(ids(table)) == 6


def test_rows_of_an_absent_hour_do_not_replace_it(spark, tmp_path):
    landing = tmp_path / "landing"
    write_archive(landing, "2024-03-05-7", [event("2024-03-05T07:10:00Z"), event("2024-03-05T08:00:00Z")])
    table = lake(spark, tmp_path)
    table.append(rows(spark, ("old", f"{DAY} 08:30:00", "T")))
    report = load_day(table, str(landing), DAY)
    assert "old" in ids(table) and len(ids(table)) == 3
    assert (report.slice.outside, report.rejects.count()) == (0, 0)


FAR = {
    "2024-03-05-7": ("2024-03-05T07:10:00Z", "2024-03-05T07:20:00Z"),
    "2024-03-05-10": ("2024-03-05T10:10:00Z", "2024-03-05T07:30:00Z", "2024-03-05T23:59:59Z"),
    "2024-03-05-23": ("2024-03-05T23:10:00Z", "2024-03-06T00:00:01Z", "2024-02-01T12:00:00Z"),
    "2024-03-06-0": ("2024-03-06T00:10:00Z", "2024-03-05T07:45:00Z"),
}


def test_rows_any_distance_from_their_archive_survive_every_load(spark, tmp_path):
    """Range, day and hour loads agree in any order and repetition; no row vanishes."""
    landing = tmp_path / "landing"
    for stem, stamps in FAR.items():
        write_archive(landing, stem, [event(s) for s in stamps])
    whole, pieces = lake(spark, tmp_path), lake(spark, tmp_path)
    load_range(whole, str(landing), "2024-03-05", "2024-03-06")
    want = content(whole.read(), "id", "created_at", "archive")
    assert len(want) == 10
    load_day(pieces, str(landing), DAY)
    for date, hour in ((DAY, 7), ("2024-03-06", 0), (DAY, 10), (DAY, 7), (DAY, 23)):
        assert load_hour(pieces, str(landing), date, hour).slice.emptied == []
    assert content(pieces.read(), "id", "created_at", "archive") == want
    load_hour(whole, str(landing), DAY, 7)
    load_day(whole, str(landing), DAY)
    assert content(whole.read(), "id", "created_at", "archive") == want


def test_an_archive_that_changed_replaces_its_rows_wherever_they_were(spark, tmp_path):
    landing = tmp_path / "landing"
    for stem, stamps in FAR.items():
        write_archive(landing, stem, [event(s) for s in stamps])
    table = lake(spark, tmp_path)
    load_range(table, str(landing), "2024-03-05", "2024-03-06")
    write_archive(landing, "2024-03-05-10", [event("2024-03-05T10:40:00Z")])
    report = load_hour(table, str(landing), DAY, 10)
    left = content(table.read().filter("archive = '2024-03-05-10'"), "created_at")
    assert left == [(D(2024, 3, 5, 10, 40),)] and len(ids(table)) == 8
    # its rows at 07:30 and 23:59 went, those of other archives in these hours stayed
    assert D(2024, 3, 5, 7) in report.slice.emptied and table.slice_count(f"{DAY} 07:00:00", f"{DAY} 08:00:00") == 3
    assert content(table.ledger().history().groupBy("hour").count(), "count") == [(1,), (1,), (1,), (2,)]
    assert (D(2024, 3, 5, 10), 1, 0) in content(table.ledger().read(), "hour", "rows", "rejects")


def test_an_hour_load_reads_one_archive(spark, tmp_path, monkeypatch):
    landing = tmp_path / "landing"
    _land_two_days(landing)
    read = []
    monkeypatch.setattr("tidemark.plans.load.read_archive", lambda s, paths, with_hour: read.extend(paths) or read_archive(s, paths, with_hour))
    load_hour(lake(spark, tmp_path), str(landing), DAY, 7)
    assert [p.rsplit("/", 1)[1] for p in read] == ["2024-03-05-7.json.gz"]


def test_late_archives_are_found_by_the_ledger(spark, tmp_path):
    """An archive that lands after later ones were loaded is loaded by the next catch-up, a failed load again."""
    landing = tmp_path / "landing"
    table = lake(spark, tmp_path)
    assert load_missing(table, str(landing), f"{DAY} 03:00:00", f"{DAY} 08:30:00") is None
    for hour in (5, 7):
        write_archive(landing, f"2024-03-05-{hour}", [event(f"2024-03-05T{hour:02d}:10:00Z")])
    report = load_missing(table, str(landing), f"{DAY} 03:00:00", f"{DAY} 08:30:00")
    assert report.slice.hours == [D(2024, 3, 5, 5), D(2024, 3, 5, 7)] and report.absent == []
    write_archive(landing, "2024-03-05-6", [event("2024-03-05T06:10:00Z")])
    write_archive(landing, "2024-03-05-8", [event("2024-03-05T08:10:00Z")])  # the running hour
    assert load_missing(table, str(landing), f"{DAY} 03:00:00", f"{DAY} 08:30:00").slice.hours == [D(2024, 3, 5, 6)]
    assert load_missing(table, str(landing), f"{DAY} 03:00:00", f"{DAY} 08:30:00") is None
    assert len(ids(table)) == 3


def test_a_load_that_fails_before_the_ledger_counts_as_not_done(spark, tmp_path, monkeypatch):
    landing = tmp_path / "landing"
    write_archive(landing, "2024-03-05-6", [event("2024-03-05T06:10:00Z")])
    table = lake(spark, tmp_path)

    def lost(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr("tidemark.sinks.ledger.LoadLedger.record", lost)
        with pytest.raises(RuntimeError, match="lost"):
            load_hour(table, str(landing), DAY, 6)
    assert table.ledger().read().isEmpty()
    load_missing(table, str(landing), f"{DAY} 03:00:00", f"{DAY} 08:30:00")
    assert len(ids(table)) == 1 and table.ledger().read().count() == 1


def test_a_slice_replaces_rows_of_all_archives(spark, tmp_path):
    landing = tmp_path / "landing"
    for stem, stamps in FAR.items():
        write_archive(landing, stem, [event(s) for s in stamps])
    table = lake(spark, tmp_path)
    load_range(table, str(landing), "2024-03-05", "2024-03-06")
    table.replace_slice(rows(spark, ("x", f"{DAY} 07:30:00", "T")), f"{DAY} 07:00:00", f"{DAY} 08:00:00")
    assert table.slice_count(f"{DAY} 07:00:00", f"{DAY} 08:00:00") == 1 and len(ids(table)) == 7


def test_lines_with_a_field_of_the_wrong_type_are_rejected(spark, tmp_path):
    landing = tmp_path / "landing"
    write_archive(landing, "2024-03-05-7", [event("2024-03-05T07:10:00Z"), event("2024-03-05T07:11:00Z", public="maybe")])
    table = lake(spark, tmp_path)
    report = load_hour(table, str(landing), DAY, 7)
    assert (report.slice.written, report.slice.outside, report.rejects.count()) == (1, 1, 1)


def test_table_survives_its_catalog_entry(spark, tmp_path, filled):
    spark.sql(f"DROP TABLE {filled.name}")
    again = lake(spark, tmp_path)
    spark.sql(f"DROP TABLE {again.name}")
    again.location = filled.location
    again.create()
    assert len(ids(again)) == 6
    again.replace_slice(rows(spark, ("x", f"{DAY} 12:00:00", "T")), DAY, "2024-03-06")
    assert ids(again) == ["a", "f", "x"]


def test_location_of_another_layout_is_refused(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "other"))
    table = lake(spark, tmp_path)
    spark.sql(f"DROP TABLE {table.name}")
    table.location = str(tmp_path / "other")
    with pytest.raises(ValueError, match="holds columns"):
        table.create()


def test_slices_open_only_their_folders(filled):
    for end, folders in ((f"{DAY} 01:00:00", ["0"]), ("2024-03-06", ["0", "7", "8"])):
        files = time_slice(filled.read(), DAY, end).inputFiles()
        assert sorted(f.split("event_hour=")[1].split("/")[0] for f in files) == folders
        assert all("event_date=2024-03-05" in f for f in files)


def test_hour_counts_read_no_column(filled):
    counts = filled.hour_counts(DAY, "2024-03-06")
    assert "ReadSchema: struct<>" in counts._jdf.queryExecution().executedPlan().toString()
    assert content(counts, "hour", "rows") == [(D(2024, 3, 5, 0), 1), (D(2024, 3, 5, 7), 2), (D(2024, 3, 5, 8), 1)]


def test_other_session_zones_change_nothing(spark, tmp_path):
    """An hour that New York's clocks leave out, and one that they repeat."""
    table = lake(spark, tmp_path)
    stamps = ("2024-03-10 02:30:00.123456", "2024-03-10 03:30:00", "2024-11-03 01:30:00", "2024-11-03 02:00:00")
    new = rows(spark, *[(str(i), s, "T") for i, s in enumerate(stamps)])
    with session_conf(spark, spark__sql__session__timeZone="America/New_York"):
        for _ in range(2):
            report = table.replace_slice(new, "2024-03-10", "2024-11-04")
            assert report.hours == [D(2024, 3, 10, 2), D(2024, 3, 10, 3), D(2024, 11, 3, 1), D(2024, 11, 3, 2)]
            assert report.emptied == [] and ids(table) == ["0", "1", "2", "3"]
        landing = tmp_path / "landing"
        write_archive(landing, "2024-03-10-2", [event("2024-03-10T02:15:00Z")])
        load_hour(table, str(landing), "2024-03-10", 2)
        assert load_hour(table, str(landing), "2024-03-10", 2).slice.hours == [D(2024, 3, 10, 2)]
        assert content(table.hour_counts("2024-03-10", "2024-03-11"), "hour", "rows") == [(D(2024, 3, 10, 2), 1), (D(2024, 3, 10, 3), 1)]
        assert spark.conf.get("spark.sql.session.timeZone") == "America/New_York"


def _land_scattered(folder, minute=0):
    """Two archives of one day, with a row in each hour of that day; one also has rows of the day before."""
    for hour in (7, 20):
        before = [event(f"2024-03-04T{h:02d}:{minute:02d}:00Z") for h in range(7, 24)] if hour == 7 else []
        write_archive(folder, f"2024-03-05-{hour}", [event(f"2024-03-05T{h:02d}:{minute:02d}:00Z") for h in range(24)] + before)


def test_distant_rows_of_an_archive_share_a_partition_of_their_date(spark, tmp_path):
    """However many hours they lie in; counts, ranges and gaps stay those of the rows."""
    landing = tmp_path / "landing"
    _land_scattered(landing)
    table = lake(spark, tmp_path)
    report = load_day(table, str(landing), DAY)
    assert len(table.partition_values()) == 5  # both hours, the rest of the day by archive, the day before
    hours = [D(2024, 3, 4, 7) + dt.timedelta(hours=k) for k in range(41)]
    assert (report.slice.written, report.slice.hours, report.slice.emptied) == (65, hours, [])
    assert table.loaded_hours("2024-03-04 12:00:00", "2024-03-05 02:00:00") == set(hours[5:19])
    assert content(table.hour_counts("2024-03-04 22:00:00", f"{DAY} 02:00:00"), "hour", "rows") == [
        (D(2024, 3, 4, 22), 1), (D(2024, 3, 4, 23), 1), (D(2024, 3, 5, 0), 2), (D(2024, 3, 5, 1), 2)
    ]
    for low, high in ((5, 9), (0, 24), (20, 21), (23, 24)):
        start = D(2024, 3, 5) + dt.timedelta(hours=low)
        assert time_slice(table.read(), start, start + dt.timedelta(hours=high - low)).count() == 2 * (high - low)
    assert missing_hours(table.read()).isEmpty()
    assert set(content(table.archive_counts([D(2024, 3, 5, 7), D(2024, 3, 5, 20)]), "hour", "rows")) == {(D(2024, 3, 5, 7), 41), (D(2024, 3, 5, 20), 24)}
    # hours whose rows went are reported, also of a partition that keeps others
    write_archive(landing, "2024-03-05-7", [event(f"{DAY}T07:00:00Z"), event(f"{DAY}T09:00:00Z")])
    report = load_hour(table, str(landing), DAY, 7).slice
    assert (report.written, report.hours) == (2, [D(2024, 3, 5, 7), D(2024, 3, 5, 9)])
    assert report.emptied == [hour for hour in hours if hour not in report.hours]
    assert table.read().count() == 26 and len(table.partition_values()) == 4


def test_a_slice_keeps_distant_rows_outside_of_it(spark, tmp_path):
    landing = tmp_path / "landing"
    _land_scattered(landing)
    table = lake(spark, tmp_path)
    load_day(table, str(landing), DAY)
    before = set(content(table.read(), "created_at", "archive", "id"))
    new = rows(spark, ("x", f"{DAY} 07:30:00", "T"), ("out", f"{DAY} 09:00:00", "T"))
    for _ in range(2):
        report = table.replace_slice(new, f"{DAY} 07:00:00", f"{DAY} 09:00:00")
        assert (report.written, report.outside, report.hours) == (1, 1, [D(2024, 3, 5, 7)])
        kept = {row for row in before if not D(2024, 3, 5, 7) <= row[0] < D(2024, 3, 5, 9)}
        assert set(content(table.read(), "created_at", "archive", "id")) == kept | {(D(2024, 3, 5, 7, 30), "2024-03-05-07", "x")}
        assert table.read().count() == 62
    # whole days go without a trace; what is distant in the new rows is put where loads put it
    far = rows(spark, ("y", f"{DAY} 03:00:00", "T")).withColumn("archive_hour", ntz(f"{DAY} 20:00:00"))
    report = table.replace_slice(far, DAY, "2024-03-06")
    assert (report.written, report.hours, len(report.emptied)) == (1, [D(2024, 3, 5, 3)], 22)
    assert table.read().count() == 18
    table.replace_slice(far.limit(0), "2024-03-04 07:00:00", "2024-03-05 23:00:00")
    assert table.read().isEmpty() and table.partition_values() == []


def test_slices_that_share_a_partition_of_distant_rows_at_the_same_time(spark, tmp_path):
    landing = tmp_path / "landing"
    _land_scattered(landing)
    table = lake(spark, tmp_path)
    load_day(table, str(landing), DAY)

    def replace(hour):
        new = rows(spark, (f"new-{hour}", f"{DAY} {hour:02d}:30:00", "T"))
        start = D.fromisoformat(DAY) + dt.timedelta(hours=hour)
        return table.replace_slice(new, start, start + dt.timedelta(hours=1)).written

    with ThreadPoolExecutor(4) as pool:
        assert list(pool.map(replace, range(4, 8))) == [1] * 4
    counts = content(table.hour_counts(DAY, "2024-03-06"), "hour", "rows")
    assert [n for _, n in sorted(counts)] == [2] * 4 + [1] * 4 + [2] * 16
