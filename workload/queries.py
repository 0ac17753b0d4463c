"""One query per feature. Each takes (spark, sf_dir) and returns a frame over the whole table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import time as t
from tidemark.functions.payload import derive_from_variant as derive_from_variant_columns, with_variant
from tidemark.operators import bitmaps, events, hours, retention, rollups
from tidemark.plans import copies, load, reads
from tidemark.schemas import DAY_KEYS, DAY_MEMBER, DAY_PARTIAL, MINUTE_KEYS, MINUTE_PARTIAL, SERVING
from tidemark.session import scratch_dir
from tidemark.sinks.rollups import read_rollup, write_rollup
from tidemark.sinks.tables import ServingTable
from tidemark.sources.archive import read_archive, typed_events
from tidemark.sources.items import generate_items, generate_items_copy, read_items
from tidemark.sources.messages import decode_messages, rejected_messages
from tidemark.streaming import rollups as stream_rollups
from tidemark.streaming.ingest import ingest, ingest_all, run, store_rejects
from workload import adapters as a

Query = Callable[[SparkSession, str], DataFrame]

_REGISTRY: dict[str, Query] = {}

# Parameters of the queries; the SQL counterparts use the same.
FROM_TS, TO_TS = "2024-01-05 00:00:00", "2024-01-20 12:00:00"
FROM_DAY, TO_DAY = "2024-01-08", "2024-01-24"
COARSE_FROM, COARSE_TO = "2023-12-20", "2024-02-10"
SLICE_DAY, SLICE_HOUR = "2024-01-10", 7
AS_OF = "2024-02-15 06:00:00"
NOW = "2024-01-31 12:30:00"
REPOS = ("repo/1", "repo/2", "repo/3", "repo/5", "repo/8")
TYPES = ("WatchEvent", "IssuesEvent")
SPLIT = "2024-01-15 00:00:00"


def _query(build: Query) -> Query:
    _REGISTRY[build.__name__] = build
    return build


def queries() -> dict[str, Query]:
    return dict(_REGISTRY)


def _flat(lake: DataFrame) -> DataFrame:
    """Lake rows as top-level columns."""
    return lake.select(
        "id", "type", "created_at", "public",
        F.col("actor.login").alias("actor_login"), F.col("actor.display_login").alias("actor_display_login"),
        F.col("repo.id").alias("repo_id"), F.col("repo.name").alias("repo_name"), F.col("org.login").alias("org_login"),
        "payload", "action", "ref", "ref_type", "number",
    )


def _archive(spark: SparkSession, sf_dir: str, with_hour: bool = False) -> DataFrame:
    return read_archive(spark, f"{a.landing(spark, sf_dir)}/{a.ARCHIVE_FOLDER.format(stem='*')}", with_hour)


def _typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return typed_events(_archive(spark, sf_dir))


def _day_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.rollup_day(a.serving(spark, sf_dir), "historic")


def _stored_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored daily counts of two sources, one compacted, one in batches."""
    return a.day_counts(spark, sf_dir).read()


def _members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.day_members(a.serving(spark, sf_dir), "historic")


def _parts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Historic and recent serving rows; they share five days."""
    rows = a.serving(spark, sf_dir)
    return (
        rows.filter(F.col("created_at") <= t.ntz(a.HISTORIC_UNTIL)),
        rows.filter(F.col("created_at") > t.ntz(a.RECENT_AFTER)),
    )


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.text(a.message_files(spark, sf_dir)).select("value")


def _stream_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode_messages(_messages(spark, sf_dir))


# Scans and sources


@_query
def scan_archive_json(spark, sf_dir):
    login = F.col("actor.login").alias("actor_login")
    return _archive(spark, sf_dir).select("id", "type", "created_at", "public", login)


@_query
def scan_archive_day(spark, sf_dir):
    return _archive(spark, sf_dir, with_hour=True).select("id", "archive_hour")


@_query
def scan_lake_range(spark, sf_dir):
    return _flat(events.between(a.shared_lake(spark, sf_dir), FROM_TS, TO_TS))


@_query
def stream_source_events(spark, sf_dir):
    path = scratch_dir(spark, "source")
    writer = a.message_stream(spark, sf_dir).writeStream.format("parquet").option("path", path)
    run(writer, scratch_dir(spark, "checkpoint"), continuous=False).awaitTermination()
    return spark.read.schema("value STRING").parquet(path)


@_query
def decode_json_message(spark, sf_dir):
    return _stream_events(spark, sf_dir)


@_query
def reject_json_message(spark, sf_dir):
    return rejected_messages(_messages(spark, sf_dir))


@_query
def scan_ndjson_items(spark, sf_dir):
    return read_items(spark, a.item_files(spark, sf_dir))


@_query
def gen_items(spark, sf_dir):
    return generate_items(a.item_ids(spark, sf_dir), a.ITEM_NOW)


@_query
def gen_items_copy(spark, sf_dir):
    return generate_items_copy(a.item_ids(spark, sf_dir), a.ITEM_NOW, seed=17)


# Projections and derivations


@_query
def project_serving(spark, sf_dir):
    return a.serving_rows(spark, sf_dir)


@_query
def parse_created_at(spark, sf_dir):
    return _typed(spark, sf_dir).select("id", "created_at")


@_query
def derive_action(spark, sf_dir):
    return _typed(spark, sf_dir).select("id", "type", "action")


@_query
def derive_ref(spark, sf_dir):
    return _typed(spark, sf_dir).select("id", "type", "ref")


@_query
def derive_ref_type(spark, sf_dir):
    return _typed(spark, sf_dir).select("id", "type", "ref_type")


@_query
def derive_number(spark, sf_dir):
    return _typed(spark, sf_dir).select("id", "type", "number")


@_query
def derive_from_variant(spark, sf_dir):
    # the payload is stored parsed, and fields are read from what is stored
    path = scratch_dir(spark, "variant")
    with_variant(_archive(spark, sf_dir).select("id", "type", "payload")).drop("payload").write.parquet(path)
    stored = spark.read.schema("id STRING, type STRING, payload_variant VARIANT").parquet(path)
    return derive_from_variant_columns(stored).drop("payload_variant")


@_query
def payload_as_json(spark, sf_dir):
    return _archive(spark, sf_dir).select("id", "payload")


@_query
def conform_to_lake(spark, sf_dir):
    return _flat(a.conform_to_lake(_typed(spark, sf_dir)))


@_query
def trunc_millis(spark, sf_dir):
    return a.events_table(spark, sf_dir).select("event_id", t.trunc_millis(F.col("ts")).alias("created_at"))


@_query
def require_not_null(spark, sf_dir):
    # rows that fail to parse carry a NULL time; the serving projection leaves them out
    broken = F.when(F.col("type") != "PushEvent", F.col("created_at"))
    return events.project_serving(a.lake_rows(spark, sf_dir).withColumn("created_at", broken))


@_query
def default_empty(spark, sf_dir):
    return events.default_empty(a.serving_rows(spark, sf_dir))


# Ranges and slices


@_query
def copy_historic(spark, sf_dir):
    return copies.copy_historic(a.shared_lake(spark, sf_dir), FROM_TS, TO_TS)


@_query
def copy_rt_range(spark, sf_dir):
    return copies.copy_rt(a.shared_lake(spark, sf_dir), from_ts=FROM_TS, to_ts=TO_TS)


@_query
def copy_rt_incremental(spark, sf_dir):
    serving = a.serving(spark, sf_dir)
    historic = serving.filter(F.col("created_at") <= t.ntz(SPLIT))
    recent = serving.filter(t.within(F.col("created_at"), SPLIT, "2024-01-22 00:00:00"))
    mark = reads.last_event_date(recent, historic, NOW)
    return copies.copy_rt(a.shared_lake(spark, sf_dir), high_water=mark, floor="2023-12-31 12:30:00")


@_query
def backfill_range(spark, sf_dir):
    return copies.backfill(a.stored_messages(spark, sf_dir), FROM_TS, TO_TS)


@_query
def backfill_tiled(spark, sf_dir):
    return copies.copy_days(a.shared_lake(spark, sf_dir), FROM_DAY, TO_DAY)


@_query
def slice_hour(spark, sf_dir):
    start = dt.datetime.fromisoformat(SLICE_DAY) + dt.timedelta(hours=SLICE_HOUR)
    return _flat(events.time_slice(a.shared_lake(spark, sf_dir), start, start + dt.timedelta(hours=1)))


@_query
def slice_day(spark, sf_dir):
    start = dt.datetime.fromisoformat(SLICE_DAY)
    return _flat(events.time_slice(a.shared_lake(spark, sf_dir), start, start + dt.timedelta(days=1)))


@_query
def slice_count(spark, sf_dir):
    start = dt.datetime.fromisoformat(SLICE_DAY)
    rows = events.time_slice(a.shared_lake(spark, sf_dir), start, start + dt.timedelta(days=1))
    return rows.agg(F.count("*").alias("rows"))


@_query
def retain_one_month(spark, sf_dir):
    return retention.retain_one_month(a.serving(spark, sf_dir), AS_OF).select(*SERVING.fieldNames())


# Rollups


@_query
def rollup_day_count(spark, sf_dir):
    return _day_rollup(spark, sf_dir)


@_query
def rollup_day_actors(spark, sf_dir):
    return _members(spark, sf_dir)


@_query
def merge_count(spark, sf_dir):
    return rollups.merge_counts(_stored_days(spark, sf_dir), "event_type", "repo_name")


@_query
def merge_actors_by_type(spark, sf_dir):
    return rollups.merge_actors(_members(spark, sf_dir), "event_type")


@_query
def merge_actors_by_day(spark, sf_dir):
    return rollups.merge_actors(_members(spark, sf_dir), "date", "event_type")


@_query
def rollup_two_sources(spark, sf_dir):
    return rollups.merge_states(*map(rollups.day_state, _parts(spark, sf_dir)))


@_query
def rollup_evolved(spark, sf_dir):
    # days before the split were rolled up when member sets were not kept yet
    members = _members(spark, sf_dir).filter(F.col("date") >= F.lit(dt.date.fromisoformat(SPLIT[:10])))
    return rollups.merge_day(_day_rollup(spark, sf_dir), members)


@_query
def rollup_evolved_stored(spark, sf_dir):
    # three ages of one stored state: counts only, members without their events, members with them; merged in between
    path, rows = scratch_dir(spark, "evolved"), a.serving(spark, sf_dir)
    counts, members = a.day_states(spark, path)
    date = F.to_date("created_at")
    ages = [rows.filter(date < FROM_DAY), rows.filter(date.between(FROM_DAY, SPLIT[:10])), rows.filter(date > SPLIT[:10])]
    for batch_id, age in enumerate(ages[:2]):
        stream_rollups.write_batch(rollups.rollup_day(age, "rt").drop("source"), "date", f"{path}/counts", "rt", "a", batch_id)
        counts.compact()
    old = rollups.day_members(ages[1], "rt").drop("source")
    stream_rollups.write_batch(old, "date", f"{path}/members", "rt", "a", 1)
    stream_rollups.write_day_batch(ages[2], path, "rt", 2, "a")
    members.compact()
    return rollups.merge_day(counts.read(), members.read())


@_query
def rollup_minute_count(spark, sf_dir):
    return rollups.rollup_minute(_stream_events(spark, sf_dir))


@_query
def write_rollup_day(spark, sf_dir):
    path = scratch_dir(spark, "rollup")
    write_rollup(_day_rollup(spark, sf_dir), path, ("event_type", "date", "repo_name"))
    return read_rollup(spark, path, DAY_PARTIAL).drop("run", "batch_id")


@_query
def write_rollup_members(spark, sf_dir):
    path = scratch_dir(spark, "members")
    write_rollup(_members(spark, sf_dir), path, ("event_type", "date", "repo_name"))
    return read_rollup(spark, path, DAY_MEMBER).drop("run", "batch_id", "cnt")


# Parameterised reads


@_query
def top_repos_by_type(spark, sf_dir):
    return reads.top_repos(_stored_days(spark, sf_dir), FROM_DAY, TO_DAY, group_by=["event_type"])


@_query
def top_repos_by_repo(spark, sf_dir):
    return reads.top_repos(_stored_days(spark, sf_dir), FROM_DAY, TO_DAY, group_by=["repo_name"])


@_query
def top_repos_by_repo_type(spark, sf_dir):
    return reads.top_repos(_stored_days(spark, sf_dir), FROM_DAY, TO_DAY, group_by=["repo_name", "event_type"], limit=25)


@_query
def top_repos_window(spark, sf_dir):
    return reads.top_repos(_stored_days(spark, sf_dir), FROM_DAY, TO_DAY, group_by=["date"], limit=100)


@_query
def top_repos_filtered(spark, sf_dir):
    return reads.top_repos(
        _stored_days(spark, sf_dir), FROM_DAY, TO_DAY, repo_names=REPOS, event_types=TYPES, group_by=["repo_name"]
    )


@_query
def top_repos_total(spark, sf_dir):
    return reads.top_repos(_stored_days(spark, sf_dir), FROM_DAY, TO_DAY)


@_query
def top_repos_default_window(spark, sf_dir):
    return reads.top_repos(_stored_days(spark, sf_dir))


@_query
def top_repos_coarse(spark, sf_dir):
    # month partials with days at both ends; the last month has a batch that came after the refresh
    return reads.top_repos_coarse(a.coarse_days(spark, sf_dir), COARSE_FROM, COARSE_TO, group_by=["repo_name"], limit=50)


@_query
def top_repos_coarse_total(spark, sf_dir):
    return reads.top_repos_coarse(a.coarse_days(spark, sf_dir), "2023-01-01", "2025-12-31", event_types=TYPES)


@_query
def merge_actors_bitmap(spark, sf_dir):
    return bitmaps.count_actors(a.stored_bitmaps(spark, sf_dir), "event_type")


@_query
def merge_actors_bitmap_by_day(spark, sf_dir):
    return bitmaps.count_actors(a.stored_bitmaps(spark, sf_dir), "date", "event_type")


@_query
def events_stats(spark, sf_dir):
    return reads.events_stats(a.minute_counts(spark, sf_dir).read(), FROM_TS, TO_TS)


@_query
def last_event_date(spark, sf_dir):
    historic, recent = _parts(spark, sf_dir)
    return reads.last_event_date(recent, historic, NOW)


@_query
def last_event_date_floor(spark, sf_dir):
    historic, recent = _parts(spark, sf_dir)
    return reads.last_event_date(recent, historic, "2024-03-31 10:00:00")


# Hours to load


@_query
def pending_hours(spark, sf_dir):
    historic, _ = _parts(spark, sf_dir)
    return hours.pending_hours(reads.last_event_date(historic, historic, NOW), NOW)


@_query
def pending_hours_range(spark, sf_dir):
    return hours.pending_hours_range(_span(spark, sf_dir))


def _span(spark, sf_dir):
    return a.events_table(spark, sf_dir).agg(F.min("ts").alias("start"), F.max("ts").alias("end"))


@_query
def missing_hours(spark, sf_dir):
    return hours.missing_hours(events.project_serving(a.gappy_lake(spark, sf_dir)))


@_query
def missing_hours_of_lake(spark, sf_dir):
    return hours.missing_hours(a.gappy_lake(spark, sf_dir))


@_query
def plan_loads(spark, sf_dir):
    return hours.plan_loads(hours.pending_hours_range(_span(spark, sf_dir)))


# Scalar expressions


@_query
def scalar_battery(spark, sf_dir):
    ts = F.col("ts")
    return a.events_table(spark, sf_dir).select(
        "event_id",
        F.to_date(ts).alias("date"),
        t.start_of_minute(ts).alias("minute"),
        t.start_of_hour(ts).alias("hour_start"),
        t.trunc_millis(ts).alias("millis"),
        t.yyyymm(ts).alias("yyyymm"),
        F.trunc(ts, "month").alias("month_start"),
        F.hour(ts).alias("hour"),
        F.date_format(ts, "yyyy-MM-dd").alias("date_text"),
        (F.to_date(ts) + F.expr("INTERVAL 1 MONTH")).alias("month_later"),
        (ts - F.expr("INTERVAL 1 MONTH")).alias("month_earlier"),
        (ts - F.make_dt_interval(secs=F.col("event_id") % 86400)).alias("seconds_earlier"),
        F.concat(F.lit("id_"), (1000 + F.col("event_id") % 9000).cast("string")).alias("label"),
        F.get_json_object("props", "$.k").try_cast("int").alias("k"),
    )


# Tables


@_query
def write_clustered(spark, sf_dir):
    table = ServingTable(spark, a.new_name("serving"), scratch_dir(spark, "serving")).create()
    table.append(a.serving_rows(spark, sf_dir))
    return table.read()


@_query
def drop_expired_days(spark, sf_dir):
    table = ServingTable(spark, a.new_name("recent"), scratch_dir(spark, "recent")).create()
    table.append(a.serving_rows(spark, sf_dir))
    table.drop_expired(AS_OF)
    return table.read().select(*SERVING.fieldNames())


@_query
def append_events(spark, sf_dir):
    table = a.empty_lake(spark, "append")
    rows = a.lake_rows(spark, sf_dir)
    table.append(rows.filter(F.col("created_at") <= t.ntz(SPLIT)))
    table.append(rows.filter(F.col("created_at") > t.ntz(SPLIT)))
    return _flat(table.read())


@_query
def replace_hour(spark, sf_dir):
    table = a.empty_lake(spark, "replace_hour")
    rows = a.lake_rows(spark, sf_dir)
    table.append(rows)
    start = dt.datetime.fromisoformat(SLICE_DAY) + dt.timedelta(hours=SLICE_HOUR)
    # the new hour has one event type less and another action
    new = rows.filter("type <> 'PushEvent'").withColumn("action", F.lit("replaced"))
    table.replace_from_table(new, start, start + dt.timedelta(hours=1))
    return _flat(table.read())


@_query
def replace_day(spark, sf_dir):
    table = a.empty_lake(spark, "replace_day")
    rows = a.lake_rows(spark, sf_dir)
    table.append(rows)
    start = dt.datetime.fromisoformat(SLICE_DAY)
    # the new day has no hour before noon
    new = rows.filter(F.hour("created_at") >= 12).withColumn("action", F.lit("replaced"))
    table.replace_from_table(new, start, start + dt.timedelta(days=1))
    return _flat(table.read())


@_query
def load_hour(spark, sf_dir):
    table = a.loaded_lake(spark, sf_dir, "load_hour")
    load.load_hour(table, a.landing(spark, sf_dir), SLICE_DAY, SLICE_HOUR, a.ARCHIVE_FOLDER)
    return _flat(table.read())


@_query
def load_day(spark, sf_dir):
    table = a.loaded_lake(spark, sf_dir, "load_day")
    load.load_day(table, a.landing(spark, sf_dir), SLICE_DAY, a.ARCHIVE_FOLDER)
    return _flat(table.read())


@_query
def load_range(spark, sf_dir):
    return _flat(a.loaded_lake(spark, sf_dir, "load_range").read())


@_query
def load_pending(spark, sf_dir):
    table = a.empty_lake(spark, "load_pending")
    first, _ = a.day_span(spark, sf_dir)
    load.load_range(table, a.landing(spark, sf_dir), first, FROM_DAY, a.ARCHIVE_FOLDER)
    mark = reads.last_event_date(table.read(), table.read().limit(0), NOW)
    load.load_pending(table, a.landing(spark, sf_dir), mark, NOW, a.ARCHIVE_FOLDER)
    return _flat(table.read())


@_query
def load_report(spark, sf_dir):
    first, last = a.day_span(spark, sf_dir)
    table = a.loaded_lake(spark, sf_dir, "load_report")
    counts = table.hour_counts(f"{first} 00:00:00", f"{last + dt.timedelta(days=1)} 00:00:00")
    return counts.select(F.col("hour").alias("archive_hour"), "rows")


@_query
def load_partial_landing(spark, sf_dir):
    # the table was loaded whole; now a seventh of the archives has left the landing folder
    table = a.loaded_lake(spark, sf_dir, "load_partial")
    load.load_range(table, a.gappy_landing(spark, sf_dir), *a.day_span(spark, sf_dir), a.ARCHIVE_FOLDER)
    return _flat(table.read())


@_query
def load_distant_edge(spark, sf_dir):
    # one row in 97 comes in the archive of another hour, up to a day away; hour loads follow the range load
    table = a.empty_lake(spark, "load_distant")
    landing = a.distant_landing(spark, sf_dir)
    load.load_range(table, landing, *a.day_span(spark, sf_dir, wider=1), a.ARCHIVE_FOLDER)
    for hour in (SLICE_HOUR, SLICE_HOUR + 3):
        load.load_hour(table, landing, SLICE_DAY, hour, a.ARCHIVE_FOLDER)
    return _flat(table.read())


@_query
def load_missing(spark, sf_dir):
    # a seventh of the archives lands late, after a catch-up has passed them
    table = a.empty_lake(spark, "load_missing")
    first, last = a.day_span(spark, sf_dir)
    until = f"{last + dt.timedelta(days=1)} 00:00:00"
    for landing in (a.gappy_landing(spark, sf_dir), a.landing(spark, sf_dir)):
        load.load_missing(table, landing, f"{first} 00:00:00", until, a.ARCHIVE_FOLDER)
    return _flat(table.read())


@_query
def load_ledger(spark, sf_dir):
    table = a.loaded_lake(spark, sf_dir, "load_ledger")
    return table.ledger().read().select(F.col("hour").alias("archive_hour"), "rows", "rejects")


@_query
def compact_while_reading(spark, sf_dir):
    # frames made before, between and after compactions, all computed in the end
    path = scratch_dir(spark, "compact_reading")
    rows = a.serving(spark, sf_dir).withColumn("part", F.minute("created_at") % 4)
    counts, members = a.day_states(spark, path)
    frames = []
    for part in range(4):
        stream_rollups.write_day_batch(rows.filter(F.col("part") == part), path, "historic", part)
        frames.append((counts.read(), members.read()))
        if part < 3:
            counts.compact()
            members.compact()
    # the last frame is of all parts; each earlier one still finds its files
    whole = rollups.merge_day(*frames[-1])
    seen = [rollups.merge_counts(f, "event_type").select("event_type", F.col("count").alias(f"upto_{i}")) for i, (f, _) in enumerate(frames)]
    totals = whole.groupBy("event_type").agg(F.sum("count").alias("count"), F.sum("actor_count").alias("actor_days"))
    for frame in seen:
        totals = totals.join(frame, "event_type")
    return totals


@_query
def append_historic_twice(spark, sf_dir):
    # the range is copied, merged, copied again, and merged again
    lake, path = a.shared_lake(spark, sf_dir), scratch_dir(spark, "twice")
    table = ServingTable(spark, a.new_name("twice"), scratch_dir(spark, "twice")).create()
    for _ in range(2):
        copies.append_historic(lake, table, path, FROM_TS, TO_TS)
        for state in a.day_states(spark, path):
            state.compact()
    return _table_and_rollup(spark, table, path)


@_query
def append_retry_after_compaction(spark, sf_dir):
    # a copy fails once its rows are in the table; states are merged; rows arrive; the copy is repeated
    lake, path = a.shared_lake(spark, sf_dir), scratch_dir(spark, "retry")
    table = ServingTable(spark, a.new_name("retry"), scratch_dir(spark, "retry")).create()
    copies.append_historic(lake, table, path, FROM_TS, SPLIT)
    early = copies.copy_historic(lake, SPLIT, TO_TS).filter(F.minute("created_at") < 40)
    copies.begin_copy(early, table, path, "historic", "late")
    for state in a.day_states(spark, path):
        state.compact()
    copies.append_copy(copies.copy_historic(lake, SPLIT, TO_TS), table, path, "historic", "late")
    for state in a.day_states(spark, path):
        state.compact()
    return _table_and_rollup(spark, table, path)


def _table_and_rollup(spark, table, path):
    """Rows of the table and events and actors of its rollup, day by day and type by type."""
    rows = table.read().groupBy(F.to_date("created_at").alias("date"), "event_type").agg(F.count("*").alias("rows"))
    counts, members = (state.read() for state in a.day_states(spark, path))
    merged = rollups.merge_counts(counts, "date", "event_type").join(rollups.merge_actors(members, "date", "event_type"), ["date", "event_type"])
    return rows.join(merged, ["date", "event_type"])


@_query
def compact_minute(spark, sf_dir):
    partials = _streamed_minutes(spark, sf_dir, stream_rollups.minute_writer)
    path = scratch_dir(spark, "compacted")
    write_rollup(rollups.compact(partials, MINUTE_KEYS, upto=1), path, MINUTE_KEYS)
    compacted = read_rollup(spark, path, MINUTE_PARTIAL)
    return rollups.merge_counts(rollups.with_live(compacted, partials), *MINUTE_KEYS)


@_query
def copy_to_rollup(spark, sf_dir):
    # each copy of a range adds its own batch to the daily rollup
    lake, path = a.shared_lake(spark, sf_dir), scratch_dir(spark, "copies")
    for batch_id, (start, end) in enumerate(((FROM_TS, SPLIT), (SPLIT, TO_TS))):
        copied = copies.copy_historic(lake, start, end)
        stream_rollups.write_day_batch(copied, path, "historic", batch_id)
    return _merged_days(spark, path)


@_query
def compact_day(spark, sf_dir):
    # two sources with unequal batch numbers, compacted twice with batches in between
    path = scratch_dir(spark, "compact_days")
    rows = a.serving(spark, sf_dir).withColumn("part", F.minute("created_at") % 5)
    counts, members = a.day_states(spark, path)

    def add(part, source, batch_id):
        # the same actors return in every part, so member sets of the batches overlap
        stream_rollups.write_day_batch(rows.filter(F.col("part") == part), path, source, batch_id)

    for part, source, batch_id in ((0, "historic", 0), (1, "historic", 1), (2, "rt", 7)):
        add(part, source, batch_id)
    for state in (counts, members):
        state.compact()
    add(3, "historic", 2)
    add(4, "rt", 8)
    for state in (counts, members):
        state.compact()
    return rollups.merge_day(counts.read(), members.read())


@_query
def append_rt_twice(spark, sf_dir):
    # copies append to both serving tables; the second recent copy finds nothing new
    lake, path = a.shared_lake(spark, sf_dir), scratch_dir(spark, "appended")
    historic = ServingTable(spark, a.new_name("historic"), scratch_dir(spark, "historic")).create()
    recent = ServingTable(spark, a.new_name("recent"), scratch_dir(spark, "recent")).create()
    copies.append_historic(lake, historic, path, "2023-12-31 00:00:00", SPLIT)
    for _ in range(2):
        copies.append_recent(lake, recent, historic.read(), path, NOW)
    counts = a.day_states(spark, path)[0].read()
    rows = historic.read().unionByName(recent.read()).groupBy(F.to_date("created_at").alias("date")).agg(F.count("*").alias("rows"))
    return rows.join(rollups.merge_counts(counts, "date"), "date")


@_query
def backfill_minute_rollup(spark, sf_dir):
    stored, minutes = scratch_dir(spark, "stored"), scratch_dir(spark, "minutes")
    copies.append_backfill(a.stored_messages(spark, sf_dir), stored, minutes, FROM_TS, TO_TS)
    stream = decode_messages(a.message_stream(spark, sf_dir))
    stream_rollups.maintain(stream, stream_rollups.minute_writer(minutes), scratch_dir(spark, "checkpoint")).awaitTermination()
    return rollups.merge_counts(a.minute_state(spark, minutes).read(), *MINUTE_KEYS)


def _merged_days(spark, path):
    return rollups.merge_day(*(state.read() for state in a.day_states(spark, path)))


# Streams


def _streamed_minutes(spark, sf_dir, writer):
    path = scratch_dir(spark, "minutes")
    stream = decode_messages(a.message_stream(spark, sf_dir))
    stream_rollups.maintain(stream, writer(path), scratch_dir(spark, "checkpoint")).awaitTermination()
    return a.minute_state(spark, path).batches()


def _twice(path):
    """Every batch is delivered again, as after a failure before its commit."""
    write = stream_rollups.minute_writer(path)

    def replay(batch, batch_id):
        write(batch, batch_id)
        write(batch, batch_id)

    return replay


@_query
def stream_ingest(spark, sf_dir):
    path = scratch_dir(spark, "ingest")
    ingest(a.message_stream(spark, sf_dir), path, scratch_dir(spark, "checkpoint")).awaitTermination()
    return spark.read.parquet(path).select("user_id", "timestamp", "event_type")


@_query
def stream_rejects(spark, sf_dir):
    path = scratch_dir(spark, "rejects")
    store_rejects(a.message_stream(spark, sf_dir), path, scratch_dir(spark, "checkpoint")).awaitTermination()
    return spark.read.text(path)


@_query
def stream_ingest_all(spark, sf_dir):
    # events and rejects from one reading of the topic
    path, rejects = scratch_dir(spark, "ingest"), scratch_dir(spark, "rejects")
    ingest_all(a.message_stream(spark, sf_dir), path, rejects, scratch_dir(spark, "checkpoint")).awaitTermination()
    taken = spark.read.parquet(path).select("user_id", "timestamp", "event_type", F.lit(None).cast("string").alias("value"))
    return taken.unionByName(spark.read.text(rejects).select("value"), allowMissingColumns=True)


@_query
def stream_minute_rollup(spark, sf_dir):
    partials = _streamed_minutes(spark, sf_dir, stream_rollups.minute_writer)
    return rollups.merge_counts(partials, *MINUTE_KEYS)


@_query
def stream_late_rows(spark, sf_dir):
    # every lane spans all minutes, so each later batch is late for the earlier ones
    return rollups.merge_counts(_streamed_minutes(spark, sf_dir, _twice), *MINUTE_KEYS)


@_query
def stream_day_rollup(spark, sf_dir):
    path = scratch_dir(spark, "days")
    for part, source in (("historic", "historic"), ("recent", "rt")):
        writer = stream_rollups.day_writer(path, source)
        stream = a.serving_stream(spark, sf_dir, part)
        stream_rollups.maintain(stream, writer, scratch_dir(spark, "checkpoint")).awaitTermination()
    return _merged_days(spark, path)


@_query
def stream_plus_backfill(spark, sf_dir):
    streamed = stream_ingest(spark, sf_dir)
    return streamed.unionByName(copies.backfill(a.stored_messages(spark, sf_dir), FROM_TS, TO_TS))
