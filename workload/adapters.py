"""The test table ``events`` in the shapes the library works on.

Everything is derived by Spark from the whole table, so it grows with it.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.payload import derive_columns
from tidemark.functions.time import ntz
from tidemark.operators.bitmaps import ActorDictionary, actor_bitmaps
from tidemark.operators.events import project_serving
from tidemark.plans.load import load_range
from tidemark.schemas import DAY_MEMBER, DAY_PARTIAL, MINUTE_KEYS, MINUTE_PARTIAL, SERVING
from tidemark.session import scratch_dir
from tidemark.sinks.hierarchy import CoarseRollup
from tidemark.sinks.state import RollupState
from tidemark.sinks.tables import LakeTable, ServingTable
from tidemark.sources.archive import conform_to_lake
from tidemark.sources.items import generate_items
from tidemark.sources.messages import decode_messages, file_messages
from tidemark.streaming.rollups import write_day_batch, write_minute_batch

# Test event types and the archive types they stand for.
TYPE_NAMES = {
    "click": "WatchEvent",
    "view": "PushEvent",
    "purchase": "IssuesEvent",
    "signup": "CreateEvent",
    "error": "PullRequestEvent",
}

# Archives written by Spark are folders of this name.
ARCHIVE_FOLDER = "archive={stem}.json.gz"

#: Input files that a micro-batch takes.
FILES_PER_TRIGGER = 2

ITEM_NOW = "2025-05-20 11:07:38"

# The historic part ends after the recent part begins.
HISTORIC_UNTIL = "2024-01-20 00:00:00"
RECENT_AFTER = "2024-01-15 00:00:00"

_built: dict[tuple[str, str, str], str] = {}


def _once(spark: SparkSession, sf_dir: str, label: str, build) -> str:
    """Build a derived input once per application and return its place."""
    key = (spark.sparkContext.applicationId, sf_dir, label)
    if key not in _built:
        _built[key] = build()
    return _built[key]


def events_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _text(value: Column) -> Column:
    return value.cast("string")


def _unset_if(condition: Column, value: Column) -> Column:
    return F.when(~condition, value)


def _lake_source(events: DataFrame, *more: str) -> DataFrame:
    """Archive-shaped rows, payload as JSON text, before any derived column; and further columns as they are."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    user = F.col("user_id")
    names = F.create_map(*[F.lit(text) for pair in TYPE_NAMES.items() for text in pair])
    login = F.concat(F.lit("u"), _text(user))
    verb = F.when(k % 3 == 0, "opened").when(k % 3 == 1, "closed").otherwise("started")
    payload = F.concat(
        F.lit("{"),
        F.when(k % 7 == 0, "").otherwise(F.concat(F.lit('"action":"'), verb, F.lit('",'))),
        F.lit('"ref":"refs/heads/b'), _text(k),
        F.lit('","ref_type":"'), F.when(k % 2 == 0, "branch").otherwise("tag"),
        F.lit('","number":'), _text(k), F.lit("}"),
    )
    actor = F.struct(
        _text(user).alias("id"),
        login.alias("login"),
        _unset_if(user % 5 == 0, login).alias("display_login"),
        F.lit("").alias("gravatar_id"),
        F.concat(F.lit("https://example.org/users/"), login).alias("url"),
        F.lit(None).cast("string").alias("avatar_url"),
    )
    repo = F.struct(
        _text(k).alias("id"),
        F.concat(F.lit("repo/"), _text(k)).alias("name"),
        F.concat(F.lit("https://example.org/repos/"), _text(k)).alias("url"),
    )
    org = F.struct(
        _text(user % 10).alias("id"),
        F.concat(F.lit("org"), _text(user % 10)).alias("login"),
        F.lit("").alias("gravatar_id"),
        F.lit(None).cast("string").alias("url"),
        F.lit(None).cast("string").alias("avatar_url"),
    )
    return events.select(
        _text(F.col("event_id")).alias("id"),
        names[F.col("event_type")].alias("type"),
        F.col("ts").alias("created_at"),
        (user % 2 == 0).alias("public"),
        _unset_if(user % 29 == 0, actor).alias("actor"),
        repo.alias("repo"),
        _unset_if(user % 3 == 0, org).alias("org"),
        payload.alias("payload"),
        *more,
    )


def lake_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lake-shaped events, straight from the test table."""
    return conform_to_lake(derive_columns(_lake_source(events_table(spark, sf_dir))))


def serving_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project_serving(lake_rows(spark, sf_dir))


def serving(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored serving table that queries only read."""

    def build() -> str:
        table = ServingTable(spark, new_name("serving"), scratch_dir(spark, "serving")).create()
        table.append(serving_rows(spark, sf_dir))
        return table.name

    return ServingTable(spark, _once(spark, sf_dir, "serving", build)).read()


def gappy_landing(spark: SparkSession, sf_dir: str) -> str:
    """The archives of the landing folder but for one hour in seven, which never arrived."""
    return landing(spark, sf_dir, gaps=True)


def gappy_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lake loaded from the landing folder with gaps."""

    def build() -> str:
        table = empty_lake(spark, "gappy")
        load_range(table, gappy_landing(spark, sf_dir), *day_span(spark, sf_dir), ARCHIVE_FOLDER)
        return table.name

    return spark.table(_once(spark, sf_dir, "gappy lake", build))


def distant_landing(spark: SparkSession, sf_dir: str) -> str:
    """The archives of all events; some rows are in one that is up to a day before or after their hour."""
    return landing(spark, sf_dir, distant=True)


def archive_lines(events: DataFrame, gaps: bool = False, distant: bool = False) -> DataFrame:
    """JSON lines of the events and the archive that each is in.

    The rows are shuffled, not the far longer lines, which are then built by as many tasks, however few the input has.
    """
    shift = F.when(F.col("event_id") % 97 == 0, F.col("event_id") % 49 - 24).otherwise(0) if distant else F.lit(0)
    hour = F.col("ts") + F.make_dt_interval(hours=shift.cast("int"))
    if gaps:
        events = events.filter((F.day("ts") * 24 + F.hour("ts")) % 7 != 3)
    stem = F.concat(F.date_format(hour, "yyyy-MM-dd"), F.lit("-"), _text(F.hour(hour)))
    placed = events.withColumn("archive", F.concat(stem, F.lit(".json.gz"))).hint("rebalance", "archive")
    stamp = F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    fields = F.struct("id", "type", stamp.alias("created_at"), "public", "actor", "repo", "org")
    line = F.concat(F.lit('{"payload":'), F.col("payload"), F.lit(","), F.substr(F.to_json(fields), F.lit(2)))
    return _lake_source(placed, "archive").select(line.alias("value"), "archive")


def landing(spark: SparkSession, sf_dir: str, gaps: bool = False, distant: bool = False) -> str:
    """Gzip JSON archives of all events, one folder per UTC hour."""

    def build() -> str:
        path = scratch_dir(spark, "landing")
        lines = archive_lines(events_table(spark, sf_dir), gaps, distant)
        lines.write.partitionBy("archive").option("compression", "gzip").text(path)
        return path

    return _once(spark, sf_dir, f"landing {gaps} {distant}", build)


def day_states(spark: SparkSession, path: str) -> tuple[RollupState, RollupState]:
    """The stored counts and members of a daily rollup."""
    keys = ("event_type", "date", "repo_name")
    return RollupState(spark, f"{path}/counts", DAY_PARTIAL, keys), RollupState(spark, f"{path}/members", DAY_MEMBER, keys)


def minute_state(spark: SparkSession, path: str) -> RollupState:
    return RollupState(spark, path, MINUTE_PARTIAL, MINUTE_KEYS)


def day_counts(spark: SparkSession, sf_dir: str) -> RollupState:
    """Stored daily counts of all events: two sources, three compacted batches and two later ones."""

    def build() -> str:
        path = scratch_dir(spark, "days")
        rows = serving(spark, sf_dir).withColumn("part", F.minute("created_at") % 5)
        for part, source, batch_id in ((0, "historic", 0), (1, "historic", 1), (2, "rt", 4), (3, "historic", 2), (4, "rt", 5)):
            write_day_batch(rows.filter(F.col("part") == part), path, source, batch_id)
            if part == 2:
                day_states(spark, path)[0].compact()
        return path

    return day_states(spark, _once(spark, sf_dir, "days", build))[0]


def coarse_days(spark: SparkSession, sf_dir: str) -> CoarseRollup:
    """Month and year partials of all events' daily counts, and one batch more that they do not have."""

    def build() -> str:
        path = scratch_dir(spark, "coarse")
        rows = serving(spark, sf_dir).withColumn("part", F.minute("created_at") % 3)
        state = day_states(spark, path)[0]
        for part in range(3):
            write_day_batch(rows.filter(F.col("part") == part), path, "historic", part)
            if part < 2:
                state.compact()
                CoarseRollup(spark, state).refresh()
        return path

    return CoarseRollup(spark, day_states(spark, _once(spark, sf_dir, "coarse", build))[0])


def stored_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bitmaps of the actors of each date and type, made in two parts between which the dictionary grew."""

    def build() -> str:
        path = scratch_dir(spark, "bitmaps")
        dictionary = ActorDictionary(spark, f"{path}/actors")
        rows = serving(spark, sf_dir).withColumn("date", F.to_date("created_at"))
        for part in range(2):
            own = rows.filter(F.minute("created_at") % 2 == part)
            dictionary.extend(own)
            state = actor_bitmaps(own, dictionary.read(), "date", "event_type")
            state.write.parquet(f"{path}/state/part={part}")
        return path

    schema = "date DATE, event_type STRING, bucket BIGINT, bits BINARY"
    return spark.read.schema(schema).parquet(f"{_once(spark, sf_dir, 'bitmaps', build)}/state").drop("part")


def minute_counts(spark: SparkSession, sf_dir: str) -> RollupState:
    """Stored minute counts of all readable messages: a stream in two batches, the first compacted."""

    def build() -> str:
        path = scratch_dir(spark, "minute-counts")
        rows = decode_messages(spark.read.text(message_files(spark, sf_dir)).select("value"))
        for batch_id in (0, 1):
            part = rows.filter(F.pmod(F.second("timestamp"), F.lit(2)) == batch_id)
            write_minute_batch(part, path, "stream", "first", batch_id)
            if not batch_id:
                minute_state(spark, path).compact()
        return path

    return minute_state(spark, _once(spark, sf_dir, "minute counts", build))


def day_span(spark: SparkSession, sf_dir: str, wider: int = 0) -> tuple:
    """First and last date of the events, or some days more either side."""
    dates = F.to_date("ts")
    row = events_table(spark, sf_dir).agg(F.min(dates).alias("first"), F.max(dates).alias("last")).first()
    more = dt.timedelta(days=wider)
    return row["first"] - more, row["last"] + more


def new_name(label: str) -> str:
    return f"tidemark_{label}_{uuid.uuid4().hex}"


def empty_lake(spark: SparkSession, label: str) -> LakeTable:
    return LakeTable(spark, new_name(label), scratch_dir(spark, label)).create()


def loaded_lake(spark: SparkSession, sf_dir: str, label: str) -> LakeTable:
    """A lake table of its own, loaded from all archives."""
    table = empty_lake(spark, label)
    load_range(table, landing(spark, sf_dir), *day_span(spark, sf_dir), ARCHIVE_FOLDER)
    return table


def shared_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A loaded lake table that queries only read."""
    name = _once(spark, sf_dir, "lake", lambda: loaded_lake(spark, sf_dir, "lake").name)
    return spark.table(name)


def message_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic messages as JSON text, with some that are cut off, lack a field or overflow."""
    user = F.when(F.col("user_id") == 7, F.lit(3000000000)).otherwise(F.col("user_id"))
    full = F.to_json(
        F.struct(
            user.alias("user_id"),
            F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"),
            _unset_if(F.col("user_id") == 11, F.col("event_type")).alias("event_type"),
        )
    )
    value = F.when(F.col("user_id") == 13, F.concat(F.lit("!"), F.col("event_type"))).otherwise(full)
    return events_table(spark, sf_dir).select(value.alias("value"), (F.col("user_id") % 4).alias("lane"))


def message_files(spark: SparkSession, sf_dir: str) -> str:
    """All messages as text files in four lanes, each covering the whole time range."""

    def build() -> str:
        path = scratch_dir(spark, "messages")
        # files by size: as many as the input tasks, each batch of a stream would be the smaller the more tasks there are
        message_rows(spark, sf_dir).hint("rebalance", "lane").write.partitionBy("lane").text(path)
        return path

    return _once(spark, sf_dir, "messages", build)


def message_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messages as a stream; the four lanes give at least two micro-batches."""
    return file_messages(spark, message_files(spark, sf_dir), max_files_per_trigger=FILES_PER_TRIGGER)


def serving_files(spark: SparkSession, sf_dir: str) -> str:
    """Serving rows as files in four lanes; the historic and recent parts overlap."""

    def build() -> str:
        path = scratch_dir(spark, "serving_files")
        rows = serving_rows(spark, sf_dir).withColumn("lane", F.pmod(F.hash("created_at"), F.lit(4))).hint("rebalance", "lane")
        rows.filter(F.col("created_at") <= ntz(HISTORIC_UNTIL)).write.partitionBy("lane").parquet(f"{path}/historic")
        rows.filter(F.col("created_at") > ntz(RECENT_AFTER)).write.partitionBy("lane").parquet(f"{path}/recent")
        return path

    return _once(spark, sf_dir, "serving_files", build)


def serving_stream(spark: SparkSession, sf_dir: str, part: str) -> DataFrame:
    """One part of the serving rows as a stream of several micro-batches."""
    reader = spark.readStream.schema(SERVING).option("maxFilesPerTrigger", FILES_PER_TRIGGER)
    return reader.parquet(f"{serving_files(spark, sf_dir)}/{part}").select(*SERVING.fieldNames())


def stored_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lake copy of the topic: one row per event with its own time column."""
    return events_table(spark, sf_dir).select("user_id", "ts", "event_type")


def item_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_table(spark, sf_dir).select(F.col("event_id").alias("id"))


def item_files(spark: SparkSession, sf_dir: str) -> str:
    """Generated items as newline JSON."""

    def build() -> str:
        path = scratch_dir(spark, "items")
        items = generate_items(item_ids(spark, sf_dir), ITEM_NOW)
        items.withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss")).write.json(path)
        return path

    return _once(spark, sf_dir, "items", build)
