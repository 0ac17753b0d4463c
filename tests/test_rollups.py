"""Rollups, merges, reads and copies."""

import datetime as dt
from collections import Counter, defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import content, serving, session_conf
from tidemark.operators import rollups
from tidemark.operators.events import between, default_empty, project_serving
from tidemark.plans.copies import append_historic, append_recent, backfill, copy_days, copy_historic, copy_rt
from tidemark.plans.reads import DEFAULT_END, DEFAULT_START, events_stats, last_event_date, top_repos
from tidemark.schemas import DAY_KEYS, DAY_MEMBER, DAY_PARTIAL, MINUTE_KEYS
from tidemark.sinks.rollups import read_rollup, write_rollup
from tidemark.sinks.state import RollupState
from tidemark.streaming.rollups import write_day_batch

D = dt.datetime
SCHEMA = "created_at TIMESTAMP_NTZ, event_type STRING, repo_name STRING, actor_login STRING"
PROPERTY = settings(
    max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)

EVENTS = st.lists(
    st.tuples(
        st.datetimes(D(2024, 1, 30), D(2024, 2, 3)),
        st.sampled_from(["WatchEvent", "PushEvent"]),
        st.sampled_from(["a", "b", None]),
        st.sampled_from(["u1", "u2", "u3", None]),
    ),
    max_size=40,
)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def expected(rows):
    counts, actors = Counter(), defaultdict(set)
    for at, kind, repo, actor in rows:
        key = (at.date(), kind, repo or "")
        counts[key] += 1
        actors[key] |= {actor} - {None}
    return sorted(((*key, n, len(actors[key])) for key, n in counts.items()), key=repr)


@given(rows=EVENTS, cut=st.integers(0, 40))
@PROPERTY
def test_rollup_of_parts_merges_to_rollup_of_whole(spark, rows, cut):
    parts = [frame(spark, rows[:cut]), frame(spark, rows[cut:])]
    partials = rollups.rollup_day(parts[0], "historic").union(rollups.rollup_day(parts[1], "rt"))
    members = rollups.day_members(parts[0], "historic").union(rollups.day_members(parts[1], "rt"))
    got = content(rollups.merge_day(partials, members), *DAY_KEYS, "count", "actor_count")
    assert got == expected(rows)


def test_null_actor_counts_as_event_but_not_as_actor(spark):
    events = frame(spark, [(D(2024, 1, 1), "T", "r", "u"), (D(2024, 1, 1), "T", "r", None)])
    merged = rollups.merge_day(rollups.rollup_day(events, "historic"), rollups.day_members(events, "historic"))
    assert content(merged, "count", "actor_count") == [(2, 1)]


def test_overlapping_sources_add_counts_but_not_actors(spark):
    events = frame(spark, [(D(2024, 1, 1), "T", "r", "u")])
    partials = rollups.rollup_day(events, "historic").union(rollups.rollup_day(events, "rt"))
    members = rollups.day_members(events, "historic").union(rollups.day_members(events, "rt"))
    assert content(rollups.merge_day(partials, members), "count", "actor_count") == [(2, 1)]
    one = partials.filter("source = 'historic'")
    assert content(rollups.merge_counts(one, "event_type"), "count") == [(1,)]


def test_actors_over_days_are_united(spark):
    events = frame(spark, [(D(2024, 1, d), "T", "r", "u") for d in (1, 2, 3)])
    members = rollups.day_members(events, "historic")
    assert content(rollups.merge_actors(members, "event_type"), "event_type", "actor_count") == [("T", 1)]


def test_rollup_written_without_members_keeps_its_counts(spark):
    events = frame(spark, [(D(2024, 1, 1), "T", "r", "u"), (D(2024, 1, 2), "T", "r", "u")])
    members = rollups.day_members(events, "historic").filter("date > '2024-01-01'")
    merged = rollups.merge_day(rollups.rollup_day(events, "historic"), members)
    assert content(merged, "date", "count", "actor_count") == [
        (dt.date(2024, 1, 1), 1, 0), (dt.date(2024, 1, 2), 1, 1)]


def test_written_rollup_is_sorted_and_pruned_by_month(spark, tmp_path):
    events = frame(spark, [(D(2024, m, d), f"T{d % 3}", f"r{d}", "u") for m in (1, 2) for d in range(1, 25)])
    path = str(tmp_path / "rollup")
    write_rollup(rollups.rollup_day(events, "historic"), path, ("event_type", "date", "repo_name"))
    stored = read_rollup(spark, path, DAY_PARTIAL)
    for file in (tmp_path / "rollup").glob("month=*/*.parquet"):
        keys = [tuple(r) for r in spark.read.parquet(str(file)).select("event_type", "date", "repo_name").collect()]
        assert keys == sorted(keys)
    report = top_repos(stored, "2024-02-01", "2024-02-03", group_by=["event_type"])
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "month#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert content(report, "event_type", "count") == [("T0", 1), ("T1", 1), ("T2", 1)]


@pytest.fixture(scope="module")
def rollup(spark):
    rows = []
    for n, repo in ((5, "a"), (3, "b"), (3, "c"), (1, "d")):
        rows += [(D(2025, 4, 12 + i), "WatchEvent" if i % 2 else "PushEvent", repo, "u") for i in range(n)]
    return rollups.rollup_day(frame(spark, rows), "historic")


def test_top_by_repo_breaks_ties_by_name(rollup):
    got = [tuple(r) for r in top_repos(rollup, group_by=["repo_name"], limit=3).collect()]
    assert got == [("a", 5), ("b", 3), ("c", 3)]


def test_top_window_is_closed_and_has_defaults(rollup):
    assert top_repos(rollup).collect()[0]["count"] == 12
    assert top_repos(rollup, "2025-04-13", "2025-04-14").collect()[0]["count"] == 6
    assert (DEFAULT_START, DEFAULT_END) == (dt.date(2025, 4, 12), dt.date(2025, 5, 16))


def test_top_filters_and_empty_total(rollup):
    got = top_repos(rollup, repo_names=["a", "b"], event_types=["WatchEvent"], group_by=["repo_name", "event_type"])
    assert [tuple(r) for r in got.collect()] == [("a", "WatchEvent", 2), ("b", "WatchEvent", 1)]
    assert [tuple(r) for r in top_repos(rollup, repo_names=[]).collect()] == [(0,)]
    assert top_repos(rollup, "2020-01-01", "2020-01-02", group_by=["date"]).collect() == []


def test_top_groups_by_known_columns_only(rollup):
    with pytest.raises(ValueError, match="actor"):
        top_repos(rollup, group_by=["actor"])


def test_counts_combine_before_the_shuffle(spark):
    plan = rollups.rollup_day(frame(spark, []), "rt")._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange hashpartitioning") < plan.index("partial_count")


def test_hot_key_equals_brute_force(spark):
    """One repository on one day holds most rows, with many actors."""
    n = 30000
    events = spark.range(n).select(
        F.lit(D(2024, 1, 1, 5)).cast("timestamp_ntz").alias("created_at"),
        F.lit("T").alias("event_type"),
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("r"), F.col("id") % 50)).alias("repo_name"),
        F.concat(F.lit("u"), F.col("id") % 7000).alias("actor_login"),
    )
    merged = rollups.merge_day(rollups.rollup_day(events, "rt"), rollups.day_members(events, "rt"))
    (hot,) = merged.filter("repo_name = 'hot'").collect()
    rows = [i for i in range(n) if i % 3 > 0]
    assert (hot["count"], hot["actor_count"]) == (len(rows), len({i % 7000 for i in rows}))
    assert merged.agg(F.sum("count")).first()[0] == n


def test_members_of_one_key_are_written_by_several_tasks(spark, tmp_path):
    one_key = spark.range(40000).select(
        F.lit(dt.date(2024, 1, 1)).alias("date"),
        F.lit("T").alias("event_type"),
        F.lit("hot").alias("repo_name"),
        F.uuid().alias("actor_login"),
    )
    write_rollup(one_key, str(tmp_path / "members"), ("event_type", "date", "repo_name"))
    assert len(list((tmp_path / "members").glob("month=202401/*.parquet"))) > 1


def _scanned(frame):
    """Rows that the scan handed on, after the row groups that it skipped."""
    frame.collect()
    leaves = frame._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_reads_of_one_repository_skip_row_groups(spark, tmp_path):
    """Every row group spans all names; too many for a dictionary, so only the filter can tell which has a repository."""
    many = spark.range(240_000).selectExpr(
        "DATE'2024-01-01' AS date", "concat('T', id % 8) AS event_type", "concat('some/longer-name-', id * 7919 % 240007) AS repo_name", "id AS cnt"
    )
    path = str(tmp_path / "rollup")
    with session_conf(spark, spark__sql__adaptive__advisoryPartitionSizeInBytes="64m"):
        write_rollup(many, path, ("event_type", "date", "repo_name"))
    stored = read_rollup(spark, path, DAY_PARTIAL)
    total = _scanned(stored.filter("cnt >= 0"))
    assert total == 240_000
    (there,) = many.filter("id = 77777").select("repo_name").first()
    one = stored.filter(F.col("repo_name").isin([there]))
    assert [r["cnt"] for r in one.collect()] == [77777]
    absent = stored.filter(F.col("repo_name").isin(["some/longer-name-1x", "some/longer-name-2x"]))
    assert absent.collect() == [] and _scanned(absent) == 0
    # without filters the same read goes through all rows
    plain = str(tmp_path / "plain")
    many.coalesce(1).write.option("parquet.bloom.filter.enabled", "false").parquet(plain)
    assert _scanned(spark.read.parquet(plain).filter(F.col("repo_name").isin(["some/longer-name-1x"]))) == 240_000


def test_top_needs_no_full_sort(rollup):
    plan = top_repos(rollup, group_by=["repo_name"])._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


def _minutes(spark):
    rows = [(D(2024, 1, 1, 0, m, s), "T") for m in (0, 1, 2, 3) for s in range(m + 1)]
    return rollups.rollup_minute(spark.createDataFrame(rows, "timestamp TIMESTAMP_NTZ, event_type STRING"))


def test_stats_range_is_closed_and_largest_first(spark):
    got = events_stats(_minutes(spark), "2024-01-01 00:01:00", "2024-01-01 00:02:00").collect()
    assert [(r["minute"].minute, r["count"]) for r in got] == [(2, 3), (1, 2)]


@given(
    batches=st.lists(st.lists(st.tuples(st.integers(0, 3), st.sampled_from("ab")), max_size=8), min_size=1, max_size=4),
    upto=st.integers(-1, 4),
)
@PROPERTY
def test_compaction_never_changes_the_answer(spark, batches, upto):
    rows = [(D(2024, 1, 1, 0, m), t, 1, i, 202401) for i, batch in enumerate(batches) for m, t in batch]
    partials = spark.createDataFrame(
        rows, "minute TIMESTAMP_NTZ, event_type STRING, cnt BIGINT, batch_id BIGINT, month INT"
    )
    compacted = rollups.compact(partials, MINUTE_KEYS, upto)
    want = content(rollups.merge_counts(partials, *MINUTE_KEYS), *MINUTE_KEYS, "count")
    kept = rollups.merge_counts(rollups.with_live(compacted, partials), *MINUTE_KEYS)
    assert content(kept, *MINUTE_KEYS, "count") == want
    if compacted.count():
        removed = partials.filter(F.col("batch_id") > upto)
        later = rollups.merge_counts(rollups.with_live(compacted, removed), *MINUTE_KEYS)
        assert content(later, *MINUTE_KEYS, "count") == want


def test_compacted_members_are_united(spark):
    seen = (("u", 0), ("u", 1), ("v", 2))
    rows = [(dt.date(2024, 1, 1), "T", "r", actor, "rt", batch, 202401) for actor, batch in seen]
    members = spark.createDataFrame(
        rows,
        "date DATE, event_type STRING, repo_name STRING, actor_login STRING, source STRING, batch_id BIGINT, month INT",
    )
    compacted = rollups.compact_members(members, 1)
    assert content(compacted, "actor_login", "batch_id") == [("u", 1)]
    assert content(rollups.with_live(compacted, members), "actor_login", "batch_id") == [("u", 1), ("v", 2)]


def _at(spark, *stamps):
    return spark.createDataFrame([(s,) for s in stamps], "created_at STRING").select(
        F.col("created_at").cast("timestamp_ntz").alias("created_at")
    )


def test_last_date_is_the_latest_of_both_tables(spark):
    old, new = _at(spark, "2024-03-01 10:00:00"), _at(spark, "2024-03-02 11:30:00", "2024-02-28 00:00:00")
    for recent, historic in ((old, new), (new, old)):
        assert last_event_date(recent, historic, "2024-03-05").first()[0] == D(2024, 3, 2, 11, 30)


@pytest.mark.parametrize("as_of, floor", [("2024-03-31 10:00:00", D(2024, 2, 29, 10)), ("2024-05-15", D(2024, 4, 15))])
def test_last_date_of_empty_or_old_tables_is_a_month_ago(spark, as_of, floor):
    for events in (_at(spark), _at(spark, "2020-01-01 00:00:00")):
        assert last_event_date(events, events, as_of).first()[0] == floor


LAKE_ROW = (
    "type STRING, created_at TIMESTAMP_NTZ, action STRING, actor STRUCT<id: STRING, login: STRING>,"
    " repo STRUCT<id: STRING, name: STRING>"
)


def _lake(spark, *stamps):
    rows = [("WatchEvent", D.fromisoformat(s), None, ("1", "ann"), ("2", "ann/tool")) for s in stamps]
    return spark.createDataFrame(rows, LAKE_ROW)


EDGES = ("2024-01-01 00:00:00", "2024-01-01 00:00:00.000001", "2024-01-02 00:00:00", "2024-01-02 00:00:00.000001")


def test_historic_copy_excludes_from_and_includes_to(spark):
    copied = copy_historic(_lake(spark, *EDGES), "2024-01-01", "2024-01-02")
    assert content(copied, "created_at") == [(D(2024, 1, 1),), (D(2024, 1, 2),)]


def test_recent_copy_by_range_or_high_water(spark):
    lake = _lake(spark, *EDGES)
    assert copy_rt(lake, "2024-01-01", "2024-01-02").count() == 2
    mark = _at(spark, "2024-01-02 00:00:00").withColumnRenamed("created_at", "last_date")
    # the mark is cut to milliseconds: a row that shares its millisecond is the marked one itself
    assert copy_rt(lake, high_water=mark).count() == 0
    assert copy_rt(_lake(spark, *EDGES, "2024-01-02 00:00:00.001"), high_water=mark).count() == 1
    with pytest.raises(ValueError, match="high-water"):
        copy_rt(lake, from_ts="2024-01-01")


@given(
    stamps=st.lists(st.datetimes(D(2024, 1, 1), D(2024, 1, 5)), max_size=20),
    first=st.integers(1, 3),
    length=st.integers(0, 2),
)
@PROPERTY
def test_one_ranged_copy_equals_a_copy_per_day(spark, stamps, first, length):
    lake = _lake(spark, *[s.isoformat(" ") for s in stamps], *EDGES)
    days = [dt.date(2024, 1, first + i) for i in range(length + 1)]
    tiled = [
        row
        for date in days
        for row in content(
            copy_historic(lake, D.combine(date, dt.time()), D.combine(date + dt.timedelta(days=1), dt.time())),
            "created_at",
        )
    ]
    assert content(copy_days(lake, days[0], days[-1]), "created_at") == sorted(tiled, key=repr)


def test_serving_projection_cuts_to_milliseconds_and_needs_a_time(spark):
    without_time = _lake(spark, EDGES[0]).withColumn("created_at", F.lit(None))
    lake = _lake(spark, "2024-01-01 00:00:00.123999").union(without_time)
    assert content(project_serving(lake), "actor_login", "repo_name", "created_at") == [
        ("ann", "ann/tool", D(2024, 1, 1, 0, 0, 0, 123000))]


def test_absent_names_become_empty(spark):
    rows = spark.sql("SELECT CAST(NULL AS STRING) AS actor_login, CAST(NULL AS STRING) AS repo_name")
    assert content(default_empty(rows), "actor_login", "repo_name") == [("", "")]


def test_backfill_is_closed_and_renames(spark):
    rows = [(1, D.fromisoformat(s), "T") for s in EDGES] + [(3_000_000_000, D(2024, 1, 1, 12), "T")]
    stored = spark.createDataFrame(rows, "user_id BIGINT, ts TIMESTAMP_NTZ, event_type STRING")
    copied = backfill(stored, "2024-01-01", "2024-01-02")
    assert copied.columns == ["user_id", "timestamp", "event_type"]
    assert copied.count() == 4 and copied.filter("user_id IS NULL").count() == 1


def test_closed_range_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "events")
    _at(spark, *EDGES).write.parquet(path)
    plan = between(spark.read.parquet(path), "2024-01-01", "2024-01-02")._jdf.queryExecution().executedPlan().toString()
    # the plan text is cut off after the start of the second bound
    assert "GreaterThanOrEqual(created_at,2024-01-01T00:00), LessThanOrEqual(created_" in plan


def _batch(spark, *rows):
    schema = "date DATE, event_type STRING, repo_name STRING, cnt BIGINT, source STRING, run STRING, batch_id BIGINT, month INT"
    return spark.createDataFrame([(dt.date(2024, 1, 1), "T", "r", n, s, r, b, 202401) for s, r, b, n in rows], schema)


def test_live_batches_of_each_stream_stay(spark):
    """Compacting one source must not cover batches of another, nor of another run."""
    state = _batch(spark, ("rt", "a", 0, 1), ("rt", "a", 2, 1), ("historic", "a", 0, 1), ("historic", "a", 1, 1), ("rt", "b", 1, 1))
    compacted = rollups.compact(state.filter("source = 'rt' AND run = 'a'"), DAY_KEYS, upto=2)
    assert content(rollups.merge_counts(rollups.with_live(compacted, state), "event_type"), "count") == [(5,)]


def test_state_of_one_aggregation_equals_counts_and_members(spark):
    rows = [(D(2024, 1, d, h), "T", r, a) for d in (1, 2) for h in (1, 2) for r in ("x", None) for a in ("u", "v", None)]
    events = frame(spark, rows)
    state = rollups.day_state(events)
    assert content(rollups.counts_of(state), *DAY_KEYS, "cnt") == content(rollups.rollup_day(events, "s"), *DAY_KEYS, "cnt")
    assert content(rollups.members_of(state), *DAY_KEYS, "actor_login") == content(rollups.day_members(events, "s"), *DAY_KEYS, "actor_login")
    merged = rollups.merge_states(state, state)
    assert content(merged, *DAY_KEYS, "count", "actor_count") == sorted([(d, t, r, 2 * n, a) for d, t, r, n, a in expected(rows)], key=repr)
    plan = rollups.merge_states(state)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") == 1


@pytest.fixture
def day_state(spark, tmp_path):
    path = str(tmp_path / "days")
    counts = RollupState(spark, f"{path}/counts", DAY_PARTIAL, ("event_type", "date", "repo_name"))
    members = RollupState(spark, f"{path}/members", DAY_MEMBER, ("event_type", "date", "repo_name"))

    def total():
        merged = rollups.merge_day(counts.read(), members.read())
        return tuple(merged.agg(F.sum("count"), F.sum("actor_count")).first())

    return path, counts, members, total


def test_compaction_job(spark, day_state, tmp_path):
    path, counts, members, total = day_state
    events = frame(spark, [(D(2024, m, d), "T", "r", f"u{d % 3}") for m in (1, 2) for d in range(1, 11)])
    for source, run, batch in (("historic", "a", 0), ("historic", "a", 1), ("rt", "a", 0), ("rt", "b", 0)):
        write_day_batch(events, path, source, batch, run)
    assert total() == (80, 20)
    for generation in (1, 2):
        assert counts.compact() == generation and members.compact() == generation
        assert total() == (80, 20)
        assert counts.batches().count() == 0
    write_day_batch(events, path, "rt", 1, "a")
    write_day_batch(events, path, "rt", 0, "a")  # a merged batch comes again and stays covered
    write_day_batch(events, path, "rt", 0, "c")
    assert total() == (120, 20)
    assert counts.compact() == 3 and total() == (120, 20)
    stored = top_repos(counts.read(), "2024-02-01", "2024-02-05", group_by=["event_type"])
    assert content(stored, "count") == [(30,)]


def test_compaction_that_fails_can_be_repeated(spark, day_state, monkeypatch):
    path, counts, members, total = day_state
    events = frame(spark, [(D(2024, 1, d), "T", "r", "u") for d in range(1, 4)])
    for batch in range(3):
        write_day_batch(events, path, "rt", batch)

    def lost(*_):
        raise RuntimeError("lost")

    for place, published in (("tidemark.sinks.state.write_rollup", 0), ("tidemark.sinks.state.RollupState.remove_merged", 1)):
        with monkeypatch.context() as patch:
            patch.setattr(place, lost)
            with pytest.raises(RuntimeError, match="lost"):
                counts.compact()
        assert counts.generation() == published and total()[0] == 9
    counts.compact()
    assert total() == (9, 3) and counts.batches().count() == 0


def test_recent_copies_chain_into_tables_and_rollups(spark, tmp_path):
    lake = _lake(spark, "2024-01-01 10:00:00.123456", "2024-01-02 10:00:00", "2024-01-03 10:00:00.999999")
    historic, recent = serving(spark, tmp_path), serving(spark, tmp_path)
    path = str(tmp_path / "chain")
    append_historic(lake, historic, path, "2024-01-01", "2024-01-02")
    for _ in range(2):
        append_recent(lake, recent, historic.read(), path, "2024-01-04")
    assert (historic.read().count(), recent.read().count()) == (1, 2)
    counts = RollupState(spark, f"{path}/counts", DAY_PARTIAL, DAY_KEYS).read()
    assert content(rollups.merge_counts(counts, "source"), "source", "count") == [("historic", 1), ("rt", 2)]
