"""Mergeable rollups: partial counts and exact-distinct members.

Every aggregate here combines on the map side first, so a repository or type
that holds a third of all events sends one partial row per input task, not its
events. Distinct actors are shuffled by the full member key, which spreads a hot
repository over all tasks.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.time import start_of_minute
from tidemark.schemas import DAY_KEYS


def _day_keys() -> list[Column]:
    return [
        F.to_date("created_at").alias("date"),
        F.coalesce("event_type", F.lit("")).alias("event_type"),
        F.coalesce("repo_name", F.lit("")).alias("repo_name"),
    ]


def day_state(events: DataFrame) -> DataFrame:
    """Events per day key and actor: one aggregation that holds both the counts and the members."""
    return events.groupBy(*_day_keys(), "actor_login").agg(F.count("*").alias("cnt"))


def counts_of(state: DataFrame) -> DataFrame:
    """Partial counts of a :func:`day_state`."""
    return state.groupBy(*DAY_KEYS).agg(F.sum("cnt").alias("cnt"))


def members_of(state: DataFrame) -> DataFrame:
    """Members of a :func:`day_state`, each once, with its events; these make a set of members additive."""
    return state.filter(F.col("actor_login").isNotNull()).select(*DAY_KEYS, "actor_login", "cnt")


def difference(new: DataFrame, old: DataFrame) -> DataFrame:
    """What a state of :func:`day_state`, or partial counts, must gain to become ``new`` instead of ``old``."""
    keys = [name for name in new.columns if name != "cnt"]
    less = old.select(*keys, (-F.col("cnt")).alias("cnt"))
    return new.unionByName(less).groupBy(*keys).agg(F.sum("cnt").alias("cnt")).filter("cnt <> 0")


def present(members: DataFrame) -> DataFrame:
    """Members without those taken back; rows from before members had a count say that they are there."""
    if "cnt" not in members.columns:
        return members
    return members.groupBy(*DAY_KEYS, "actor_login").agg(_total().alias("cnt")).filter("cnt > 0").drop("cnt")


def _total() -> Column:
    return F.sum(F.coalesce("cnt", F.lit(1)))


def merge_states(*states: DataFrame) -> DataFrame:
    """Counts and exact distinct actors per day key over several states of :func:`day_state`.

    The states meet by key and actor, which spreads a hot key over all tasks, and then by key.
    """
    together = reduce(DataFrame.unionByName, states).groupBy(*DAY_KEYS, "actor_login").agg(F.sum("cnt").alias("cnt"))
    return together.groupBy(*DAY_KEYS).agg(F.sum("cnt").alias("count"), F.count("actor_login").alias("actor_count"))


def rollup_day(events: DataFrame, source: str) -> DataFrame:
    """Partial event counts per date, type and repository, tagged with their source."""
    return events.groupBy(*_day_keys()).agg(F.count("*").alias("cnt")).withColumn("source", F.lit(source))


def day_members(events: DataFrame, source: str) -> DataFrame:
    """The set of actors per date, type and repository, one row per member; NULL is no member."""
    members = events.filter(F.col("actor_login").isNotNull()).select(*_day_keys(), "actor_login").distinct()
    return members.withColumn("source", F.lit(source))


def rollup_minute(events: DataFrame) -> DataFrame:
    """Partial event counts per minute and type."""
    return events.groupBy(start_of_minute(F.col("timestamp")).alias("minute"), "event_type").agg(
        F.count("*").alias("cnt")
    )


def merge_counts(partials: DataFrame, *by: str) -> DataFrame:
    """Add partial counts up to any coarser grain."""
    return partials.groupBy(*by).agg(F.sum("cnt").alias("count")).filter("count <> 0")


def merge_actors(members: DataFrame, *by: str) -> DataFrame:
    """Exact distinct actors at any coarser grain; member sets overlap, so they are united, not summed."""
    return present(members).groupBy(*by).agg(F.count_distinct("actor_login").alias("actor_count"))


def merge_day(partials: DataFrame, members: DataFrame) -> DataFrame:
    """Counts and distinct actors per day key; keys without members get the empty state.

    Two shuffles: by key and actor, which spreads a hot key, and by key.

    Rollups written before member sets were kept have counts only.
    """
    both = partials.select(*DAY_KEYS, "cnt", F.lit(None).cast("string").alias("actor_login")).unionByName(
        present(members).select(*DAY_KEYS, F.lit(None).cast("bigint").alias("cnt"), "actor_login")
    )
    merged = both.groupBy(*DAY_KEYS).agg(
        F.sum("cnt").alias("count"), F.count_distinct("actor_login").alias("actor_count")
    )
    return merged.filter("count <> 0")


def _settled(state: DataFrame, upto: int) -> DataFrame:
    return state.filter(F.col("batch_id") <= upto)


def _streams(state: DataFrame) -> list[str]:
    """The columns that tell apart streams, each of which numbers its batches on its own."""
    return [name for name in ("source", "run") if name in state.columns]


def merge_partials(state: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """One partial row per key, counts of events added up; what adds up to nothing goes."""
    return state.groupBy(*keys).agg(_total().alias("cnt")).filter("cnt <> 0")


def compact(partials: DataFrame, keys: tuple[str, ...], upto: int) -> DataFrame:
    """Merge the partial counts of all batches up to ``upto`` into one row per key and stream, stamped with ``upto``."""
    by = dict.fromkeys((*keys, *_streams(partials), "month"))
    merged = _settled(partials, upto).groupBy(*by).agg(F.sum("cnt").alias("cnt"))
    return merged.withColumn("batch_id", F.lit(upto).cast("bigint"))


def compact_members(members: DataFrame, upto: int) -> DataFrame:
    """The same for member sets: their union, one row per member and stream."""
    united = _settled(members, upto).drop("batch_id").distinct()
    return united.withColumn("batch_id", F.lit(upto).cast("bigint"))


def uncovered(state: DataFrame, covered: DataFrame) -> DataFrame:
    """Rows of batches after the ``upto`` of their stream; streams that are not in ``covered`` stay whole.

    ``covered`` has one row for each stream, so it is small whatever the state holds.
    """
    by = _streams(covered)
    marks = covered.select(*(F.col(name).alias(f"_{name}") for name in by), "upto")
    # streams written before they had a name have a null one
    same = reduce(and_, (F.col(name).eqNullSafe(F.col(f"_{name}")) for name in by), F.lit(True))
    later = state.join(F.broadcast(marks), same, "left")
    return later.filter(F.col("upto").isNull() | (F.col("batch_id") > F.col("upto"))).select(*state.columns)


def with_live(compacted: DataFrame, state: DataFrame) -> DataFrame:
    """Compacted rows plus the batches that they do not cover yet, stream by stream.

    The stamp decides which batches count, so answers stay the same whether the
    merged batches have been removed already or not.
    """
    covered = compacted.groupBy(*_streams(compacted)).agg(F.max("batch_id").alias("upto"))
    return compacted.unionByName(uncovered(state, covered))
