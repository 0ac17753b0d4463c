"""Partitioned catalog tables with repeatable slice replacement.

The lake is partitioned by date and hour of the event and by the archive that the row came from. Rows outside
the hour of their archive, distant ones, share a partition of their date and archive, whatever their hours. An
archive is the unit in which rows arrive and are replaced: replacing one writes its
partitions, wherever in time its rows lie, reads back no more than the times of its distant rows, for the report, and leaves the rows
of other archives alone. No event type can leave stale rows behind, and a busy type does not become
one busy partition. Rows are sorted by type inside each file, so a type filter
still skips row groups. The serving table is partitioned by date and by the run that copied the rows, so that
a run that is repeated replaces its own.

Overwriting replaces only the partitions that receive rows. That mode is an
option of the table itself: as an option of a write Spark ignores it for catalog
tables, and as a session setting it could change under a parallel job.
"""

from __future__ import annotations

import datetime as dt
import threading
from collections.abc import Collection, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, TimestampNTZType

from tidemark.functions.time import Moment, moment, start_of_hour, within
from tidemark.operators.events import DISTANT, partition_bounds, time_slice
from tidemark.operators.hours import row_hours
from tidemark.operators.retention import retention_floor
from tidemark.schemas import LAKE, SERVING
from tidemark.session import path_exists, remove_paths
from tidemark.sinks.ledger import LoadLedger

# The name Spark gives to the partition of rows whose key is NULL.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"

# Slices that share a partition of distant rows are replaced one after the other.
_REWRITING = threading.Lock()


@dataclass(frozen=True)
class SliceReport:
    """What one replacement did.

    ``written`` and ``hours`` are counted by the tasks that write. ``outside``
    (rows left out) is counted before the shuffle, if there is one, where a task
    repeated after a lost executor counts its rows again; it is exact otherwise.
    """

    written: int
    outside: int
    hours: list[dt.datetime]
    emptied: list[dt.datetime]


class PartitionedTable:
    """A Parquet table of the session catalog, partitioned by columns derived from created_at."""

    schema: StructType
    partitions: dict[str, tuple[str, str]]  # column -> (type, expression)

    def __init__(self, spark: SparkSession, name: str, location: str | None = None):
        self.spark = spark
        self.name = name
        self.location = location

    def create(self) -> PartitionedTable:
        """Make the table; one that lost its catalog entry is taken over with all partitions at its location.

        A location that holds files of another layout is refused.
        """
        known = self.spark.catalog.tableExists(self.name)
        kept = bool(self.location) and not known and self._holds_rows()
        columns = [f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema]
        columns += [f"{name} {kind}" for name, (kind, _) in self.partitions.items()]
        location = f" LOCATION '{self.location}'" if self.location else ""
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} ({', '.join(columns)}) USING parquet "
            f"OPTIONS (partitionOverwriteMode 'dynamic') PARTITIONED BY ({', '.join(self.partitions)}){location}"
        )
        if kept:
            self.spark.sql(f"ALTER TABLE {self.name} RECOVER PARTITIONS")
        return self

    def _holds_rows(self) -> bool:
        """Whether the location holds files of this layout."""
        if not path_exists(self.spark, self.location):
            return False
        try:
            found = self.spark.read.option("basePath", self.location).parquet(self.location)
        except AnalysisException as error:
            if error.getCondition() == "UNABLE_TO_INFER_SCHEMA":
                return False  # a folder without files
            raise
        wanted = [*self.schema.fieldNames(), *self.partitions]
        if found.columns != wanted:
            raise ValueError(f"{self.location} holds columns {found.columns}, not {wanted}")
        return True

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def _partitioned(self, rows: DataFrame) -> DataFrame:
        """Rows in table order with their partition columns last."""
        return rows.to(self.schema).withColumns(
            {name: F.expr(expression) for name, (_, expression) in self.partitions.items()}
        )

    def _spec(self, values: dict[str, str]) -> str:
        literal = {"DATE": "DATE '{}'", "STRING": "'{}'", "INT": "{}"}
        return ", ".join(f"{k} = {literal[self.partitions[k][0]].format(v)}" for k, v in values.items())

    def partition_values(self, **given: str) -> list[dict[str, str]]:
        """Partition keys from the catalog that have the given values; touches no data."""
        within_spec = f" PARTITION ({self._spec(given)})" if given else ""
        listed = self.spark.sql(f"SHOW PARTITIONS {self.name}{within_spec}").collect()
        return [dict(part.split("=", 1) for part in row.partition.split("/")) for row in listed]

    def _described(self) -> dict[str, str]:
        return dict(row[:2] for row in self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name}").collect())

    def drop_partitions(self, parts: Sequence[dict[str, str]]) -> None:
        """Remove partitions and their files: folders several at a time, catalog entries by one statement.

        Files go first: after a failure in between the entries are still listed, and the
        call can be repeated.
        """
        if not parts:
            return
        root = self._described()["Location"].rstrip("/")
        remove_paths(self.spark, ["/".join([root, *(f"{k}={v}" for k, v in part.items())]) for part in parts])
        specs = ", ".join(f"PARTITION ({self._spec(part)})" for part in parts)
        self.spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS {specs}")


def _archive_of(hour: str) -> str:
    """Name of the archive of an hour; no function here depends on the session zone."""
    return f"concat(cast(to_date({hour}) AS STRING), '-', lpad(hour({hour}), 2, '0'))"


def archive_key(hour: dt.datetime) -> str:
    return f"{hour:%Y-%m-%d-%H}"


class LakeTable(PartitionedTable):
    """Typed archive events, replaceable by archive or by slices of time.

    Rows that do not come from an archive count as of the archive of their own hour.
    """

    schema = LAKE
    partitions = {
        "event_date": ("DATE", "to_date(created_at)"),
        "event_hour": ("INT", "hour(created_at)"),
        "archive": ("STRING", _archive_of("created_at")),
    }

    def _partitioned(self, rows: DataFrame) -> DataFrame:
        """Rows in table order with their partition columns; ``archive_hour``, where rows have it, says which archive."""
        if "archive_hour" not in rows.columns:
            return super()._partitioned(rows)
        wider = StructType([*self.schema, StructField("archive_hour", TimestampNTZType())])
        expressions = {name: F.expr(expression) for name, (_, expression) in self.partitions.items()}
        expressions["archive"] = F.expr(_archive_of("archive_hour"))
        distant = F.expr("to_date(created_at) <> to_date(archive_hour) OR hour(created_at) <> hour(archive_hour)")
        expressions["event_hour"] = F.when(distant, F.lit(DISTANT)).otherwise(expressions["event_hour"])
        return rows.to(wider).withColumns(expressions).drop("archive_hour")

    def _placed(self, rows: DataFrame, by_hour: bool = False) -> DataFrame:
        # rebalance lets adaptive execution split a busy hour over several
        # tasks and join quiet ones, whatever the shuffle partition count is
        return rows if by_hour else rows.hint("rebalance", *self.partitions)

    def _sorted(self, rows: DataFrame) -> DataFrame:
        return rows.sortWithinPartitions(*self.partitions, "type", "created_at")

    def append(self, rows: DataFrame) -> None:
        self._sorted(self._placed(self._partitioned(rows))).write.insertInto(self.name)

    def _check_overwrite_mode(self) -> None:
        """A table made elsewhere may lack the option; overwriting would then empty all of it."""
        if "partitionOverwriteMode=dynamic" not in self._described().get("Storage Properties", ""):
            raise ValueError(f"{self.name} lacks the option partitionOverwriteMode=dynamic")

    def slice_count(self, start: Moment, end: Moment) -> int:
        return time_slice(self.read(), start, end).count()

    def _parts(self, start: Moment, end: Moment) -> list[dict[str, str]]:
        """The partitions of [start, end)."""
        start, end = moment(start), moment(end)
        last = end - dt.timedelta(hours=1)
        one_day = {"event_date": start.date().isoformat()} if start.date() == last.date() else {}
        parts = [p for p in self.partition_values(**one_day) if p["event_date"] != NULL_PARTITION]
        return [p for p in parts if start < _span_of(p)[1] and _span_of(p)[0] < end]

    def _archive_parts(self, archives: Collection[dt.datetime]) -> list[dict[str, str]]:
        """The partitions that rows of these archives are in."""
        keys = {archive_key(hour) for hour in archives}
        if len(keys) <= 24:
            return [part for key in sorted(keys) for part in self.partition_values(archive=key)]
        return [part for part in self.partition_values() if part["archive"] in keys]

    def loaded_hours(self, start: Moment, end: Moment) -> set[dt.datetime]:
        """Hours of [start, end) that hold rows, from partitions but for distant rows."""
        return _hours_of(self._parts(start, end), time_slice(self.read(), start, end))

    def _replace(
        self,
        rows: DataFrame,
        keep: Column,
        stale: list[dict[str, str]],
        old: DataFrame,
        by_hour: bool,
        left: DataFrame | None = None,
    ) -> SliceReport:
        """Overwrite the partitions that the kept rows fall into, then drop the stale ones that got none.

        ``old`` are the rows to replace, all in the stale partitions. ``left`` are other rows of these
        partitions, which are written again; ``keep`` fails for them.
        """
        self._check_overwrite_mode()
        keep = F.coalesce(keep, F.lit(False))
        before = _hours_of(stale, old)
        read, wrote = Observation(), Observation()
        placed = self._partitioned(rows.observe(read, F.count_if(~keep).alias("outside")).filter(keep))
        new = F.lit(True)
        if left is not None:
            placed, new = placed.unionByName(left), keep
        # a part is a folder that the catalog then holds, so the driver sees no more of them than there are partitions
        part = F.struct(*self.partitions)
        far = F.when(new & (F.col("event_hour") == DISTANT), start_of_hour(F.col("created_at")))
        placed = self._placed(placed, by_hour).observe(
            wrote, F.count_if(new).alias("rows"), F.collect_set(part).alias("parts"), F.collect_set(far).alias("far")
        )
        self._sorted(placed).write.mode("overwrite").insertInto(self.name)
        written = _observed(wrote, rows, rows=0, parts=[], far=[])
        parts = [{k: NULL_PARTITION if v is None else str(v) for k, v in row.asDict().items()} for row in written["parts"]]
        self.drop_partitions([part for part in stale if part not in parts])
        filled = {_span_of(part)[0] for part in parts if not _is_distant(part)}.union(written["far"])
        return SliceReport(written["rows"], _observed(read, rows, outside=0)["outside"], sorted(filled), sorted(before - filled))

    def replace_slice(self, rows: DataFrame, start: Moment, end: Moment) -> SliceReport:
        """Make ``rows`` the whole content of [start, end), in one pass over them.

        Both bounds are full hours. Rows outside the slice are counted and left
        out. Old rows stay in place until the new ones are complete; running the
        call again, also after a failure half-way, gives the same table. Partitions of distant rows that are
        partly in the slice are written again with what lies outside of it; such slices of one driver wait
        for each other, and no load or other driver may change rows of these dates meanwhile.
        """
        start, end = moment(start), moment(end)
        if any(bound != bound.replace(minute=0, second=0, microsecond=0) for bound in (start, end)):
            raise ValueError("a slice starts and ends on a full hour")
        if not self._torn_dates(self._parts(start, end), start, end):
            return self._replace_slice(rows, start, end)
        with _REWRITING:
            return self._replace_slice(rows, start, end)

    def _torn_dates(self, parts: list[dict[str, str]], start: dt.datetime, end: dt.datetime) -> list[str]:
        """Dates with distant rows of which the slice is only a part."""
        spans = {part["event_date"]: _span_of(part) for part in parts if _is_distant(part)}
        return [date for date, (first, stop) in spans.items() if first < start or end < stop]

    def _replace_slice(self, rows: DataFrame, start: dt.datetime, end: dt.datetime) -> SliceReport:
        inside, parts = within(F.col("created_at"), start, end), self._parts(start, end)
        left = None
        if torn := self._torn_dates(parts, start, end):
            dates = F.col("event_date").isin([dt.date.fromisoformat(date) for date in torn])
            left = self.read().filter(dates & (F.col("event_hour") == DISTANT)).filter(~inside)
        return self._replace(rows, inside, parts, time_slice(self.read(), start, end), by_hour=False, left=left)

    def replace_archives(self, rows: DataFrame, archives: Collection[dt.datetime], keep: Column) -> SliceReport:
        """Make ``rows`` all that the table holds of some archives, wherever in time the rows lie.

        Rows have ``archive_hour`` and come from few archives in each task, as when reading the files; they
        are written without a shuffle. Those for which ``keep`` fails are counted and left out. Like
        :meth:`replace_slice` it may be repeated.
        """
        return self._replace(rows, keep, self._archive_parts(archives), self._of_archives(archives), by_hour=True)

    def replace_from_table(self, rows: DataFrame, start: Moment, end: Moment) -> SliceReport:
        """:meth:`replace_slice` from a stored table: the slice reaches its scan, so only that is read."""
        return self.replace_slice(time_slice(rows, start, end), start, end)

    def ledger(self) -> LoadLedger:
        """The record of the archives loaded into this table, kept beside it."""
        return LoadLedger(self.spark, f"{self._described()['Location'].rstrip('/')}_ledger")

    def _of_archives(self, archives: Collection[dt.datetime]) -> DataFrame:
        return self.read().filter(F.col("archive").isin([archive_key(hour) for hour in archives]))

    def archive_counts(self, archives: Collection[dt.datetime]) -> DataFrame:
        """``hour, rows`` that the table holds of each archive, from row counts of files; no column is read."""
        name = F.col("archive")
        date, hour = F.substring(name, 1, 10), F.substring(name, 12, 2)
        rows = self._of_archives(archives)
        own = date.cast("date").cast("timestamp_ntz") + F.make_dt_interval(hours=hour.cast("int"))
        return rows.groupBy(own.alias("hour")).agg(F.count("*").alias("rows"))

    def hour_counts(self, start: Moment, end: Moment) -> DataFrame:
        """``hour, rows`` of the slice, from partition columns and row counts of files; of distant rows the time is read."""
        rows = self.read().filter(reduce(and_, partition_bounds(self.read(), start, end)))
        inside = (F.col("event_hour") != DISTANT) | within(F.col("created_at"), start, end)
        return row_hours(rows.filter(inside)).groupBy("hour").agg(F.count("*").alias("rows"))


def _observed(observation: Observation, frame: DataFrame, /, **nothing) -> dict:
    """The metrics; those of ``nothing`` for rows that the optimizer knows to be none, which it does not observe."""
    try:
        return observation.get
    except Py4JJavaError:
        if frame.isEmpty():
            return nothing
        raise


def _is_distant(part: dict[str, str]) -> bool:
    return part["event_hour"] == str(DISTANT)


def _span_of(part: dict[str, str]) -> tuple[dt.datetime, dt.datetime]:
    """The hour that a partition is of, or the day if it is of distant rows."""
    first = dt.datetime.fromisoformat(part["event_date"])
    if _is_distant(part):
        return first, first + dt.timedelta(days=1)
    first += dt.timedelta(hours=int(part["event_hour"]))
    return first, first + dt.timedelta(hours=1)


def _hours_of(parts: list[dict[str, str]], rows: DataFrame) -> set[dt.datetime]:
    """The hours of some partitions; those of distant rows from ``rows``, which hold all rows of the partitions that count."""
    hours = {_span_of(part)[0] for part in parts if not _is_distant(part)}
    if all(not _is_distant(part) for part in parts):
        return hours
    found = row_hours(rows.filter(F.col("event_hour") == DISTANT)).distinct().collect()
    return hours.union(row["hour"] for row in found)


class ServingTable(PartitionedTable):
    """Slim event rows, clustered by time; each belongs to the run that copied it."""

    schema = SERVING
    partitions = {"event_date": ("DATE", "to_date(created_at)"), "run": ("STRING", "'append'")}

    def read(self) -> DataFrame:
        return super().read().drop("run")

    def run_rows(self, run: str) -> DataFrame:
        """What a run has copied; opens only its folders."""
        return super().read().filter(F.col("run") == run).drop("run")

    def _placed(self, rows: DataFrame, run: str) -> DataFrame:
        """Sorted files; a busy day is cut over several tasks, whatever the shuffle partition count is."""
        placed = self._partitioned(rows).withColumn("run", F.lit(run)).hint("rebalance", "event_date")
        return placed.sortWithinPartitions("event_date", "created_at")

    def append(self, rows: DataFrame) -> None:
        """Add rows that no run will want to replace."""
        self._placed(rows, "append").write.insertInto(self.name)

    def replace_run(self, rows: DataFrame, run: str) -> None:
        """Make ``rows`` all that the table holds of a run; may be repeated, also after a failure half-way."""
        before = self.partition_values(run=run)
        wrote = Observation()
        dates = F.collect_set(F.to_date("created_at").cast("string")).alias("dates")
        self._placed(rows.observe(wrote, dates), run).write.mode("overwrite").insertInto(self.name)
        dates = _observed(wrote, rows, dates=[])["dates"]
        self.drop_partitions([part for part in before if part["event_date"] not in dates])

    def drop_expired(self, as_of: Moment) -> list[str]:
        """Drop whole days past the one-month retention; rollups built from them stay."""
        floor = retention_floor(as_of).isoformat()
        expired = [p for p in self.partition_values() if p["event_date"] != NULL_PARTITION and p["event_date"] < floor]
        self.drop_partitions(expired)
        return sorted({part["event_date"] for part in expired})


def cluster_by_time(rows: DataFrame, *leading: str) -> DataFrame:
    """Range-partition by created_at and sort within.

    A hash of the whole row breaks ties, so that one instant shared by very many
    rows is spread over several output tasks.
    """
    salted = rows.withColumn("_part", F.xxhash64(*rows.columns))
    ranged = salted.repartitionByRange("created_at", "_part").drop("_part")
    return ranged.sortWithinPartitions(*leading, "created_at")
