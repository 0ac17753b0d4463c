"""Month and year partials above a daily rollup, for reads of long ranges.

A range is cut into whole years, whole months and the days left at its edges, and each part is read from the
coarsest partials that hold it. Partials of a month are good as long as the state's generation
has for that month the folders that they were made from, and no later batch has rows of it; a year's as long as its months'
are. Anything else is read from the days, so answers are those of the days at any time, and a refresh only makes them cheaper.
"""

from __future__ import annotations

import calendar
import datetime as dt
import json
import re
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.time import day
from tidemark.session import list_paths, publish_text, qualified, read_text
from tidemark.sinks.rollups import bloom_options
from tidemark.sinks.state import RollupState, Snapshot

_ROWS = "event_type STRING, repo_name STRING, source STRING, cnt BIGINT"
_KEYS = ("event_type", "repo_name", "source")


@dataclass(frozen=True)
class Record:
    """What a refresh left: for each month and year its folder and what it was made from."""

    number: int = 0
    months: dict[str, tuple[str, list[str]]] = field(default_factory=dict)  # month -> (folder, day folders)
    years: dict[str, tuple[str, list[str]]] = field(default_factory=dict)  # year -> (folder, month folders)


@dataclass(frozen=True)
class Cover:
    """The parts that a range is read from."""

    years: list[str]
    months: list[str]
    days: list[tuple[dt.date, dt.date]]


def _month(date: dt.date) -> str:
    return f"{date.year * 100 + date.month}"


def _months_of(year: str) -> list[str]:
    return [f"{year}{m:02d}" for m in range(1, 13)]


def cover(start: dt.date, end: dt.date, months: Iterable[str], years: Iterable[str]) -> Cover:
    """Cut [start, end] into the years and months given, as far as they lie inside, and days."""
    out, one, months, years = Cover([], [], []), dt.timedelta(days=1), set(months), set(years)
    while start <= end:
        last_of_year = dt.date(start.year, 12, 31)
        last_of_month = start.replace(day=calendar.monthrange(start.year, start.month)[1])
        if start.month == start.day == 1 and last_of_year <= end and str(start.year) in years:
            out.years.append(str(start.year))
            start = last_of_year + one
        elif start.day == 1 and last_of_month <= end and _month(start) in months:
            out.months.append(_month(start))
            start = last_of_month + one
        else:
            last = min(last_of_month, end)
            if out.days and out.days[-1][1] + one == start:
                out.days[-1] = (out.days[-1][0], last)
            else:
                out.days.append((start, last))
            start = last + one
    return out


@dataclass(frozen=True)
class CoarseRollup:
    """Month and year partials of the counts in ``state``, beside it."""

    spark: SparkSession
    state: RollupState

    @property
    def path(self) -> str:
        return f"{self.state.path}_coarse"

    def record(self) -> Record:
        found = sorted(path for path, _ in list_paths(self.spark, f"{self.path}/records/*.json"))
        if not found:
            return Record()
        stored = json.loads(read_text(self.spark, found[-1]))
        return Record(stored["number"], *({k: tuple(v) for k, v in stored[part].items()} for part in ("months", "years")))

    def _write(self, rows: DataFrame, unit: str) -> dict[str, str]:
        """Write partials by ``unit``; the folder of each of its values."""
        folder = qualified(self.spark, f"{self.path}/{unit}/refresh={uuid.uuid4().hex[:12]}")
        placed = rows.hint("rebalance", unit).sortWithinPartitions(unit, "event_type", "repo_name")
        placed.write.options(**bloom_options(rows)).partitionBy(unit).parquet(folder)
        return {path.rsplit("=", 1)[1]: path for path, _ in list_paths(self.spark, f"{folder}/{unit}=*")}

    def _read(self, folders: Iterable[str]) -> DataFrame:
        folders = sorted(folders)
        read = self.spark.read.schema(_ROWS)
        return read.parquet(*folders) if folders else self.spark.createDataFrame([], _ROWS)

    def refresh(self) -> list[str]:
        """Make the partials of the months that changed since the last refresh, and of their years. Returns these months."""
        snapshot, before = self.state.snapshot(), self.record()
        merged = {month: [f for f, _ in folders] for month, folders in snapshot.manifest.months.items()}
        gone = [month for month in before.months if month not in merged]
        changed = sorted(m for m, folders in merged.items() if m.isdigit() and before.months.get(m, ("", []))[1] != folders)
        if not changed and not gone:
            return []
        rows = self.state.merged(snapshot, changed).groupBy("month", *_KEYS).agg(F.sum("cnt").alias("cnt")).filter("cnt <> 0")
        made = self._write(rows, "month") if changed else {}
        months = {m: entry for m, entry in before.months.items() if m not in gone}
        months |= {m: (made.get(m, ""), merged[m]) for m in changed}
        touched = sorted({m[:4] for m in (*changed, *gone)})
        of_year = {y: [months[m][0] for m in _months_of(y) if m in months and months[m][0]] for y in touched}
        parts = [self._read(folders).withColumn("year", F.lit(int(y))) for y, folders in of_year.items() if folders]
        found = {}
        if parts:
            yearly = reduce(DataFrame.unionByName, parts).groupBy("year", *_KEYS).agg(F.sum("cnt").alias("cnt")).filter("cnt <> 0")
            found = self._write(yearly, "year")
        years = {y: entry for y, entry in before.years.items() if y not in touched}
        years |= {y: (found.get(y, ""), folders) for y, folders in of_year.items()}
        record = {"number": before.number + 1, "months": months, "years": years}
        if not publish_text(self.spark, f"{self.path}/records/{before.number + 1:010d}.json", json.dumps(record)):
            raise RuntimeError(f"{self.path}: another refresh published record {before.number + 1}")
        return changed

    def _good(self, snapshot: Snapshot, record: Record, first: dt.date, last: dt.date) -> tuple[set[str], set[str]]:
        """Months and years between two dates whose partials hold what the state holds; empty ones too."""
        live = set()
        for batch in snapshot.live:
            live |= {re.search(r"month=([^/]*)$", path)[1] for path, _ in list_paths(self.spark, f"{batch.folder}/month=*")}
        merged = {month: [f for f, _ in folders] for month, folders in snapshot.manifest.months.items()}
        years = [str(y) for y in range(first.year, last.year + 1)]
        months = {
            m for y in years for m in _months_of(y)
            if m not in live and record.months.get(m, ("", []))[1] == merged.get(m, [])
        }
        whole = {
            y for y in years
            if all(m in months for m in _months_of(y))
            and record.years.get(y, ("", []))[1] == [record.months[m][0] for m in _months_of(y) if m in record.months and record.months[m][0]]
        }
        return months, whole

    def rows(self, start_date: dt.date | str, end_date: dt.date | str) -> DataFrame:
        """event_type, repo_name, source, cnt: partials that add up to the counts of the closed range."""
        start, end = day(start_date), day(end_date)
        snapshot, record = self.state.snapshot(), self.record()
        parts = cover(start, end, *self._good(snapshot, record, start, end))
        coarse = [record.years.get(y, ("", []))[0] for y in parts.years]
        coarse += [record.months.get(m, ("", []))[0] for m in parts.months]
        out = self._read(folder for folder in coarse if folder)
        if not parts.days:
            return out
        wanted = {_month(first + dt.timedelta(days=k)) for first, last in parts.days for k in range((last - first).days + 1)}
        days = self.state.merged(snapshot, wanted).unionByName(self.state.unmerged(snapshot).filter(F.col("month").isin([int(m) for m in wanted])))
        inside = reduce(lambda a, b: a | b, (F.col("date").between(first, last) for first, last in parts.days))
        return out.unionByName(days.filter(inside).select(*_KEYS, "cnt"))
