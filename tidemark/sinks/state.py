"""Rollup state: batches of partial rows, generations of merged ones, and the job that compacts them.

A batch is ``source=S/run=R/batch_id=N``. The run tells apart streams that count their batches alike: a new
checkpoint is a new run. Within a run batches are numbered upwards. Every writing of a batch is
a ``version=V`` folder of its own, complete when it has its success file; the newest complete version counts, so
a replay replaces without touching files that someone reads.

A generation is one manifest file, published by a rename. It names the merged folders of each month, the newest
batch that is merged of each stream, and the folders that are no longer needed and since when. Readers resolve the newest manifest and
the batches it does not cover once, and read exactly those folders; if a generation appears meanwhile
they resolve again. Folders no longer needed stay for a grace period, so that
frames made before a compaction can still be computed.

Compaction merges by month, in size tiers: the new rows of a month take up those of its folders that are at most
``TIER`` times as large as what they have taken up so far. Months without new rows keep their files, and a row is rewritten
a logarithmic number of times.

Partial rows are additive, members as well (events per actor), so a writing that is to be taken back is added
once more with negative counts. Runs whose name begins with ``ONCE`` are written in that way, see
:mod:`tidemark.plans.copies`: no later batch of theirs repeats an earlier one, and manifests need no row for them. While such a run is
open its batches are not merged.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Iterable
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.operators.rollups import merge_partials
from tidemark.session import list_paths, path_exists, publish_text, qualified, read_text, remove_paths
from tidemark.sinks.rollups import read_rollup, write_rollup

#: Seconds for which folders stay after a generation stopped using them.
GRACE = 3600.0
#: How many times as large a merged folder may be as the rows that it is merged with.
TIER = 4
#: Begin of the names of runs that are written under a transaction.
ONCE = "once-"

_VERSION = re.compile(r".*/source=([^/]*)/run=([^/]*)/batch_id=(-?\d+)/version=(\d+)")
_NULL_MONTH = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class Batch:
    """One complete version of a batch."""

    source: str
    run: str
    batch_id: int
    version: int
    folder: str


@dataclass(frozen=True)
class Manifest:
    """What a generation consists of."""

    generation: int = 0
    months: dict[str, list[tuple[str, int]]] = field(default_factory=dict)  # month -> (folder, rows)
    upto: list[tuple[str, str, int]] = field(default_factory=list)  # source, run, newest merged batch
    retired: list[tuple[str, float]] = field(default_factory=list)  # folder, since when no generation needs it

    def live(self, batches: list[Batch]) -> list[Batch]:
        """The batches that this generation does not cover."""
        gone = {folder for folder, _ in self.retired}
        newest = {(source, run): upto for source, run, upto in self.upto}
        return [b for b in batches if b.folder not in gone and b.batch_id > newest.get((b.source, b.run), b.batch_id - 1)]


@dataclass(frozen=True)
class Snapshot:
    """A manifest, the batches that it does not cover, and folders that count for nothing."""

    manifest: Manifest
    live: list[Batch]
    unused: list[str]


@dataclass(frozen=True)
class RollupState:
    """Partial rows under ``path``; ``keys`` lead the order of merged files."""

    spark: SparkSession
    path: str
    schema: StructType
    keys: tuple[str, ...]

    def _manifests(self) -> list[tuple[int, str, float]]:
        found = list_paths(self.spark, f"{self.path}_manifests/*.json")
        return sorted((int(path.rsplit("/", 1)[1].removesuffix(".json")), path, changed) for path, changed in found)

    def manifest(self) -> Manifest:
        """The newest published generation; number 0 before the first."""
        published = self._manifests()
        if not published:
            return Manifest()
        stored = json.loads(read_text(self.spark, published[-1][1]))
        return Manifest(
            stored["generation"],
            {month: [tuple(f) for f in folders] for month, folders in stored["months"].items()},
            [tuple(row) for row in stored["upto"]],
            [tuple(row) for row in stored["retired"]],
        )

    def generation(self) -> int:
        return self.manifest().generation

    def _versions(self) -> tuple[list[Batch], list[str]]:
        """The newest complete version of every batch, and the folders of older ones."""
        pattern = f"{self.path}/source=*/run=*/batch_id=*/version=*"
        complete = {path.rsplit("/", 1)[0] for path, _ in list_paths(self.spark, f"{pattern}/_SUCCESS")}
        versions = []
        for path, _ in list_paths(self.spark, pattern):
            source, run, batch_id, version = _VERSION.match(path).groups()
            versions.append(Batch(source, run, int(batch_id), int(version), path))
        newest: dict[tuple[str, str, int], Batch] = {}
        for batch in sorted(versions, key=lambda b: b.version):
            if batch.folder in complete:
                newest[batch.source, batch.run, batch.batch_id] = batch
        older = [
            b.folder for b in versions
            if (best := newest.get((b.source, b.run, b.batch_id))) and b.version < best.version
        ]
        return list(newest.values()), older

    def snapshot(self) -> Snapshot:
        """What a reader reads: resolved again if a generation is published while batches are listed."""
        before = self.manifest()
        while True:
            batches, older = self._versions()
            now = self.manifest()
            if now.generation == before.generation:
                live = now.live(batches)
                replayed = {b.folder for b in batches} - {b.folder for b in live}
                return Snapshot(now, live, [*older, *replayed])
            before = now

    def _rows(self, base: str, folders: Iterable[str]) -> DataFrame:
        """Rows of exactly these folders, with the partition columns in their names."""
        folders = list(folders)
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        read = self.spark.read.schema(self.schema).option("basePath", qualified(self.spark, base))
        return read.parquet(*folders).select(*self.schema.fieldNames())

    def _live_rows(self, batches: Iterable[Batch]) -> DataFrame:
        return self._rows(self.path, (b.folder for b in batches))

    def _merged_rows(self, folders: Iterable[str]) -> DataFrame:
        return self._rows(f"{self.path}_merged", folders)

    def batches(self) -> DataFrame:
        """The rows of the batches that no generation covers."""
        return self._live_rows(self.snapshot().live)

    def read(self) -> DataFrame:
        """Partial rows to merge: those of the newest generation and of the batches after it.

        The folders are fixed when the frame is made.
        """
        now = self.snapshot()
        return self.merged(now, now.manifest.months).unionByName(self.unmerged(now))

    def merged(self, snapshot: Snapshot, months: Iterable[str]) -> DataFrame:
        """The merged rows of some months; opens only their folders."""
        return self._merged_rows(folder for month in months for folder, _ in snapshot.manifest.months.get(month, []))

    def unmerged(self, snapshot: Snapshot) -> DataFrame:
        """The rows of the batches after a generation."""
        return self._live_rows(snapshot.live)

    def _month_rows(self, rows: DataFrame) -> dict[str, int]:
        """Rows per month, from the file footers."""
        counted = rows.groupBy("month").agg(F.count("*").alias("n")).collect()
        return {_NULL_MONTH if r["month"] is None else str(r["month"]): r["n"] for r in counted}

    def compact(self, grace: float = GRACE) -> int:
        """Merge the live batches, publish a generation, remove what has been unused for ``grace`` seconds.

        Returns the number of the generation; safe to repeat after any failure. Of two that run at once, one fails.
        """
        now = self.snapshot()
        due = set(self._due(now.manifest, grace))
        remove_paths(self.spark, due)
        live = [b for b in now.live if not path_exists(self.spark, open_folder(self.path, b.source, b.run))]
        fresh = self._live_rows(live)
        months, taken = dict(now.manifest.months), []
        for month, size in self._month_rows(fresh).items():
            kept = []
            for folder, rows in sorted(months.get(month, []), key=lambda f: f[1]):
                if not kept and rows <= TIER * size:
                    taken.append(folder)
                    size += rows
                else:
                    kept.append((folder, rows))
            months[month] = kept
        number = now.manifest.generation + 1
        folder = qualified(self.spark, f"{self.path}_merged/generation={number}-{uuid.uuid4().hex[:8]}")
        keys = tuple(name for name in self.schema.fieldNames() if name not in ("cnt", "run", "batch_id", "month"))
        if live:
            settled = self._merged_rows(taken).unionByName(fresh)
            write_rollup(merge_partials(settled, keys), folder, self.keys)
            for month, rows in self._month_rows(read_rollup(self.spark, folder, self.schema)).items():
                months.setdefault(month, []).append((f"{folder}/month={month}", rows))
        newest = {(source, run): upto for source, run, upto in now.manifest.upto}
        for batch in live:
            if not batch.run.startswith(ONCE):
                newest[batch.source, batch.run] = max(batch.batch_id, newest.get((batch.source, batch.run), batch.batch_id))
        since = time.time()
        retired = {path: at for path, at in now.manifest.retired if path not in due}
        for path in (*(b.folder for b in live), *now.unused, *taken):
            if path not in due:
                retired.setdefault(path, since)
        upto = sorted((source, run, batch_id) for (source, run), batch_id in newest.items())
        manifest = Manifest(number, {m: f for m, f in months.items() if f}, upto, list(retired.items()))
        if not publish_text(self.spark, f"{self.path}_manifests/{number:010d}.json", json.dumps(asdict(manifest))):
            remove_paths(self.spark, [folder])
            raise RuntimeError(f"{self.path}: generation {number} was published by another compaction")
        self.remove_merged(grace)
        return number

    @staticmethod
    def _due(manifest: Manifest, grace: float) -> list[str]:
        limit = time.time() - grace
        return [path for path, since in manifest.retired if since <= limit]

    def remove_merged(self, grace: float = GRACE) -> None:
        """Remove folders and manifests that have been unused for ``grace`` seconds, and generations never published."""
        published = self._manifests()
        manifest, limit = self.manifest(), time.time() - grace
        used = {folder.rsplit("/", 1)[0] for folders in manifest.months.values() for folder, _ in folders}
        waiting = {path.rsplit("/", 1)[0] for path, since in manifest.retired if since > limit}
        lost = [
            path
            for path, changed in list_paths(self.spark, f"{self.path}_merged/generation=*")
            if path not in used | waiting and changed <= limit and _number(path) <= manifest.generation
        ]
        old = [path for number, path, changed in published if number < manifest.generation and changed <= limit]
        remove_paths(self.spark, [*self._due(manifest, grace), *lost, *old])


def _number(folder: str) -> int:
    return int(folder.rsplit("generation=", 1)[1].split("-")[0])


def batch_folder(path: str, source: str, run: str, batch_id: int) -> str:
    return f"{path}/source={source}/run={run}/batch_id={batch_id}"


def next_version(spark: SparkSession, path: str, source: str, run: str, batch_id: int) -> str:
    """The folder for one more writing of a batch."""
    folder = batch_folder(path, source, run, batch_id)
    taken = [int(found.rsplit("=", 1)[1]) for found, _ in list_paths(spark, f"{folder}/version=*")]
    return f"{folder}/version={max(taken, default=-1) + 1}"


def open_folder(path: str, source: str, run: str) -> str:
    """Where an open transaction of a run keeps what it takes back."""
    return f"{path}_open/source={source}/run={run}"
