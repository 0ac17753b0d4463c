"""Helpers on frames: written steps, bounded samples, connected components."""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import scratch_dir


#: Bytes of an Arrow batch, and the setting that bounds them with Spark's own bound. Long texts make batches of tens of MB by the
#: number of rows alone, and each is held several times over: in the JVM, off its heap, and in the Python worker.
BATCH_BYTES = 4 << 20
_BATCH_SETTING, _BATCH_DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once for each application."""
    context = spark.sparkContext
    if getattr(context, "_tidemark_shipped", False):
        return
    package = Path(__file__).resolve().parent.parent
    target = Path(tempfile.mkdtemp(prefix="tidemark-")) / "tidemark.zip"  # the driver serves it to executors
    with zipfile.ZipFile(target, "w") as archive:
        for source in sorted(package.rglob("*.py")):
            archive.write(source, source.relative_to(package.parent))
    context.addPyFile(str(target))
    context._tidemark_shipped = True


def give_back() -> None:
    """Return to the system what this process has freed and its allocators still hold, where they can."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not every C library has it
        ctypes.CDLL(None).malloc_trim(0)


def _giving_back(task: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The task, and then ``give_back``: Python workers live on for later stages, each with the most that any task took."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from task(batches)
        finally:
            give_back()

    return run


def map_arrow(frame: DataFrame, task: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``mapInArrow`` with this package at hand in the tasks, over batches of at most ``BATCH_BYTES`` unless the session has a bound of its own."""
    ship(frame.sparkSession)
    if frame.sparkSession.conf.get(_BATCH_SETTING) == _BATCH_DEFAULT:
        frame.sparkSession.conf.set(_BATCH_SETTING, str(BATCH_BYTES))
    return frame.mapInArrow(_giving_back(task), schema)


def written(frame: DataFrame, name: str) -> DataFrame:
    """The frame as a table in the shared scratch folder: later plans start there, and so does recovery."""
    spark = frame.sparkSession
    path = scratch_dir(spark, f"{name}-{uuid.uuid4().hex[:12]}")
    frame.write.mode("overwrite").parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def held_out(column: str, folds: int, fold: int) -> F.Column:
    """Whether ``crc32`` of the id as text falls in the fold; a null id does not."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % folds == fold, F.lit(False))


def smallest_per_group(frame: DataFrame, group: str, order: str, k: int) -> DataFrame:
    """The ``k`` rows of each group with the smallest ``order``; each task keeps no more than that before the shuffle."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[object, pa.Table] = {}
        for batch in batches:
            table = pa.Table.from_batches([batch])
            for value in pc.unique(table[group]).to_pylist():
                own = table.filter(pc.equal(table[group], value))
                if value in kept:
                    own = pa.concat_tables([kept[value], own])
                kept[value] = own.take(pc.select_k_unstable(own, min(k, own.num_rows), [(order, "ascending")]))
        for own in kept.values():
            yield from own.combine_chunks().to_batches()

    few = map_arrow(frame.filter(F.col(group).isNotNull()), partial, frame.schema)
    place = F.row_number().over(Window.partitionBy(group).orderBy(order))
    return few.withColumn("_place", place).filter(F.col("_place") <= k).drop("_place")


def sample_by_class(frame: DataFrame, label: str, k: int, key: str = "doc_id", text: str = "text") -> list:
    """At most ``k`` rows (key, label, text) of each class, chosen by a hash of the key, so the same at every run.

    Only keys and labels are compared; the texts of the chosen rows are read
    afterwards. The result is bounded by ``k`` times the number of classes.
    """
    keys = frame.select(F.col(key), F.col(label), F.xxhash64(F.col(key)).alias("_order")).filter(
        F.col(key).isNotNull() & F.col(label).isNotNull()
    )
    chosen = [row[key] for row in smallest_per_group(keys, label, "_order", k).select(key).distinct().collect()]
    if not chosen:
        return []
    ids = F.broadcast(frame.sparkSession.createDataFrame([(i,) for i in chosen], f"{key} bigint"))
    rows = frame.select(key, label, text).filter(F.col(label).isNotNull()).join(ids, key, "left_semi").collect()
    unique = {row[key]: row for row in sorted(rows, key=lambda r: (r[key], str(r[label]), r[text] or ""))}
    return [unique[i] for i in sorted(unique)]


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """``node, component`` for every node of the undirected edges ``a, b``: the smallest node reachable.

    Alternates large-star and small-star steps: each step is one grouping with
    partial aggregation, hub nodes only ever point to one smaller node, and the
    number of steps grows with the logarithm of the longest path. Each step is
    written, so lineage stays short. Raises if ``rounds`` do not suffice.
    """
    pairs = edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    pairs = written(pairs, "links")
    before = None
    for _ in range(rounds):
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = both.join(lowest, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        pairs = written(small, "links")
        state = pairs.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")
        ).first()
        if before == tuple(state):
            roots = pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
        before = tuple(state)
    raise RuntimeError(f"components: no fixed point after {rounds} rounds")
