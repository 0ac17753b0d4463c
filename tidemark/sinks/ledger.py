"""The record of loaded archives."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.time import ntz
from tidemark.session import path_exists

_ENTRY = "hour TIMESTAMP_NTZ, rows BIGINT, rejects BIGINT, loaded_at TIMESTAMP_NTZ"


@dataclass(frozen=True)
class LoadLedger:
    """One row for each load of an archive under ``path``; entries are only ever added."""

    spark: SparkSession
    path: str

    def history(self) -> DataFrame:
        """hour, rows, rejects, loaded_at of every load."""
        if not path_exists(self.spark, self.path):
            return self.spark.createDataFrame([], _ENTRY)
        return self.spark.read.schema(_ENTRY).parquet(self.path)

    def read(self) -> DataFrame:
        """The latest load of each archive."""
        latest = F.max_by(F.struct("rows", "rejects"), "loaded_at").alias("e")
        grouped = self.history().groupBy("hour").agg(latest, F.max("loaded_at").alias("loaded_at"))
        return grouped.select("hour", "e.rows", "e.rejects", "loaded_at")

    def record(self, archives: Sequence[dt.datetime], rows: DataFrame, rejects: DataFrame | None) -> None:
        """Add an entry for each archive: ``hour, rows`` of what was loaded, and the reject rows if there are any."""
        now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        entries = self.spark.createDataFrame([(hour,) for hour in archives], "hour TIMESTAMP_NTZ").join(rows, "hour", "left")
        left_out = F.lit(0).cast("bigint").alias("rejects")
        if rejects is not None:
            counted = rejects.groupBy(F.col("archive_hour").alias("hour")).agg(F.count("*").alias("n"))
            entries = entries.join(counted, "hour", "left")
            left_out = F.coalesce("n", F.lit(0)).alias("rejects")
        entries = entries.select("hour", F.coalesce("rows", F.lit(0)).alias("rows"), left_out, ntz(now).alias("loaded_at"))
        entries.coalesce(1).write.mode("append").parquet(self.path)
