"""Rollup files, partitioned by month and sorted by key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions.time import yyyymm


def write_rollup(rollup: DataFrame, path: str, sort_keys: tuple[str, ...]) -> None:
    """Replace ``path`` with the rollup, one folder per month of its first time column.

    A rebalancing shuffle by month keeps months in few files and
    is cut by size, so that the very many members of one busy key are written by several
    tasks; rows are sorted by key inside each file. The input is read once.

    Repositories get Bloom filters, as their names are in every row group of a month in all its types and days: a
    read of few repositories skips the row groups that have none of them. Parquet writes a filter only where the names of a row group are too many
    for a dictionary, which serves as one, and sizes it by their number.
    """
    time_key = "date" if "date" in rollup.columns else "minute"
    rows = rollup.withColumn("month", yyyymm(F.col(time_key)))
    keys = ["month", *sort_keys]
    placed = rows.hint("rebalance", "month").sortWithinPartitions(*keys)
    placed.write.options(**bloom_options(placed)).mode("overwrite").partitionBy("month").parquet(path)


def bloom_options(rows: DataFrame) -> dict[str, str]:
    """Writer options for a Bloom filter on the names of repositories, where rows have them."""
    if "repo_name" not in rows.columns:
        return {}
    return {"parquet.bloom.filter.enabled#repo_name": "true", "parquet.bloom.filter.adaptive.enabled": "true"}


def read_rollup(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Rollup rows with the partition columns that the path holds."""
    return spark.read.schema(schema).parquet(path)
