"""Item rows: generator and newline-JSON scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.time import Moment, ntz, parse_utc

# Multiplier and range of the draw, seconds in 30 days.
_MULTIPLIER = 2654435761
_DRAWS = 1 << 32
_MONTH_SECONDS = 2592000


def _draw(row_id: Column, seed: int) -> Column:
    """One 32-bit draw per row, repeatable from the row id; no two of 2**32 rows share one.

    The product is taken in two halves of the id, so that it stays within BIGINT.
    """
    low, high = F.pmod(row_id, F.lit(1 << 16)), F.pmod(F.shiftright(row_id, 16), F.lit(1 << 16))
    upper = F.pmod(high * F.lit(_MULTIPLIER), F.lit(1 << 16)) * F.lit(1 << 16)
    return F.pmod(upper + low * F.lit(_MULTIPLIER) + F.lit(seed), F.lit(_DRAWS))


def _stamp(draw: Column, now: Moment) -> Column:
    return ntz(now) - F.make_dt_interval(secs=F.pmod(draw, F.lit(_MONTH_SECONDS)))


def generate_items(rows: DataFrame, now: Moment, seed: int = 0) -> DataFrame:
    """One item for each ``id`` of ``rows`` (for example ``spark.range(n)``)."""
    drawn = rows.select(_draw(F.col("id"), seed).alias("r"))
    return drawn.select(
        F.concat(F.lit("id_"), (1000 + F.col("r") % 9000).cast("string")).alias("id"),
        F.concat(F.lit("Item "), (F.col("r") % 100).cast("string")).alias("name"),
        F.round(F.col("r") % 1000 + F.col("r"), 2).alias("value"),
        _stamp(F.col("r"), now).alias("timestamp"),
    )


def generate_items_copy(rows: DataFrame, now: Moment, seed: int = 0) -> DataFrame:
    """The second item set: four-digit ids, three-digit names, scaled values."""
    drawn = rows.select(_draw(F.col("id"), seed).alias("r"))
    return drawn.select(
        F.concat(F.lit("id_"), (F.col("r") % 10000).cast("string")).alias("id"),
        F.concat(F.lit("name_"), (F.col("r") % 1000).cast("string")).alias("name"),
        F.round(F.col("r") * 100, 2).alias("value"),
        _stamp(F.col("r"), now).alias("timestamp"),
    )


def read_items(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Scan newline-JSON item rows."""
    rows = spark.read.schema("id STRING, name STRING, value BIGINT, timestamp STRING").json(path)
    return rows.withColumn("timestamp", parse_utc(F.col("timestamp")))
