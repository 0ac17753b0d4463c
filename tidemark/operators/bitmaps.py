"""Exact distinct actors as bitmaps of dictionary numbers.

A set of members costs a row for each key and actor. Where keys are coarse, so that many actors meet in one, a
set of numbers is smaller: Spark's bitmap functions keep 32,768 numbers in a row of 4 KB, of which Parquet stores
little where few bits are set. Bitmaps of parts are united by OR, so the state merges like the others, and
counting is exact, not a sketch.

The dictionary gives every actor a number, for good. It grows by extensions; only one may be written at a time.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.rollups import present
from tidemark.session import list_paths, path_exists

_ENTRY = "actor_login STRING, number BIGINT"


@dataclass(frozen=True)
class ActorDictionary:
    """Numbers of actors under ``path``, one folder for each extension."""

    spark: SparkSession
    path: str

    def read(self) -> DataFrame:
        if not path_exists(self.spark, self.path):
            return self.spark.createDataFrame([], _ENTRY)
        done = [path.rsplit("/", 1)[0] for path, _ in list_paths(self.spark, f"{self.path}/extension=*/_SUCCESS")]
        return self.spark.read.schema(_ENTRY).parquet(*done) if done else self.spark.createDataFrame([], _ENTRY)

    def extend(self, events: DataFrame) -> None:
        """Give a number to every actor of the events that has none.

        Numbers count up within each task that writes, from a start of its own, so no task needs to know of another and
        the numbers of a task share bitmaps. An extension that failed leaves nothing behind that counts; repeating it is safe.
        """
        known = self.read()
        done = list_paths(self.spark, f"{self.path}/extension=*/_SUCCESS")
        start = known.agg(F.coalesce(F.max("number") + 1, F.lit(0))).first()[0]
        new = events.select("actor_login").filter("actor_login IS NOT NULL").distinct().join(known, "actor_login", "left_anti")
        number = F.lit(start) + F.monotonically_increasing_id()
        new.select("actor_login", number.alias("number")).write.mode("overwrite").parquet(f"{self.path}/extension={len(done)}")


def _bits(number: Column) -> tuple[Column, Column]:
    return F.bitmap_bucket_number(number).alias("bucket"), F.bitmap_bit_position(number)


def actor_bitmaps(events: DataFrame, dictionary: DataFrame, *by: str) -> DataFrame:
    """``by``, bucket, bits: the actors of the events for each value of ``by``.

    Events shrink to distinct actors of each key before they meet the dictionary, where every actor is one row.
    """
    actors = events.select(*by, "actor_login").filter("actor_login IS NOT NULL").distinct()
    bucket, place = _bits(F.col("number"))
    return actors.join(dictionary, "actor_login").groupBy(*by, bucket).agg(F.bitmap_construct_agg(place).alias("bits"))


def member_bitmaps(members: DataFrame, dictionary: DataFrame, *by: str) -> DataFrame:
    """The same from stored members."""
    return actor_bitmaps(present(members), dictionary, *by)


def merge_bitmaps(state: DataFrame, *by: str) -> DataFrame:
    """Unite bitmaps up to any coarser grain; tasks unite what they read first."""
    return state.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def count_actors(state: DataFrame, *by: str) -> DataFrame:
    """Exact distinct actors; buckets hold different actors, so their counts add up."""
    united = merge_bitmaps(state, *by)
    return united.groupBy(*by).agg(F.sum(F.bitmap_count("bits")).alias("actor_count"))
