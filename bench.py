"""Time the headline queries and print one JSON line.

``top_repos_endpoint`` answers from a stored rollup, like the published figure
that a production table would already hold (serving table, rollup, lake, message
files) are built first and not timed.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import statistics
import sys
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.rollups import rollup_day
from tidemark.plans.load import load_hour
from tidemark.plans.reads import top_repos
from tidemark.schemas import DAY_PARTIAL
from tidemark.session import scratch_dir
from tidemark.sinks.rollups import read_rollup, write_rollup
from workload import adapters
from workload.queries import FROM_DAY, SLICE_DAY, SLICE_HOUR, TO_DAY, queries

WARMUPS, ROUNDS = 3, 5


def _consume(frame: DataFrame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def _measure(action: Callable[[], None]) -> float:
    for _ in range(WARMUPS):
        action()
    times = []
    for _ in range(ROUNDS):
        start = time.perf_counter()
        action()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times), 4)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered = queries()

    adapters.serving(spark, sf_dir)
    adapters.message_files(spark, sf_dir)
    landing = adapters.landing(spark, sf_dir)
    lake = adapters.loaded_lake(spark, sf_dir, "bench")
    rollup_path = scratch_dir(spark, "bench-rollup")
    write_rollup(
        rollup_day(adapters.serving(spark, sf_dir), "historic"), rollup_path, ("event_type", "date", "repo_name")
    )
    rollup = read_rollup(spark, rollup_path, DAY_PARTIAL)
    # the same endpoint over as many rollup rows as the published figure had: every day's
    # rows again under further repository names
    times = -(-1_400_000 // max(1, rollup.count()))
    large_path = scratch_dir(spark, "bench-large")
    copies = rollup.drop("month", "batch_id", "run").withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(times))))
    copies = copies.withColumn("repo_name", F.concat("repo_name", F.lit("/"), F.col("k").cast("string"))).drop("k")
    write_rollup(copies, large_path, ("event_type", "date", "repo_name"))
    large = read_rollup(spark, large_path, DAY_PARTIAL)
    new_hour = adapters.lake_rows(spark, sf_dir).filter("type <> 'PushEvent'")
    hour = dt.datetime.fromisoformat(SLICE_DAY) + dt.timedelta(hours=SLICE_HOUR)

    def endpoint() -> None:
        top_repos(rollup, FROM_DAY, TO_DAY, event_types=["WatchEvent"], group_by=["event_type"]).collect()

    def endpoint_large() -> None:
        top_repos(large, FROM_DAY, TO_DAY, event_types=["WatchEvent"], group_by=["event_type"]).collect()

    def report() -> None:
        top_repos(rollup, FROM_DAY, TO_DAY, group_by=["repo_name"]).collect()

    actions: dict[str, Callable[[], None]] = {
        "top_repos_endpoint": endpoint,
        "top_repos_endpoint_large": endpoint_large,
        "top_repos_by_repo": report,
        "replace_hour": lambda: lake.replace_from_table(new_hour, hour, hour + dt.timedelta(hours=1)),
        "load_hour": lambda: load_hour(lake, landing, SLICE_DAY, SLICE_HOUR, adapters.ARCHIVE_FOLDER),
    }
    for name in (
        "rollup_day_count",
        "rollup_day_actors",
        "merge_actors_by_type",
        "rollup_two_sources",
        "copy_historic",
        "events_stats",
        "last_event_date",
        "missing_hours",
        "stream_minute_rollup",
    ):
        actions[name] = lambda query=registered[name]: _consume(query(spark, sf_dir))

    seconds = {name: _measure(action) for name, action in actions.items()}
    print(
        json.dumps(
            {
                "metric": "sum of median query times",
                "value": round(sum(seconds.values()), 4),
                "unit": "sec",
                "queries": seconds,
                "rollup_rows": rollup.count(),
                "rollup_rows_large": large.count(),
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    sys.exit(main())
