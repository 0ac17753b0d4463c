"""Shared scratch space and folders."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession


def path_exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def remove_paths(spark: SparkSession, paths: Iterable[str]) -> None:
    """Delete folders of any file system that Spark reaches, several at a time; absent ones are no error."""
    configuration, hadoop = spark._jsc.hadoopConfiguration(), spark._jvm.org.apache.hadoop.fs

    def remove(path: str) -> None:
        place = hadoop.Path(path)
        place.getFileSystem(configuration).delete(place, True)

    with ThreadPoolExecutor(8) as pool:
        list(pool.map(remove, paths))


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system, as listings name it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toString()


def list_paths(spark: SparkSession, pattern: str) -> list[tuple[str, float]]:
    """Qualified paths that match a pattern, with the seconds of their last change; none if nothing does."""
    place = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place)
    return [(f.getPath().toString(), f.getModificationTime() / 1000) for f in found or ()]


def read_text(spark: SparkSession, path: str) -> str:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = place.getFileSystem(spark._jsc.hadoopConfiguration()).open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def publish_text(spark: SparkSession, path: str, text: str) -> bool:
    """Make a file appear whole, by one rename; False if there is one of that name already."""
    hadoop, configuration = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    target = hadoop.Path(qualified(spark, path))
    system = target.getFileSystem(configuration)
    draft = hadoop.Path(target.getParent(), f".{target.getName()}.{uuid.uuid4().hex}")
    stream = system.create(draft, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    keep = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)  # fail rather than overwrite
    try:
        hadoop.FileContext.getFileContext(target.toUri(), configuration).rename(draft, target, keep)
    except Exception as error:
        system.delete(draft, False)
        if "FileAlreadyExists" in str(error):
            return False
        raise
    return True


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder path for intermediate tables and stream checkpoints.

    Clusters name a shared folder in ``spark.checkpoint.dir``. A folder of this
    machine is used only in local mode, where the driver is the whole cluster.
    """
    name = f"{label}-{uuid.uuid4().hex}"
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return f"{root.rstrip('/')}/{name}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return f"{tempfile.mkdtemp(prefix='tidemark-')}/{name}"
