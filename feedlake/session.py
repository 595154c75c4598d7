"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "feedlake", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every job here relies on.

    Times are UTC.  AQE sizes the shuffles: it merges small partitions and splits
    skewed ones, so ``spark.sql.shuffle.partitions`` is best set high (two to three
    times the cores of the cluster) through ``conf``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.parquet.filterPushdown": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@cache
def _local_scratch() -> str:
    return tempfile.mkdtemp(prefix="feedlake-")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder that all executors can reach.

    It lies under ``spark.checkpoint.dir``.  Only a session in a single process may go
    without that setting; on a cluster a machine's own temporary folder would be lost with it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = _local_scratch()
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"


@cache
def _shipped(sc: SparkContext, application: str) -> None:
    package = os.path.dirname(os.path.abspath(__file__))
    top = os.path.dirname(package)
    path = os.path.join(tempfile.mkdtemp(), f"{os.path.basename(package)}.zip")
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    out.write(os.path.join(folder, name), os.path.relpath(os.path.join(folder, name), top))
    sc.addPyFile(path)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, for the Python code that runs there."""
    _shipped(spark.sparkContext, spark.sparkContext.applicationId)


def _found(spark: SparkSession, path: str):
    """A path as Hadoop has it, and its file system."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of any file system that Spark can write to."""
    found, store = _found(spark, path)
    store.delete(found, True)


def move_folder(spark: SparkSession, path: str, to: str) -> None:
    """Move a folder to another place of its file system, in place of the folder there."""
    (found, store), (place, _) = _found(spark, path), _found(spark, to)
    store.delete(place, True)
    store.mkdirs(place.getParent())
    if not store.rename(found, place):
        raise OSError(f"{path} could not be moved to {to}")


def subfolders(spark: SparkSession, path: str, depth: int) -> list[list[str]]:
    """The folders so many levels below a folder, each as the names on the way to it."""
    if not depth:
        return [[]]
    found, store = _found(spark, path)
    names = [s.getPath().getName() for s in store.listStatus(found) if s.isDirectory()]
    return [[name, *rest] for name in names for rest in subfolders(spark, f"{path}/{name}", depth - 1)]


@contextmanager
def scratch(spark: SparkSession, label: str) -> Iterator[str]:
    """A scratch folder for the time of a block; what the block has made is gone afterwards."""
    path = scratch_dir(spark, label)
    try:
        yield path
    finally:
        remove_folder(spark, path)


@contextmanager
def brief_shuffles(spark: SparkSession) -> Iterator[None]:
    """What is run in the block deletes its shuffled rows at its end, not when the driver comes to collect its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def splittable(df: DataFrame) -> DataFrame:
    """Shuffle the aggregated side of a join anew.

    AQE splits a skewed partition of the other side only where both sides come straight
    from a shuffle.  An aggregate on the join keys would be joined in place; rows of one
    hot key would then meet it in a single task.
    """
    return df.hint("rebalance")


def write_and_reload(df: DataFrame, path: str) -> DataFrame:
    """Write an intermediate table once and go on from the written copy.

    The later steps neither repeat the work nor depend on executors that held it.
    """
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
