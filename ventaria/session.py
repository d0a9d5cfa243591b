"""Session settings and the one place where lineage is cut."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import threading
import uuid
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession


def local_session(app: str = "ventaria", cores: str | int = "*") -> SparkSession:
    """Session for tests and the benchmark; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", os.environ.get("VENTARIA_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder the cluster names; a private one only in local mode."""
    global _private
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        if _private is None:
            _private = tempfile.mkdtemp(prefix="ventaria-")
            atexit.register(shutil.rmtree, _private, ignore_errors=True)
        folder = _private
    return f"{folder.rstrip('/')}/ventaria/{spark.sparkContext.applicationId}"


_private: str | None = None


def settle(df: DataFrame, compression: str = "snappy") -> DataFrame:
    """Write ``df`` once to the shared folder and continue from the files.

    Used for grouped results that several later steps read, so that the fact
    scan behind them runs once, and where a row's partition number has become
    data and must not change when a task is retried. Being columnar, later steps
    read only the columns they need; executors may be lost at any time.
    """
    spark = df.sparkSession
    path = f"{checkpoint_folder(spark)}/{uuid.uuid4().hex}"
    for made in getattr(_here, "made", []):
        made.append(path)
    df.write.options(**{"compression": compression, **getattr(_here, "layout", {})}).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def in_differences():
    """What is settled inside has sorted and counted columns, which are written as differences."""
    _here.layout = {"compression": "zstd", "parquet.writer.version": "PARQUET_2_0"}
    try:
        yield
    finally:
        _here.layout = {}


def by_key(df: DataFrame, key: str | Column) -> DataFrame:
    """Rows parted by the hash of ``key`` as :func:`settle_by` parts them; nothing moves where they already are."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def united(parts: list[DataFrame], key: str) -> DataFrame:
    """Union of rows that are all parted by ``key``, which stay so: only a new name lets a union keep the buckets of its parts.

    A plain union of stored buckets must not be grouped by their key: it counts as parted, but its tasks are not brought together.
    """
    return reduce(DataFrame.unionByName, [df.withColumnRenamed(key, "_parted") for df in parts]).withColumnRenamed("_parted", key)


@contextmanager
def _setting(spark: SparkSession, name: str, value: str):
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def parted_by_one(spark: SparkSession):
    """Joins planned inside keep rows that are parted by one of several join keys where they are; the other side comes to them."""
    return _setting(spark, "spark.sql.requireAllClusterKeysForCoPartition", "false")


OPEN_FILES = 4  # buckets a task writes at once


def unsorted_buckets(spark: SparkSession):
    """A task that writes few buckets holds a file open for each, so its rows are not sorted by bucket first; one with more sorts the rest."""
    return _setting(spark, "spark.sql.maxConcurrentOutputFileWriters", str(OPEN_FILES))


_WIDE = {"compression": "zstd", "parquet.dictionary.page.size": str(64 << 10)}  # texts of many values leave the dictionary early, which costs less than to look them up


def settle_by(df: DataFrame, key: str) -> DataFrame:
    """``settle`` in buckets of ``key``: groupings and joins by it then leave the rows where they are.

    No exchange precedes the write: rows parted by ``key`` give one file a bucket,
    any others give more files and the same rows.
    """
    spark, mark = df.sparkSession, uuid.uuid4().hex
    path = f"{checkpoint_folder(spark)}/{mark}"
    for made in getattr(_here, "made", []):
        made.append(path)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    with parted_by_one(spark), unsorted_buckets(spark):
        df.write.bucketBy(buckets, key).option("path", path).options(**{**_WIDE, **getattr(_here, "layout", {})}).saveAsTable(f"ventaria_{mark}", format="parquet")
    return spark.table(f"ventaria_{mark}")


_here = threading.local()


@contextmanager
def leftovers_removed(spark: SparkSession):
    """Delete what this thread settles inside the block when it ends; results must be written by then."""
    own: list[str] = []
    _here.made = [*getattr(_here, "made", []), own]
    try:
        yield
    finally:
        _here.made = _here.made[:-1]
        for folder in own:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


_dropped = 0


def stage_key(spark: SparkSession, folder: str) -> tuple:
    """What stages kept for a folder depend on: the application, what was dropped since, and the folder's files."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    return (spark.sparkContext.applicationId, _dropped, folder, tuple(sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in files)))


def drop_settled(spark: SparkSession) -> None:
    """Delete everything this application settled, once its results are no longer read; kept stages are made anew."""
    global _dropped
    _dropped += 1
    path = spark._jvm.org.apache.hadoop.fs.Path(checkpoint_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
