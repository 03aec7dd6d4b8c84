"""Names directly below a folder, in one file-system call."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

_LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
#: Listing tasks for each core.
TASKS_PER_CORE = 4


@contextmanager
def few_listing_tasks(spark: SparkSession) -> Iterator[None]:
    """Spark lists many folders in as many tasks as keep the cores busy, not in one task per folder.

    A task costs more than the listing of a folder; a lower number of the session's own stays.
    """
    before = spark.conf.get(_LISTING)
    spark.conf.set(_LISTING, min(int(before), TASKS_PER_CORE * spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.set(_LISTING, before)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries below ``path``; empty when there is no such folder.

    Used on levels with one entry per run or month, never on files.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return []
    return [entry.getPath().getName() for entry in files.listStatus(folder)]


def glob_count(spark: SparkSession, glob: str) -> int:
    """How many files and folders a wildcard names; the level above is listed, none of them is looked into."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(glob)
    return len(pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern) or ())


def make_folder(spark: SparkSession, path: str) -> None:
    """Make a folder and those above it; one that is there stays."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)


def read_text(spark: SparkSession, path: str) -> str:
    """A small file as text."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark._jsc.hadoopConfiguration()).open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that has its name only when it is whole; an error if there is one of that name."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    draft = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rpartition('/')[0]}/.{uuid.uuid4().hex}.tmp")
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    stream = files.create(draft)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if files.exists(target) or not files.rename(draft, target):
        files.delete(draft, False)
        raise FileExistsError(path)


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a file or a folder and what is in it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def data_files(spark: SparkSession, path: str) -> list[str]:
    """Names of the visible entries of a folder, as Spark reads them."""
    return [name for name in child_names(spark, path) if name[:1] not in ("_", ".")]


def partition_values(spark: SparkSession, path: str, partition: str) -> list[str]:
    """Values of the first partition level of a table's path."""
    start = f"{partition}="
    names = child_names(spark, path)
    return sorted(name.removeprefix(start) for name in names if name.startswith(start))
