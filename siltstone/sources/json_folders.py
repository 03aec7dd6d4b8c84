"""RAW file set: JSON folders ``<root>/period=<yyyyMM>/folder=<name>``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from siltstone.functions.names import path_folder, path_period
from siltstone.schemas import RAW_SCHEMA
from siltstone.sources.listing import child_names, few_listing_tasks

PARTITIONS = T.StructType(
    [T.StructField("period", T.StringType()), T.StructField("folder", T.StringType())]
)


def write_folders(df: DataFrame, root: str) -> None:
    """Write rows into their (period, folder), replacing folders of the same name.

    The rebalance lets AQE merge small folders' blocks and split a folder that holds much of
    the data over several tasks.
    """
    (
        df.hint("rebalance", "period", "folder")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("period", "folder")
        .json(root)
    )


def write_lines(df: DataFrame, root: str) -> None:
    """The same for rows whose ``value`` is the JSON text of a row already."""
    (
        df.select("value", "period", "folder")
        .hint("rebalance", "period", "folder")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("period", "folder")
        .text(root)
    )


def period_lines(spark: SparkSession, root: str, period: str) -> DataFrame:
    """The lines of one period's folders as they are, with ``period`` and ``folder`` columns."""
    full = T.StructType([T.StructField("value", T.StringType()), *PARTITIONS.fields])
    with few_listing_tasks(spark):
        return spark.read.schema(full).option("basePath", root).text(f"{root}/period={period}")


def scan_paths(
    spark: SparkSession, paths: str | Sequence[str], schema: T.StructType = RAW_SCHEMA
) -> DataFrame:
    """JSON rows of one or many paths or wildcards; fields a folder lacks are null."""
    return spark.read.schema(schema).json(paths)


def scan_period(
    spark: SparkSession, root: str, period: str, schema: T.StructType = RAW_SCHEMA
) -> DataFrame:
    """Rows of one period with ``period`` and ``folder`` columns; other periods are not listed."""
    full = T.StructType([*schema.fields, *PARTITIONS.fields])
    return (
        spark.read.schema(full).option("basePath", root).json(f"{root}/period={period}")
    )


def list_folders(spark: SparkSession, root: str, period: str | None = None) -> DataFrame:
    """Distinct (period, folder) under ``root``, for both ``period=202411`` and ``202411`` levels.

    Only file paths are read, no file content.
    """
    # Only the period level is a wildcard; Spark lists the levels below in a job of its own.
    level = "" if period is None else "/{" + f"period={period},{period}" + "}"
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    try:
        with few_listing_tasks(spark):
            files = reader.load(root + level)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], PARTITIONS)
    return files.select(
        path_period("path").alias("period"), path_folder("path").alias("folder")
    ).distinct()


def newest_folders(spark: SparkSession, root: str) -> DataFrame:
    """The folders of the newest period only, newest by text order."""
    periods = [name.removeprefix("period=") for name in child_names(spark, root)]
    periods = [p for p in periods if p[:1] not in ("_", ".")]
    if not periods:
        return spark.createDataFrame([], PARTITIONS)
    return list_folders(spark, root, max(periods))


def folder_from_metadata(df: DataFrame) -> DataFrame:
    """Add the folder name of each row's file (batch or stream)."""
    return df.withColumn("folder", path_folder(F.col("_metadata.file_path")))
