"""Catalog tables over a path: create, evolve, register again, append a batch, save a merge."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.operators.columns import conform, named, quoted, spelled_as
from siltstone.operators.merge import merge_upsert, require_unique
from siltstone.scratch import materialize
from siltstone.sources import swaps
from siltstone.sources.listing import data_files

#: Size of a file that compaction aims at.
FILE_BYTES = 128 << 20


def create_database(spark: SparkSession, db: str, location: str | None = None) -> None:
    at = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(db)}{at}")


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def path_schema(spark: SparkSession, path: str, merge: bool = True) -> T.StructType | None:
    """Union of the file schemas below ``path``, or None when there is no table there.

    Without ``merge`` one file footer is read instead of all.
    """
    listing = swaps.current(spark, path)
    if listing.number:
        folders = [f"{path}/{f}" for f in swaps.partitions_of(spark, path, listing.partition, listing).values()]
        found = spark.read.option("mergeSchema", merge).parquet(*folders).schema if folders else T.StructType()
        return found if listing.partition in found.names else found.add(listing.partition, T.StringType())
    try:
        return spark.read.option("mergeSchema", merge).parquet(path).schema
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def table_path(spark: SparkSession, name: str) -> str:
    """Where the files of a registered table are."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'").collect()
    return rows[-1]["data_type"].rstrip("/")


def has_table(spark: SparkSession, path: str) -> bool:
    return path_schema(spark, path, merge=False) is not None


def read_path(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Scan by path. With ``schema`` no file is opened for inference and text partitions stay text.

    Of a merged table the partitions in force are read, all of one state.
    """
    if swaps.current(spark, path).number:
        return swaps.scan_current(spark, path, path_schema(spark, path) if schema is None else schema)
    if schema is None:
        return spark.sql(f"SELECT * FROM parquet.{quoted(path)}")
    return spark.read.schema(schema).parquet(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def _column_ddl(field: T.StructField) -> str:
    comment = (field.metadata or {}).get("comment")
    tail = " COMMENT '" + comment.replace("\\", "\\\\").replace("'", "\\'") + "'" if comment else ""
    return f"{quoted(field.name)} {field.dataType.simpleString()}{tail}"


def create_external(
    spark: SparkSession, name: str, path: str, schema: T.StructType, partition: str
) -> None:
    """Create a typed, commented, partitioned table over ``path``."""
    columns = [f for f in schema if f.name != partition] + [schema[partition]]
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({', '.join(map(_column_ddl, columns))}) "
        f"USING parquet PARTITIONED BY ({quoted(partition)}) LOCATION '{path}'"
    )


def ensure_table(
    spark: SparkSession, name: str, path: str, schema: T.StructType, partition: str
) -> DataFrame:
    """The table, registered over ``path`` if the catalog does not know it.

    On registration over existing files the columns of earlier runs are found in their
    footers (once); afterwards the catalog holds the schema. An exchange of partitions that was cut short is finished.
    """
    if not table_exists(spark, name):
        db = name.rpartition(".")[0]
        if db:
            create_database(spark, db)
        found = path_schema(spark, path)
        sensitive = spark.conf.get("spark.sql.caseSensitive", "false") == "true"
        fold = str if sensitive else str.lower
        names = {fold(n) for n in schema.names}
        extra = [f for f in found or [] if fold(f.name) not in names]
        create_external(spark, name, path, T.StructType([*schema.fields, *extra]), partition)
        if swaps.current(spark, path).number:
            swaps.set_locations(spark, name, path, partition, swaps.partitions_of(spark, path, partition))
        elif found is not None:
            refresh_partitions(spark, name)
    swaps.finish_swap(spark, name, path, partition)
    return spark.table(name)


def refresh_partitions(
    spark: SparkSession, name: str, partition: str | None = None, values: Sequence[str] = ()
) -> None:
    """Take up partitions written to the table's path.

    With ``values`` only those are registered; otherwise the whole path is listed.
    """
    if partition is None:
        spark.catalog.recoverPartitions(name)
    elif values:
        added = " ".join(f"PARTITION ({quoted(partition)}='{value}')" for value in values)
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {added}")
    spark.catalog.refreshTable(name)


def drop_registration(spark: SparkSession, name: str) -> None:
    """Forget an external table; its files stay."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def add_columns(spark: SparkSession, name: str, fields: Sequence[T.StructField]) -> None:
    """Schema evolution of a registered table."""
    if fields:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(map(_column_ddl, fields))})")


def _write_partitions(df: DataFrame, path: str, partition: str) -> None:
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(partition).parquet(path)


def append_batch(df: DataFrame, path: str, partition: str) -> None:
    """Append rows under a partition value of their own, such as the batch stamp.

    Repeating a failed batch replaces its partition, so no row is appended twice. A scan
    already packs small input files into tasks of full size, each of which writes one file,
    so there is no shuffle for the sake of file sizes; ``compact`` is there for the rest.
    """
    _write_partitions(df, path, partition)


def small_file_bins(
    spark: SparkSession, name: str, path: str, partition: str, values: Sequence[str], target: int = FILE_BYTES, least: int = 4
) -> DataFrame:
    """``partition, file, size, bin``: files below half the target size, where a partition has ``least`` of them or more.

    A bin holds files of about the target size together: its number is the running size over the target, so bins need no more
    than one ordering of a partition's small files. Sizes come from the file listing, no file is opened.
    """
    folders = swaps.partitions_of(spark, path, partition)
    chosen = [f"{path}/{folders[v]}" for v in values if v in folders]
    kind = "path string, modificationTime timestamp, length long, content binary"
    if not chosen:
        return spark.createDataFrame([], f"{quoted(partition)} string, file string, size bigint, bin bigint")
    files = spark.read.schema(kind).format("binaryFile").option("recursiveFileLookup", True).load(chosen)
    value = F.regexp_extract("path", f"/{re.escape(partition)}=([^/]*)/[^/]*$", 1)
    files = files.select(F.url_decode(value).alias(partition), F.col("path").alias("file"), F.col("length").alias("size"))
    small = files.filter(F.col("size") < target // 2)
    many = small.groupBy(partition).count().filter(F.col("count") >= least).select(partition)
    order = Window.partitionBy(partition).orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("size").over(order), F.lit(0))
    return small.join(many, partition, "left_semi").withColumn("bin", F.floor(before / F.lit(target)).cast("bigint"))


def compact(
    spark: SparkSession, name: str, path: str, partition: str, values: Sequence[str],
    target: int = FILE_BYTES, least: int = 4, keys: Sequence[str] = (), tracked: Sequence[str] = (),
) -> list[str]:
    """Put the small files of the given partitions together, about ``target`` bytes to a file; returns the partitions changed.

    A partition whose small files are fewer than ``least`` is left. The rows of a changed one are written once to new
    files, one task for each bin of small files; its large files are read in full size.
    """
    folders = swaps.partitions_of(spark, path, partition)
    values = [v for v in values if v in folders and len(data_files(spark, f"{path}/{folders[v]}")) >= least]
    if not values:
        return []
    bins = materialize(small_file_bins(spark, name, path, partition, values, target, least), "bins")
    changed = sorted(r[0] for r in bins.select(partition).distinct().collect())
    if not changed:
        return []
    rows = spark.table(name).filter(named(partition).isin(changed))
    columns = rows.columns
    listed = bins.select(F.regexp_extract("file", "[^/]*$", 0).alias("__small"), F.col(partition).alias("__of"), F.col("bin").alias("__bin"))
    rows = rows.withColumn("__file", F.url_decode(F.regexp_extract(F.col("_metadata.file_path"), "[^/]*$", 0)))
    same = (F.col("__file") == F.col("__small")) & (named(partition) == F.col("__of"))
    met = rows.join(listed, same, "left")
    # A large file is a bin of its own.
    spread = met.withColumn("__at", F.coalesce(F.col("__bin").cast("string"), F.col("__file")))
    packed = spread.hint("rebalance", partition, "__at").select(*map(named, columns))
    folders = swaps.write_version(packed, path, partition, False, keys, tracked)
    swaps.swap(spark, name, path, partition, folders)
    return changed


def _touched(
    source: DataFrame, target: DataFrame, keys: Sequence[str], partition: str
) -> tuple[list[str], list[str]]:
    """(partitions that receive a source row, other partitions that hold a matched key).

    Reads only key columns of the target. The result is at most one value per partition.
    """
    hit = source.select(partition, F.lit(True).alias("own"))
    if partition not in keys:
        source_keys = source.select(*map(named, keys))
        old = target.select(*map(named, [*keys, partition])).join(source_keys, list(keys), "left_semi")
        hit = hit.union(old.select(partition, F.lit(False)))
    rows = hit.groupBy(partition).agg(F.bool_or("own").alias("own")).collect()
    own = sorted(r[0] for r in rows if r["own"])
    return own, sorted(r[0] for r in rows if not r["own"])


def save_merged(
    source: DataFrame,
    name: str,
    path: str,
    schema: T.StructType,
    keys: Sequence[str],
    partition: str = "dt",
    own: Sequence[str] | None = None,
    unique_source: bool = False,
    tracked: Sequence[str] = (),
) -> list[str]:
    """Upsert ``source`` into the table and return the partitions rewritten.

    Two source rows with one key would make the merge ambiguous and are an error; a caller whose
    rows are unique by construction says so with ``unique_source`` and saves the check.

    ``own`` names the partitions the source rows go to, if the caller knows them. When no
    target row can match, because the table or (with the partition in the key) these
    partitions are new, nothing of the target is read.

    Otherwise only partitions that hold a matched key or receive a row are read in full. They are found from the key
    columns of those that can hold a key of the source by their summary (``swaps.py``); no other partition is opened. The
    merged rows are written once and take effect by metadata. The summary keeps the range of ``tracked`` columns.
    """
    spark = source.sparkSession
    target = ensure_table(spark, name, path, schema, partition)
    source = spelled_as(source, target.columns)
    if not unique_source:
        source = materialize(source, "source")
        require_unique(source, keys)
    add_columns(spark, name, [f for f in source.schema if f.name not in target.columns])
    target = spark.table(name)
    existing = set(swaps.partitions_of(spark, path, partition))
    if own is not None and not (existing & set(own) if partition in keys else existing):
        rows, others = source, []
        own = sorted(own)
    else:
        if unique_source:
            source = materialize(source, "source")
        if partition not in keys:
            possible = swaps.partitions_with_keys(source, target.schema, path, partition, keys)
            own, others = _touched(source, target.filter(named(partition).isin(possible)), keys, partition)
        else:
            own, others = _touched(source, target, keys, partition)
        # Tables made by this function hold a key once.
        rows = merge_upsert(target.filter(named(partition).isin(own + others)), source, keys, unique_target=True)
    rows = conform(rows, target.schema)
    folders = swaps.write_version(rows, path, partition, len(own + others) > 1, keys, tracked)
    emptied = {v: "" for v in others if v not in folders}
    if folders or emptied:
        swaps.swap(spark, name, path, partition, folders | emptied)
    return sorted(own + others)


def merge_into(source: DataFrame, name: str, keys: Sequence[str]) -> None:
    """The same upsert on a table format with row-level operations, by the format's own MERGE."""
    condition = F.lit(True)
    for key in keys:
        condition = condition & (F.col(f"{name}.{key}") == F.col(f"new.{key}"))
    merge = source.alias("new").mergeInto(name, condition).withSchemaEvolution()
    merge.whenMatched().updateAll().whenNotMatched().insertAll().merge()


def preview(df: DataFrame, n: int = 5, order: Sequence[str] = ()) -> DataFrame:
    """First ``n`` rows; with ``order`` a top-n without a full sort."""
    return (df.orderBy(*order) if order else df).limit(n)


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"))
