"""Which folder holds each partition of a merged table, and how partitions are exchanged.

Rows of rewritten partitions are written once, to a folder of their own below ``_v``. The exchange itself is metadata: a small
list of partition folders below ``_current`` takes effect when it gets its name, for readers by path all partitions at once; the
catalog's partition locations follow one by one, each from one whole folder to another. A list without its ``.done`` mark
says that the catalog may be behind; ``finish_swap`` makes it follow. Folders that neither the list in force nor
the one before it names are removed, so a reader that began before an exchange can end.

Beside each folder stands a summary below ``_k``: per partition and bucket of keys the number of rows and the range of the tracked
columns. It shows which partitions can hold a key, and bounds of a column, without opening the table's files.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.operators.columns import named, quoted
from siltstone.sources.listing import child_names, make_folder, partition_values, read_text, remove_path, write_text

VERSIONS, SUMMARIES, LISTS = "_v", "_k", "_current"
#: Whole-number keys of one bucket; other keys are spread over so many buckets by their hash.
KEYS_PER_BUCKET = 4096
HASH_BUCKETS = 1 << 16


@dataclass(frozen=True)
class Listing:
    """``folders`` by partition value: below the table's path, or empty for a partition without rows.

    Partitions that it does not name are in their usual place. ``pending`` are those that changed with list ``number``.
    """

    number: int
    partition: str
    folders: dict[str, str]
    pending: list[str]
    done: bool


def current(spark: SparkSession, path: str) -> Listing:
    """The list in force."""
    names = child_names(spark, f"{path}/{LISTS}")
    numbers = sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith((".", "_")))
    if not numbers:
        return Listing(0, "", {}, [], True)
    last = numbers[-1]
    body = json.loads(read_text(spark, f"{path}/{LISTS}/{last:08d}.json"))
    return Listing(last, body["partition"], body["folders"], body["pending"], f"{last:08d}.done" in names)


def partitions_of(spark: SparkSession, path: str, partition: str, listing: Listing | None = None) -> dict[str, str]:
    """Folder below ``path`` of every partition that has one."""
    listing = current(spark, path) if listing is None else listing
    usual = {v: f"{partition}={v}" for v in partition_values(spark, path, partition)}
    return {v: f for v, f in sorted((usual | listing.folders).items()) if f}


def scan_current(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """The rows that the list in force shows, or None if the table has no list."""
    listing = current(spark, path)
    if not listing.number:
        return None
    by_base: dict[str, list[str]] = {}
    for folder in partitions_of(spark, path, listing.partition, listing).values():
        by_base.setdefault(folder.rpartition("/")[0], []).append(f"{path}/{folder}")
    out = spark.createDataFrame([], schema)
    for n, (base, folders) in enumerate(sorted(by_base.items())):
        rows = spark.read.schema(schema).option("basePath", f"{path}/{base}".rstrip("/")).parquet(*folders).select(*map(named, schema.names))
        out = rows if n == 0 else out.unionByName(rows)
    return out


def key_bucket(keys: Sequence[tuple[str, T.DataType]]) -> Column:
    """Bucket of a key: neighbours for one whole number, else a hash. Null keys have none; without key columns there is one."""
    if not keys:
        return F.lit(0).cast("long")
    if len(keys) == 1 and isinstance(keys[0][1], (T.LongType, T.IntegerType, T.ShortType)):
        key = named(keys[0][0]).cast("long")
        return F.floor(key / F.lit(float(KEYS_PER_BUCKET))).cast("long")
    complete = F.lit(True)
    for name, _ in keys:
        complete = complete & named(name).isNotNull()
    return F.when(complete, F.pmod(F.xxhash64(*[named(n) for n, _ in keys]), F.lit(HASH_BUCKETS)).cast("long"))


def _summarise(spark: SparkSession, path: str, version: str, schema: T.StructType, partition: str, keys: Sequence[str], tracked: Sequence[str]) -> None:
    rows = spark.read.schema(schema).parquet(f"{path}/{VERSIONS}/{version}")
    bucket = key_bucket([(k, schema[k].dataType) for k in keys if k != partition]).alias("bucket")
    ranges = [f(named(c)).alias(f"{n}_{c}") for c in tracked for n, f in (("min", F.min), ("max", F.max))]
    summary = rows.groupBy(named(partition), bucket).agg(F.count(F.lit(1)).alias("n_rows"), *ranges)
    summary.write.partitionBy(partition).parquet(f"{path}/{SUMMARIES}/{version}")


def summary(spark: SparkSession, path: str, partition: str) -> tuple[DataFrame | None, list[str]]:
    """(summaries of the partitions in force, partitions that have none)."""
    listing = current(spark, path)
    inside = {v: f for v, f in partitions_of(spark, path, partition, listing).items() if f.startswith(VERSIONS)}
    none = [v for v in partitions_of(spark, path, partition, listing) if v not in inside]
    by_version: dict[str, list[str]] = {}
    for v, folder in inside.items():
        by_version.setdefault(folder.split("/")[1], []).append(v)
    out = None
    for version, values in sorted(by_version.items()):
        base = f"{path}/{SUMMARIES}/{version}"
        rows = spark.read.option("basePath", base).parquet(*[f"{base}/{partition}={v}" for v in values])
        rows = rows.withColumn(partition, named(partition).cast("string"))
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return out, none


def partitions_with_keys(source: DataFrame, schema: T.StructType, path: str, partition: str, keys: Sequence[str]) -> list[str]:
    """Partitions that may hold a key of ``source``: those whose summary shares a bucket, and those without a summary.

    ``schema`` is the table's, whose types the keys get before they are put into buckets.
    """
    known, none = summary(source.sparkSession, path, partition)
    if known is None:
        return none
    keys = [k for k in keys if k != partition]
    typed = source.select(*[named(k).cast(schema[k].dataType).alias(k) for k in keys])
    buckets = typed.select(key_bucket([(k, schema[k].dataType) for k in keys]).alias("bucket")).distinct()
    met = known.join(buckets, "bucket", "left_semi").select(partition).distinct().collect()
    return sorted({*none, *(r[0] for r in met)})


def tracked_range(table: DataFrame, path: str, partition: str, column: str) -> DataFrame:
    """One row ``lo, hi``: the range of a tracked column, from the summaries; only partitions without one are read."""
    known, none = summary(table.sparkSession, path, partition)
    low, high = f"min_{column}", f"max_{column}"
    if known is not None and low not in known.columns:
        known, none = None, list(partitions_of(table.sparkSession, path, partition))
    rows = table.filter(named(partition).isin(none)) if none else table.limit(0)
    rows = rows.select(named(column).alias("lo"), named(column).alias("hi"))
    if known is not None:
        held = known.select(named(low).alias("lo"), named(high).alias("hi"))
        rows = held.unionByName(rows) if none else held
    return rows.agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))


def write_version(rows: DataFrame, path: str, partition: str, several: bool, keys: Sequence[str], tracked: Sequence[str]) -> dict[str, str]:
    """Write rows once, with their summary; returns the folder of each partition that got any. Nobody reads them yet."""
    spark = rows.sparkSession
    version = uuid.uuid4().hex[:12]
    spread = rows.hint("rebalance", partition) if several else rows
    spread.write.partitionBy(partition).parquet(f"{path}/{VERSIONS}/{version}")
    values = partition_values(spark, f"{path}/{VERSIONS}/{version}", partition)
    if values and keys:
        _summarise(spark, path, version, rows.schema, partition, keys, [c for c in tracked if c in rows.columns])
    return {v: f"{VERSIONS}/{version}/{partition}={v}" for v in values}


def swap(spark: SparkSession, name: str, path: str, partition: str, folders: dict[str, str]) -> None:
    """Let the partitions be in ``folders`` from now on; one writer at a time.

    The list in force decides. A driver lost before it is written leaves the table as it was, one lost after it leaves the
    catalog to ``finish_swap``.
    """
    put_in_force(spark, path, partition, folders)
    finish_swap(spark, name, path, partition)


def put_in_force(spark: SparkSession, path: str, partition: str, folders: dict[str, str]) -> None:
    """Write the next list, in which the partitions are in ``folders``."""
    before = current(spark, path)
    body = {"partition": partition, "folders": before.folders | folders, "pending": sorted(folders)}
    make_folder(spark, f"{path}/{LISTS}")
    write_text(spark, f"{path}/{LISTS}/{before.number + 1:08d}.json", json.dumps(body))


def finish_swap(spark: SparkSession, name: str, path: str, partition: str) -> None:
    """Make the catalog's partition locations those of the list in force, where they may differ."""
    listing = current(spark, path)
    if listing.done:
        return
    set_locations(spark, name, path, partition, {v: listing.folders[v] for v in listing.pending})
    make_folder(spark, f"{path}/{LISTS}/{listing.number:08d}.done")
    _clean(spark, path, partition, listing)


def set_locations(spark: SparkSession, name: str, path: str, partition: str, folders: dict[str, str]) -> None:
    there = {r[0].partition("=")[2] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    for value, folder in sorted(folders.items()):
        spec = f"PARTITION ({quoted(partition)}='{value}')"
        if not folder:
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {spec}")
        elif value in there:
            spark.sql(f"ALTER TABLE {name} {spec} SET LOCATION '{path}/{folder}'")
        else:
            spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {spec} LOCATION '{path}/{folder}'")
    spark.catalog.refreshTable(name)


def _clean(spark: SparkSession, path: str, partition: str, listing: Listing) -> None:
    """Remove what neither this list nor the one before it names."""
    earlier = f"{path}/{LISTS}/{listing.number - 1:08d}.json"
    names = child_names(spark, f"{path}/{LISTS}")
    before = json.loads(read_text(spark, earlier))["folders"] if f"{listing.number - 1:08d}.json" in names else {}
    kept = {f.split("/")[1] for f in [*listing.folders.values(), *before.values()] if f.startswith(VERSIONS)}
    for kind in (VERSIONS, SUMMARIES):
        for version in child_names(spark, f"{path}/{kind}"):
            if version not in kept:
                remove_path(spark, f"{path}/{kind}/{version}")
    for value in partition_values(spark, path, partition):
        if value in before and value in listing.folders:
            remove_path(spark, f"{path}/{partition}={value}")
    for name in names:
        if name.split(".")[0].isdigit() and int(name.split(".")[0]) < listing.number - 1:
            remove_path(spark, f"{path}/{LISTS}/{name}")
