"""Shards of ascending keys whose bounds depend on the rows alone, and files written by tasks."""

from __future__ import annotations

import uuid
from bisect import bisect_right
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.scratch import materialize

CELLS = 1024
SHARD_BYTES = 16 << 20
#: With more weight shards grow instead of becoming more, so what follows from their number has a bound.
MOST_SHARDS = 1 << 16
MOST_READERS = 10_000


class Shards(NamedTuple):
    """First keys of the second and later shards, and how a key finds its shard.

    ``levels`` has for each level ``id, lo, width, first`` of the cells that are divided: a key of such a cell is in the cell
    ``first + (key - lo) / width`` of the next level. ``leaves`` is the shard of every cell that is not divided.
    """

    bounds: list[int]
    levels: list[list[tuple[int, int, int, int]]]
    leaves: list[tuple[int, int]]


def _cell(rows: DataFrame, key: Column, levels: list[list[tuple[int, int, int, int]]]) -> DataFrame:
    """Rows with the number of the cell, ``__cell``, that their key is in; null keys have none.

    A join on the cell's number for each level. The tables have at most a few rows per shard, of which there are ``MOST_SHARDS``.
    """
    spark = rows.sparkSession
    rows = rows.withColumn("__cell", F.when(key.isNotNull(), F.lit(0).cast("long")))
    for level in levels:
        table = F.broadcast(spark.createDataFrame(level, "__cell bigint, __lo bigint, __width bigint, __first bigint"))
        if len(level) == 1 and level[0][0] == 0:
            _, lo, width, first = level[0]
            rows = rows.withColumn("__cell", F.when(key.isNotNull(), F.lit(first) + _quotient(key - F.lit(lo), F.lit(width))))
            continue
        inside = F.col("__first") + _quotient(key - F.col("__lo"), F.col("__width"))
        rows = rows.join(table, "__cell", "left").withColumn("__cell", F.coalesce(inside, F.col("__cell"))).drop("__lo", "__width", "__first")
    return rows


def _quotient(a: Column, b: Column) -> Column:
    """Whole quotient of longs, which a division would round."""
    return F.call_function("div", a.cast("long"), b.cast("long"))


def plan_shards(rows: DataFrame, key: str, weight: Column, target: int = SHARD_BYTES) -> Shards:
    """Shards of about ``target`` of ``weight`` each.

    Weights are summed over equal ranges of the key, and all ranges that are too heavy are divided again in one pass, so the number of
    passes follows from the spread of the keys, not from the number of shards, and the bounds are the same however Spark partitions
    the rows. Keys and weights are read once. On the driver: a few sums per shard. Keys are whole numbers; null keys count
    nowhere and belong to the first shard.
    """
    narrow = materialize(rows.select(F.col(key).cast("long").alias("k"), weight.cast("long").alias("w")).filter("k IS NOT NULL"), "weights")
    lo, hi, total = narrow.agg(F.min("k"), F.max("k"), F.sum("w")).first()
    if lo is None:
        return Shards([], [], [])
    target = max(target, -(-total // MOST_SHARDS))
    divided, after = [(0, lo, hi, total)], 1
    levels: list[list[tuple[int, int, int, int]]] = []
    leaves: list[tuple[int, int, int]] = []
    while divided:
        level, spans = [], []
        for cell, a, b, held in divided:
            parts = max(2 * -(-held // target), CELLS // len(divided), 2)
            width = max(1, -(-(b - a + 1) // parts))
            level.append((cell, a, width, after))
            spans.append((after, a, b, width))
            after += -(-(b - a + 1) // width)
        levels.append(level)
        sums = _cell(narrow, F.col("k"), levels).filter(F.col("__cell") >= spans[0][0]).groupBy("__cell").agg(F.sum("w").alias("w")).collect()
        firsts = [s[0] for s in spans]
        divided = []
        for r in sorted(sums, key=lambda r: r["__cell"]):
            first, a, b, width = spans[bisect_right(firsts, r["__cell"]) - 1]
            start = a + (r["__cell"] - first) * width
            if r["w"] > 2 * target and width > 1:
                divided.append((r["__cell"], start, min(b, start + width - 1), r["w"]))
            else:
                leaves.append((start, r["__cell"], r["w"]))
    bounds, shard_of, held = [], [], 0
    for start, cell, w in sorted(leaves):
        if held and held + w > target:
            bounds.append(start)
            held = 0
        held += w
        shard_of.append((cell, len(bounds)))
    return Shards(bounds, levels, shard_of)


def in_shards(rows: DataFrame, key: str, shards: Shards, *order: str | Column) -> DataFrame:
    """Rows dealt out by shard, each shard whole in one partition and sorted by ``key, *order``."""
    if shards.bounds:
        leaves = F.broadcast(rows.sparkSession.createDataFrame(shards.leaves, "__cell bigint, __shard int"))
        dealt = _cell(rows, F.col(key), shards.levels).join(leaves, "__cell", "left").drop("__cell")
        dealt = dealt.withColumn("__shard", F.coalesce("__shard", F.lit(0)))
    else:
        dealt = rows.withColumn("__shard", F.lit(0))
    return dealt.repartitionByRange(len(shards.bounds) + 1, "__shard").sortWithinPartitions("__shard", key, *order)


def one_each(manifest: DataFrame) -> DataFrame:
    """The manifest's rows in partitions of their own, so that each file is read by its own task."""
    return manifest.repartitionByRange(min(MOST_READERS, max(1, manifest.count())), "file")


class FileSet:
    """Files of one folder on any file system that pyarrow knows by URI, seen only when complete."""

    def __init__(self, folder: str):
        from pyarrow import fs

        self.fs, self.root = fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")
        self.fs.create_dir(self.root, recursive=True)

    def write(self, name: str, data: bytes) -> None:
        """Write under a name of this attempt, then rename: a retried task replaces its file."""
        path = f"{self.root}/{name}"
        draft = f"{self.root}/.{name}.{uuid.uuid4().hex}.tmp"
        with self.fs.open_output_stream(draft, compression=None) as out:
            out.write(data)
        self.fs.move(draft, path)

    def read(self, name: str) -> bytes:
        with self.fs.open_input_file(f"{self.root}/{name}") as f:
            return f.read()
