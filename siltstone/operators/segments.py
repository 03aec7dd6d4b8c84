"""Running values over one long ordering without putting it into one task.

The order is cut into segments by a monotone expression on the order key. A window runs
inside each segment, a second one over one summary row per segment, and both are joined
on the segment, which reuses the partitioning of the first window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.scratch import materialize

# Fixed value: integer keys per segment. Summary rows are 1 / WIDTH of the key range.
WIDTH = 1_000_000


def segment_of(key: Column | str, width: int = WIDTH) -> Column:
    key = F.col(key) if isinstance(key, str) else key
    return floor_div(key, width)


def floor_div(key: Column, by: int) -> Column:
    """Whole quotient rounded down, exact for every long; ``/`` would go through double."""
    key = key.cast("long")
    return F.call_function("div", key - F.pmod(key, F.lit(by).cast("long")), F.lit(by).cast("long"))


def global_row_number(
    df: DataFrame, segment: Column, order: Sequence[Column | str], name: str = "row_number"
) -> DataFrame:
    """1-based position of every row by segment, then by ``order`` inside it."""
    inside = Window.partitionBy("__seg").orderBy(*order)
    local = df.withColumn("__seg", segment).withColumn("__i", F.row_number().over(inside))
    before = Window.orderBy("__seg").rowsBetween(Window.unboundedPreceding, -1)
    # Counted on the windowed rows, whose partitioning it shares, so the input is read once.
    offsets = (
        local.groupBy("__seg")
        .agg(F.max("__i").alias("__n"))
        .select("__seg", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    )
    return (
        local.join(offsets, "__seg")
        .withColumn(name, F.col("__before") + F.col("__i"))
        .drop("__seg", "__i", "__before")
    )


def volume_row_number(df: DataFrame, order: Sequence[Column], name: str = "row_number") -> DataFrame:
    """1-based position of every row in ``order``, over partitions of even size however the keys lie.

    Spark samples the order and cuts it into ranges of about as many rows; the sorted ranges are written once with each row's
    place in its file. What stands before a file is summed over one row per file. Rows that tie in ``order`` may have any
    of their positions.
    """
    keys = [c.alias(f"__o{i}") for i, c in enumerate(order)]
    by = [f"__o{i}" for i in range(len(order))]
    ranges = df.select("*", *keys).repartitionByRange(*by).sortWithinPartitions(*by).drop(*by)
    laid = materialize(ranges.withColumn("__at", F.monotonically_increasing_id()), "ordered")
    file = F.shiftright("__at", 33).alias("__file")
    counts = laid.groupBy(file).agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__file").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("__file", (F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__first") + 1).alias("__shift"))
    placed = laid.withColumn("__file", F.shiftright("__at", 33)).join(starts, "__file")
    return placed.withColumn(name, F.col("__at") + F.col("__shift")).drop("__at", "__file", "__shift")


def next_flagged(
    df: DataFrame, key: str, flag: Column, name: str, width: int = WIDTH
) -> DataFrame:
    """The smallest flagged key at or after each row's own; null when none follows."""
    hit = F.when(flag, F.col(key))
    seg = df.withColumn("__seg", segment_of(key, width)).withColumn("__hit", hit)
    later = Window.orderBy("__seg").rowsBetween(1, Window.unboundedFollowing)
    following = (
        seg.groupBy("__seg")
        .agg(F.min("__hit").alias("__first"))
        .select("__seg", F.min("__first").over(later).alias("__later"))
    )
    ahead = Window.partitionBy("__seg").orderBy(key).rowsBetween(0, Window.unboundedFollowing)
    return (
        seg.withColumn("__near", F.min("__hit").over(ahead))
        .join(following, "__seg")
        .withColumn(name, F.coalesce("__near", "__later"))
        .drop("__seg", "__hit", "__near", "__later")
    )
