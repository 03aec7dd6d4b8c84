"""Newest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep the first row per key under ``order``.

    Spark plans this with a group limit below the shuffle: each task sends at most one row
    per key, so a key holding a third of all rows costs one row per task.
    Rows with a null key form one group, as in SQL. ``order`` should be total (see
    ``total_order``), otherwise the kept row depends on task timing.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rank", F.row_number().over(w)).filter("__rank = 1").drop("__rank")


def total_order(df: DataFrame, first: Sequence[Column], ignore: Sequence[str] = ()) -> list[Column]:
    """``first`` followed by every other column, so that only equal rows can tie."""
    return [*first, *[F.col(f"`{c}`").desc() for c in df.columns if c not in ignore]]
