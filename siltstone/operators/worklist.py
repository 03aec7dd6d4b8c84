"""Set operations on folder names: what is new, what differs, and fixed-size chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.functions.names import folder_first_page
from siltstone.operators.segments import floor_div, volume_row_number


def _presence(left: DataFrame, right: DataFrame, name: str) -> DataFrame:
    """Each distinct name once, with a flag per side. One shuffle, pre-aggregated by task."""
    tagged = left.select(name, F.lit(True).alias("in_left"), F.lit(False).alias("in_right")).union(
        right.select(name, F.lit(False), F.lit(True))
    )
    return tagged.groupBy(name).agg(
        F.bool_or("in_left").alias("in_left"), F.bool_or("in_right").alias("in_right")
    )


def symmetric_difference(left: DataFrame, right: DataFrame, name: str) -> DataFrame:
    """Distinct names on exactly one side, with the side."""
    return _presence(left, right, name).filter("in_left != in_right")


def unprocessed(landed: DataFrame, processed: DataFrame, name: str) -> DataFrame:
    """Distinct landed names that were not processed yet; all of them without history."""
    return _presence(landed, processed, name).filter("in_left and not in_right").select(name)


def folder_state(landed: DataFrame, processed: DataFrame, name: str) -> DataFrame:
    """Distinct landed names with ``processed`` 0 or 1."""
    state = _presence(landed, processed, name).filter("in_left")
    return state.select(name, F.col("in_right").cast("int").alias("processed"))


def chunk_folders(folders: DataFrame, size: int = 10) -> DataFrame:
    """Number the folders by first page and name, and cut the list into chunks of ``size``.

    Names without a page number come first. Tasks get ranges of about as many folders, wherever their pages lie.
    """
    order = [folder_first_page("folder"), F.col("folder")]
    numbered = volume_row_number(folders, order, "__n")
    return numbered.withColumn("chunk", floor_div(F.col("__n") - 1, size)).drop("__n")
