"""Day range of an incremental load."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions.stamps import month_start


def lower_bound(target_day: Column | None, source_day: Column) -> Column:
    """Month start of the target's newest day, or of the source's oldest when it has none."""
    day = source_day if target_day is None else F.coalesce(target_day, source_day)
    return month_start(day).cast("string")


def read_bound(frame: DataFrame, column: str) -> date | None:
    """The single value of a one-row frame, as a date."""
    value = frame.first()[column]
    return None if value is None else date.fromisoformat(str(value))


def lower_bound_frame(target_days: DataFrame | None, source_days: DataFrame) -> DataFrame:
    """The same from one-column frames of days, in one aggregate over both."""
    none = F.lit(None).cast("date")
    days = source_days.select(none.alias("__t"), F.col(source_days.columns[0]).alias("__s"))
    if target_days is not None:
        days = days.union(target_days.select(F.col(target_days.columns[0]), none))
    return days.agg(F.max("__t").alias("__t"), F.min("__s").alias("__s")).select(
        lower_bound(F.col("__t"), F.col("__s")).alias("lower_bound")
    )
