"""Dates, timestamps and run stamps as Column expressions."""

from __future__ import annotations

from datetime import date, datetime, time, timedelta
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

from siltstone.schemas import STAMP_FORMAT


def parse_date(text: Column | str, fmt: str) -> Column:
    """Text to date; null when the text does not match, also under ANSI mode."""
    return F.try_to_timestamp(text, F.lit(fmt)).cast("date")


def parse_timestamp(text: Column | str, fmt: str) -> Column:
    """Text to timestamp on the session clock; null when the text does not match."""
    return F.try_to_timestamp(text, F.lit(fmt))


def parse_instant(text: Column | str, fmt: str, zone: str) -> Column:
    """Wall-clock text of ``zone`` to the instant it names, whatever the session zone is."""
    text = F.col(text) if isinstance(text, str) else text
    return F.try_to_timestamp(F.concat(text, F.lit(" " + zone)), F.lit(fmt + " VV"))


def month_start(day: Column | str) -> Column:
    return F.trunc(day, "MM")


def wall_clock(ts: Column | str, zone: str) -> Column:
    """Instant to the local date and time of ``zone`` (timestamp without zone)."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.convert_timezone(None, F.lit(zone), ts.cast("timestamp_ntz"))


def utc_wall_clock(ts: Column | str, zone: str) -> Column:
    """A zone-less UTC time to the local date and time of ``zone``."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), ts)


def run_stamp(local_ts: Column | str) -> Column:
    """``yyyyMMdd_HHmmss`` of a local time."""
    return F.date_format(local_ts, STAMP_FORMAT)


def iso_stamp(local_ts: Column | str) -> Column:
    """``yyyy-MM-ddTHH:mm:ss`` of a local time."""
    return F.date_format(local_ts, "yyyy-MM-dd'T'HH:mm:ss")


def current_run_stamp(zone: str) -> Column:
    """Stamp of now; constant within a query, and within a micro-batch also on replay."""
    return run_stamp(wall_clock(F.current_timestamp(), zone))


def shift_hours(ts: Column | str, hours: int) -> Column:
    ts = F.col(ts) if isinstance(ts, str) else ts
    return ts + F.make_dt_interval(hours=F.lit(hours))


def period_of(day: Column | str) -> Column:
    """``yyyyMM`` of a date, by removing the dashes of its text form."""
    day = F.col(day) if isinstance(day, str) else day
    return F.left(F.replace(day.cast("string"), F.lit("-"), F.lit("")), F.lit(6))


def stamp_day(stamp: Column | str) -> Column:
    """The day in a ``yyyyMMdd_HHmmss`` stamp; null when malformed."""
    return parse_date(F.substring(stamp, 1, 8), "yyyyMMdd")


def stamp_day_between(stamp: Column | str, start: date, end: date) -> Column:
    """Inclusive day range on a text stamp, tolerant of malformed stamps. Not pushed down."""
    return stamp_day(stamp).between(F.lit(start), F.lit(end))


def stamp_text_between(stamp: Column | str, start: date, end: date) -> Column:
    """Same range as a text range on the bare column.

    Reaches the Parquet scan as a pushed filter, or prunes when the stamp is the partition.
    """
    stamp = F.col(stamp) if isinstance(stamp, str) else stamp
    after = end + timedelta(days=1)
    return (stamp >= start.strftime("%Y%m%d")) & (stamp < after.strftime("%Y%m%d"))


def instant_day_between(ts: Column | str, start: date, end: date, zone: str) -> Column:
    """Inclusive range of ``zone`` days on an instant, as bounds on the bare column."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    tz = ZoneInfo(zone)
    first = datetime.combine(start, time(), tz)
    after = datetime.combine(end + timedelta(days=1), time(), tz)
    return (ts >= F.lit(first)) & (ts < F.lit(after))


def local_day_between(ts: Column | str, start: date, end: date) -> Column:
    """Inclusive day range on a zone-less timestamp, as bounds on the bare column."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    after = end + timedelta(days=1)
    return (ts >= F.lit(start.isoformat()).cast("timestamp_ntz")) & (
        ts < F.lit(after.isoformat()).cast("timestamp_ntz")
    )
