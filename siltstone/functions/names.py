"""Folder names, page labels and paths as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def folder_name(prefix: str, first: Column | str, last: Column | str, stamp: Column) -> Column:
    """``<prefix>_<first>_to_<last>_<yyyyMMdd_HHmmss>``"""
    return F.concat_ws(
        "_", F.lit(prefix), _col(first).cast("string"), F.lit("to"), _col(last).cast("string"), stamp
    )


def page_label(first: Column | str, last: Column | str, stamp: Column) -> Column:
    """``<first> - to - <last> - <yyyyMMdd_HHmmss>``"""
    return F.format_string("%d - to - %d - %s", _col(first), _col(last), stamp)


def folder_first_page(folder: Column | str) -> Column:
    return F.split_part(_col(folder), F.lit("_"), F.lit(2)).try_cast("bigint")


def folder_last_page(folder: Column | str) -> Column:
    """Field 3, counted from 0, of the folder name; null when it is not a number."""
    return F.split_part(_col(folder), F.lit("_"), F.lit(4)).try_cast("bigint")


def label_last_page(label: Column | str) -> Column:
    return F.split_part(_col(label), F.lit(" - "), F.lit(3)).try_cast("bigint")


def label_stamp(label: Column | str) -> Column:
    return F.split_part(_col(label), F.lit(" - "), F.lit(4))


def label_folder(prefix: str, label: Column | str) -> Column:
    """The folder a page label belongs to."""
    label = _col(label)
    return folder_name(
        prefix,
        F.split_part(label, F.lit(" - "), F.lit(1)),
        F.split_part(label, F.lit(" - "), F.lit(3)),
        label_stamp(label),
    )


def path_folder(path: Column | str) -> Column:
    """Folder holding a file, without a ``folder=`` prefix."""
    return F.regexp_replace(F.split_part(_col(path), F.lit("/"), F.lit(-2)), "^folder=", "")


def path_period(path: Column | str) -> Column:
    """Period folder two levels above a file, without a ``period=`` prefix."""
    return F.regexp_replace(F.split_part(_col(path), F.lit("/"), F.lit(-3)), "^period=", "")
