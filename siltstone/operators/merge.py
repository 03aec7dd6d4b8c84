"""Upsert as joins and a union: matched rows take the source, other rows are kept or added."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.operators.columns import named, spelled_as


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    evolve: bool = True,
    unique_target: bool = False,
) -> DataFrame:
    """Rows of ``target`` after merging ``source`` on ``keys``.

    Null keys never match, so such source rows are added and such target rows kept. Column names
    are compared as the session does, and the target's spelling stays.
    With ``evolve``, source-only columns are added; target-only columns keep their value on
    update and are null on insert. ``source`` must be unique on non-null keys.

    Each of several target rows with one key is updated. Where the caller knows that the target's
    keys are unique, ``unique_target`` allows a plan that reads the target once: only key columns of
    the source meet it, in an anti join. For a small batch Catalyst broadcasts those keys and the
    target is not shuffled; for a large one AQE can split a skewed target partition, which a
    full outer join would not allow.
    """
    keys = list(keys)
    source = spelled_as(source, target.columns)
    kept = [c for c in target.columns if c not in source.columns]
    added = [c for c in source.columns if c not in target.columns]
    if not evolve:
        if kept:
            raise ValueError(f"source lacks the target columns {kept}")
        source, added = source.drop(*added), []

    # An anti join keeps rows whose key is null, and an outer join from the source keeps its own.
    source_keys = source.select(*map(named, keys))
    if unique_target:
        untouched = target.join(source_keys, keys, "left_anti")
        fresh = source
        if kept:
            fresh = fresh.join(target.select(*map(named, keys + kept)), keys, "left_outer")
    else:
        renamed = source.select(
            *map(named, keys),
            *[named(c).alias(f"__new_{c}") for c in source.columns if c not in keys],
            F.lit(True).alias("__hit"),
        )
        joined = target.join(renamed, keys, "left_outer")
        values = [
            (
                F.when(F.col("__hit"), named(f"__new_{c}")).otherwise(named(c)).alias(c)
                if c in source.columns and c not in keys
                else named(c)
            )
            for c in target.columns
        ]
        untouched = joined.select(*values, *[named(f"__new_{c}").alias(c) for c in added])
        fresh = source.join(target.select(*map(named, keys)), keys, "left_anti")

    merged = untouched.unionByName(fresh, allowMissingColumns=True)
    return merged.select(*map(named, target.columns + added))


def split_null_keys(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows whose keys are all set, the others)"""
    complete = F.lit(True)
    for key in keys:
        complete = complete & named(key).isNotNull()
    return df.filter(complete), df.filter(~complete)


def require_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise when two rows share a non-null key, as a merge would be ambiguous."""
    complete, _ = split_null_keys(df, keys)
    twice = complete.groupBy(*map(named, keys)).count().filter("count > 1").take(1)
    if twice:
        raise ValueError(f"merge source has more than one row for {twice[0].asDict()}")
