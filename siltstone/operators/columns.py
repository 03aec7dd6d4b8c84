"""Projections from mappings, run-time column lists, and column choice by type or name."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def named(name: str) -> Column:
    """Column by its exact name, dots and blanks included."""
    return F.col(quoted(name))


def folded(df: DataFrame, name: str) -> str:
    """The name as the session compares it: lower-cased unless names are case-sensitive."""
    sensitive = df.sparkSession.conf.get("spark.sql.caseSensitive", "false") == "true"
    return name if sensitive else name.lower()


def spelled_as(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """``df`` with those columns that the session finds among ``names`` spelled as there."""
    spelling = {folded(df, n): n for n in names}
    return df.select(*[named(c).alias(spelling.get(folded(df, c), c)) for c in df.columns])


def rename_cast(df: DataFrame, mapping: Mapping[str, str], kind: str = "string") -> list[Column]:
    """Target columns of a source→target map. Nested values become JSON text, not display text."""
    out = []
    for source, target in mapping.items():
        value = named(source)
        nested = isinstance(df.schema[source].dataType, (T.StructType, T.ArrayType, T.MapType))
        value = F.to_json(value) if nested and kind == "string" else value.cast(kind)
        out.append(value.alias(target))
    return out


def map_columns(df: DataFrame) -> list[str]:
    """Names of the map-typed columns."""
    return [f.name for f in df.schema if isinstance(f.dataType, T.MapType)]


def present(df: DataFrame, wanted: Iterable[str]) -> list[str]:
    """The wanted names that the frame has."""
    have = {folded(df, c) for c in df.columns}
    return [c for c in wanted if folded(df, c) in have]


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` first, in order and type (null where absent), others behind."""
    df = spelled_as(df, schema.names)
    fixed = [
        (named(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema
    ]
    names = set(schema.names)
    return df.select(*fixed, *[named(c) for c in df.columns if c not in names])
