"""Map columns to one string column per key, the keys being found in the data."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.functions.json_maps import json_map, map_value
from siltstone.operators.columns import map_columns, named, present


def json_columns_to_maps(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """Add ``<name>_dict`` for each wanted JSON text column the frame has."""
    return df.withColumns({f"{c}_dict": json_map(named(c)) for c in present(df, wanted)})


def _key_pairs(column: str) -> Column:
    """Array of (map column, key) of one row, empty when the map is null."""

    def pair(key: Column) -> Column:
        return F.struct(F.lit(column).alias("m"), key.alias("k"))

    keys = F.coalesce(F.map_keys(named(column)), F.array().cast("array<string>"))
    return F.transform(keys, pair)


def all_keys(df: DataFrame, columns: Sequence[str], max_keys: int | None = None) -> dict[str, list[str]]:
    """Every key of each map column. One scan of those columns; keys are merged per task.

    The keys become columns, so their number must be small: with ``max_keys`` more of them are an
    error rather than a cut.
    """
    if not columns:
        return {}
    pairs = [_key_pairs(c) for c in columns]
    tagged = F.concat(*pairs) if len(pairs) > 1 else pairs[0]
    found = df.select(F.explode(tagged).alias("e")).select("e.m", "e.k").distinct()
    rows = (found if max_keys is None else found.limit(max_keys + 1)).collect()
    if max_keys is not None and len(rows) > max_keys:
        raise ValueError(f"more than {max_keys} distinct keys in {list(columns)}")
    return {c: sorted(r.k for r in rows if r.m == c) for c in columns}


def greatest_keys(df: DataFrame, columns: Sequence[str]) -> dict[str, list[str]]:
    """The lexicographically greatest key list of each map column; keys outside it are lost."""
    if not columns:
        return {}
    row = df.agg(*[F.max(F.map_keys(named(c))).alias(c) for c in columns]).first()
    return {c: list(row[c] or []) for c in columns}


def key_names(
    taken: Sequence[str], keys: dict[str, list[str]], known: Mapping[tuple[str, str], str] | None = None
) -> list[tuple[str, str, str]]:
    """(map column, key, column name). A name already in use gets the map column as prefix.

    ``known`` holds the names of earlier runs by (map column, key): a key keeps its name, and no other
    key gets it.
    """
    known = known or {}
    in_any_case = {(c, k.lower()): (k, name) for (c, k), name in known.items()}
    used = {c.lower() for c in [*taken, *known.values()]}
    out = []
    for column, found in keys.items():
        for key in found:
            name, n = known.get((column, key)), 1
            if name is None:
                # Column names have no case; so a key in another case goes on in the same column.
                other, name = in_any_case.get((column, key.lower()), (None, None))
                name = None if other in found else name
            if name is None:
                name = key
                while not name or name.lower() in used:
                    name = f"{column}_{key}" if n == 1 else f"{column}_{key}_{n}"
                    n += 1
                used.add(name.lower())
            out.append((column, key, name))
    return out


def _origin(column: str, key: str) -> dict[str, str]:
    """Column metadata that says which key of which map the column holds."""
    return {"comment": json.dumps({"map": column, "key": key})}


def known_names(schema: T.StructType) -> dict[tuple[str, str], str]:
    """Names that earlier runs gave, from the comments of a table's columns."""
    out = {}
    for field in schema:
        comment = (field.metadata or {}).get("comment", "")
        if comment.startswith('{"map": '):
            origin = json.loads(comment)
            out[origin["map"], origin["key"]] = field.name
    return out


def map_pivot(
    df: DataFrame,
    fixed: Sequence[str],
    mode: str = "all_keys",
    columns: Sequence[str] | None = None,
    max_keys: int | None = None,
    known: Mapping[tuple[str, str], str] | None = None,
) -> DataFrame:
    """``fixed`` columns plus one string column per key of every map column.

    A new column's comment says its map and key; ``known`` (see ``known_names``) brings back the names
    of earlier runs.
    """
    columns = map_columns(df) if columns is None else list(columns)
    if mode == "all_keys":
        keys = all_keys(df, columns, max_keys)
    elif mode == "greatest_keys":
        keys = greatest_keys(df, columns)
    else:
        raise ValueError(f"unknown mode {mode!r}")
    dynamic = [
        map_value(named(c), k).alias(n, metadata=_origin(c, k)) for c, k, n in key_names(fixed, keys, known)
    ]
    return df.select(*map(named, fixed), *dynamic)
