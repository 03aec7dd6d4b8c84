"""JSON text as map<string,string>."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

TEXT_MAP = T.MapType(T.StringType(), T.StringType())


def json_map(text: Column | str) -> Column:
    """JSON object text to a map; null for null or malformed text, nested values stay text."""
    return F.from_json(text, TEXT_MAP)


def map_value(m: Column | str, key: str) -> Column:
    """Value of a key of any spelling, null when the row lacks it."""
    m = F.col(m) if isinstance(m, str) else m
    return F.try_element_at(m, F.lit(key))
