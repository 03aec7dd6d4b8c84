"""JSON text, maps and the map pivot."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions.json_maps import json_map, map_value
from siltstone.operators.map_pivot import json_columns_to_maps, map_pivot
from siltstone.queries.feed import image_json
from siltstone.queries.registry import query, table


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    one_key = F.concat(F.lit('{"'), "event_type", F.lit('": "'), "event_id", F.lit('"}'))
    return events.select("event_id", "event_type", "props", one_key.alias("images"))


@query("SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def json_to_map_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON text to map, one key looked up."""
    events = table(spark, sf_dir, "events")
    return events.select("event_id", map_value(json_map("props"), "k").alias("k"))


@query("""
  SELECT event_id, CASE WHEN event_type <> 'error' THEN json_extract_string(props, '$.k') END AS k,
         event_type = 'error' AS is_null_map
  FROM events
""")
def malformed_json_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Malformed JSON text gives a null map."""
    text = F.when(F.col("event_type") == "error", F.expr("substring(props, 2)")).otherwise(
        F.col("props")
    )
    events = table(spark, sf_dir, "events").select("event_id", json_map(text).alias("m"))
    return events.select(
        "event_id", map_value("m", "k").alias("k"), F.col("m").isNull().alias("is_null_map")
    )


@query("""
  SELECT event_id, event_type AS map_key FROM events
  UNION ALL SELECT event_id, 'k' AS map_key FROM events
""")
def map_keys_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per key of each map."""
    events = table(spark, sf_dir, "events").select("event_id", json_map(image_json()).alias("m"))
    return events.select("event_id", F.explode(F.map_keys("m")).alias("map_key"))


@query("SELECT max([event_type, 'k'])[1] || ',' || max([event_type, 'k'])[2] AS key_list FROM events")
def greatest_key_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lexicographically greatest key list."""
    events = table(spark, sf_dir, "events").select(json_map(image_json()).alias("m"))
    return events.agg(F.concat_ws(",", F.max(F.map_keys("m"))).alias("key_list"))


def _case(kind: str) -> str:
    return f"CASE WHEN event_type = '{kind}' THEN CAST(event_id AS VARCHAR) END AS \"{kind}\""


_KINDS = ", ".join(_case(k) for k in ("click", "error", "purchase", "signup", "view"))


@query(f"SELECT event_id, {_KINDS} FROM events")
def map_pivot_all_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One column per key found anywhere in the data."""
    events = json_columns_to_maps(_events(spark, sf_dir), ["images"])
    return map_pivot(events, ["event_id"])


@query(f"SELECT event_id, {_case('view')} FROM events")
def map_pivot_greatest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the keys of the greatest key list."""
    events = json_columns_to_maps(_events(spark, sf_dir), ["images"])
    return map_pivot(events, ["event_id"], mode="greatest_keys")


@query(f"""
  SELECT event_id, json_extract_string(props, '$.k') AS k, {_KINDS} FROM events
""")
def map_pivot_two_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All listed JSON columns are flattened; a listed column the frame lacks is skipped."""
    events = json_columns_to_maps(_events(spark, sf_dir), ["images", "props", "no_such_column"])
    return map_pivot(events, ["event_id"])


@query("""
  SELECT event_type AS k, event_id, json_extract_string(props, '$.k') AS props_dict_k FROM events
""")
def map_pivot_name_taken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A key equal to a fixed column gets its map column as prefix."""
    events = table(spark, sf_dir, "events").withColumnRenamed("event_type", "k")
    return map_pivot(json_columns_to_maps(events, ["props"]), ["k", "event_id"])
