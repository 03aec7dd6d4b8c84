"""Upserts over the events table: days up to 15 January are the target, days from 11 January on
the source, so that both together hold every row and five days meet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.operators.latest import latest_per_key
from siltstone.operators.merge import merge_upsert, split_null_keys
from siltstone.queries.registry import query, table

_IN_TARGET = "ts < TIMESTAMP_NTZ '2024-01-16'"
_IN_SOURCE = "ts >= TIMESTAMP_NTZ '2024-01-11'"
_NEWEST = "row_number() OVER (PARTITION BY {key} ORDER BY ts DESC, event_id DESC) = 1"


def _sides(events: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    order: list[Column] = [F.col("ts").desc(), F.col("event_id").desc()]
    return (
        latest_per_key(events.filter(_IN_TARGET), keys, order),
        latest_per_key(events.filter(_IN_SOURCE), keys, order),
    )


def _cte(columns: str, key: str) -> str:
    newest = _NEWEST.format(key=key)
    return f"""
  WITH e AS (SELECT {columns}, ts FROM events),
       old AS (SELECT * FROM e WHERE ts < TIMESTAMP '2024-01-16' QUALIFY {newest}),
       new AS (SELECT * FROM e WHERE ts >= TIMESTAMP '2024-01-11' QUALIFY {newest})
"""


@query(_cte("user_id, event_id, event_type, props", "user_id") + """
  SELECT user_id, event_id, event_type, props FROM new
  UNION ALL
  SELECT user_id, event_id, event_type, props FROM old
  WHERE user_id NOT IN (SELECT user_id FROM new)
""")
def upsert_on_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matched rows are updated, others inserted or kept."""
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "props", "ts")
    target, source = _sides(events, ["user_id"])
    return merge_upsert(target, source, ["user_id"], unique_target=True).drop("ts")


@query(_cte("user_id, event_id, event_type, strftime(ts, '%Y%m%d') AS dt", "user_id, dt") + """
  SELECT user_id, event_id, event_type, dt FROM new
  UNION ALL
  SELECT user_id, event_id, event_type, dt FROM old
  WHERE NOT EXISTS (SELECT 1 FROM new WHERE new.user_id = old.user_id AND new.dt = old.dt)
""")
def upsert_on_key_dt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upsert on a composite key."""
    dt = F.date_format("ts", "yyyyMMdd").alias("dt")
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", dt, "ts")
    target, source = _sides(events, ["user_id", "dt"])
    return merge_upsert(target, source, ["user_id", "dt"], unique_target=True).drop("ts")


@query(_cte("user_id, event_id, event_type, props", "user_id") + """
  SELECT coalesce(new.user_id, old.user_id) AS user_id,
         coalesce(new.event_id, old.event_id) AS event_id,
         old.event_type AS event_type, new.props AS props
  FROM old FULL JOIN new ON old.user_id = new.user_id
""")
def upsert_evolving(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source lacks one target column and brings a new one."""
    events = table(spark, sf_dir, "events")
    target, source = _sides(events, ["user_id"])
    return merge_upsert(
        target.select("user_id", "event_id", "event_type"),
        source.select("user_id", "event_id", "props"),
        ["user_id"],
        unique_target=True,
    )


@query("""
  WITH e AS (SELECT CASE WHEN event_type <> 'error' THEN user_id END AS user_id, event_id, ts FROM events),
       old AS (SELECT * FROM e WHERE ts < TIMESTAMP '2024-01-16' AND user_id IS NOT NULL
               QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1),
       new AS (SELECT * FROM e WHERE ts >= TIMESTAMP '2024-01-11' AND user_id IS NOT NULL
               QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)
  SELECT user_id, event_id FROM new
  UNION ALL
  SELECT user_id, event_id FROM old WHERE user_id NOT IN (SELECT user_id FROM new)
  UNION ALL
  SELECT user_id, event_id FROM e WHERE user_id IS NULL AND ts < TIMESTAMP '2024-01-16'
  UNION ALL
  SELECT user_id, event_id FROM e WHERE user_id IS NULL AND ts >= TIMESTAMP '2024-01-11'
""")
def upsert_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without a key never match: target rows stay, source rows are added."""
    key = F.when(F.col("event_type") != "error", F.col("user_id")).alias("user_id")
    events = table(spark, sf_dir, "events").select(key, "event_id", "ts")
    complete, keyless = split_null_keys(events, ["user_id"])
    target, source = _sides(complete, ["user_id"])
    target = target.union(keyless.filter(_IN_TARGET))
    source = source.union(keyless.filter(_IN_SOURCE))
    return merge_upsert(target, source, ["user_id"], unique_target=True).drop("ts")


@query(_cte("user_id, event_id, event_type, props", "user_id") + """
  , every AS (SELECT user_id, event_id, event_type FROM e WHERE ts < TIMESTAMP '2024-01-16')
  SELECT t.user_id, coalesce(n.event_id, t.event_id) AS event_id,
         coalesce(n.event_type, t.event_type) AS event_type
  FROM every t LEFT JOIN new n ON t.user_id = n.user_id
  UNION ALL
  SELECT user_id, event_id, event_type FROM new WHERE user_id NOT IN (SELECT user_id FROM every)
""")
def upsert_repeated_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each of several target rows with one key is updated."""
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "ts")
    _, source = _sides(events, ["user_id"])
    target = events.filter(_IN_TARGET)
    merged = merge_upsert(
        target.drop("ts"), source.drop("ts"), ["user_id"], unique_target=False
    )
    return merged


@query("""
  SELECT event_id, event_type, event_type <> 'error' AS accepted FROM events
""")
def null_keys_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows split into those with a key and those without."""
    key = F.when(F.col("event_type") != "error", F.col("user_id")).alias("key")
    events = table(spark, sf_dir, "events").select("event_id", "event_type", key)
    kept, rejected = split_null_keys(events, ["key"])
    kept = kept.select("event_id", "event_type", F.lit(True).alias("accepted"))
    return kept.union(rejected.select("event_id", "event_type", F.lit(False)))
