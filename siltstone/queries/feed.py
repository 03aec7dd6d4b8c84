"""The events table seen as a paged news feed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.queries.registry import table
from siltstone.schemas import PUBLICATION_FORMAT, RECORD_FIELDS

ITEMS_PER_PAGE = 100


def image_json() -> F.Column:
    """JSON text with a key named after the event type and the key of ``props``."""
    return F.concat(
        F.lit('{"'), "event_type", F.lit('": '), "event_id", F.lit(", "), F.expr("substring(props, 2)")
    )


def feed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source records with their page: 100 events per page, id = user."""
    text = F.col("event_id").cast("string")
    return table(spark, sf_dir, "events").select(
        (F.floor(F.col("event_id") / ITEMS_PER_PAGE) + 1).cast("long").alias("page"),
        F.col("user_id").alias("id"),
        F.date_format("ts", PUBLICATION_FORMAT).alias("data_publicacao"),
        F.col("event_type").alias("destaque"),
        F.col("props").alias("editorias"),
        image_json().alias("imagens"),
        F.concat_ws(" ", "event_type", F.lit("by"), "user_id").alias("introducao"),
        F.concat(F.lit("https://feed.example/items/"), text).alias("link"),
        text.alias("produto_id"),
        F.col("event_type").alias("produtos"),
        F.lit(None).cast("string").alias("produtos_relacionados"),
        F.col("event_type").alias("tipo"),
        F.concat(F.lit("event "), text).alias("titulo"),
    )


def envelopes(records: DataFrame, total_pages: int) -> DataFrame:
    """One row per page, as the API answers; a page holds a fixed number of items."""
    items = F.collect_list(F.struct(*RECORD_FIELDS)).alias("items")
    return records.groupBy("page").agg(items).withColumn("totalPages", F.lit(total_pages))


def last_page(records: DataFrame) -> int:
    return records.agg(F.max("page")).first()[0]


# The feed columns as SQL over events, for the oracle statements.
FEED_SQL = """
  SELECT event_id // 100 + 1 AS page, user_id AS id, date_trunc('second', ts) AS published,
         event_type, props, event_id,
         '{"' || event_type || '": ' || event_id || ', ' || substr(props, 2) AS imagens
  FROM events
"""
