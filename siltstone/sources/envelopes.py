"""Landed API pages: read by executors, flattened to records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.schemas import CORRUPT, RECORD_SCHEMA, envelope_schema

ITEM_TEXT = T.StringType()


def read_envelopes(
    spark: SparkSession,
    path: str | Sequence[str],
    record: T.DataType = RECORD_SCHEMA,
    multi_line: bool = False,
) -> DataFrame:
    """One row per page. Without ``multi_line`` a file holds one page per line and splits.

    A page that is not JSON, or has a field of another type than declared, has its text in
    ``CORRUPT``.
    """
    reader = spark.read.schema(envelope_schema(record)).option("columnNameOfCorruptRecord", CORRUPT)
    return reader.json(path, multiLine=multi_line)


def read_pages(spark: SparkSession, path: str | Sequence[str], multi_line: bool = False) -> DataFrame:
    """One row per page with its ``items`` as the texts they came as, whatever fields they have.

    Next to them stand their number, the names of their fields, each once, and in ``bad`` the text of a page that is no
    envelope, does not say its number, or has an item that is no object.
    """
    pages = read_envelopes(spark, path, ITEM_TEXT, multi_line)
    item = F.coalesce("items", F.array())
    wrong = F.exists(item, lambda i: i.isNotNull() & F.json_object_keys(i).isNull())
    bad = F.col(CORRUPT).isNotNull() | F.col("page").isNull() | wrong
    names = F.array_distinct(F.flatten(F.transform(item, lambda i: F.coalesce(F.json_object_keys(i), F.array()))))
    return pages.select(
        "page", "totalPages", "items", F.array_size(item).cast("long").alias("n_items"), names.alias("fields"),
        F.when(bad, F.coalesce(F.col(CORRUPT), F.to_json(F.struct("page", "totalPages", "items")))).alias("bad"))


def flatten_items(envelopes: DataFrame, *carry: str) -> DataFrame:
    """One row per record: page, position in the page, ``carry`` columns, record fields."""
    exploded = envelopes.select("page", *carry, F.posexplode("items").alias("pos", "item"))
    return exploded.select("page", "pos", *carry, "item.*")


def parse_records(
    df: DataFrame, text: str, schema: T.StructType = RECORD_SCHEMA, corrupt: str | None = None
) -> DataFrame:
    """Records from JSON text under a declared schema, next to the frame's other columns.

    With ``corrupt`` a text that does not parse as declared is kept in a column of that name.
    """
    options = {}
    if corrupt is not None:
        schema = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])
        options["columnNameOfCorruptRecord"] = corrupt
    parsed = df.withColumn("__record", F.from_json(text, schema, options))
    return parsed.select(*[c for c in df.columns if c != text], "__record.*")
