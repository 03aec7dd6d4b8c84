"""Named queries over the given tables, each with its SQL statement where SQL can say it."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from siltstone.sources.tables import create_database

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name."""

    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def new_database(spark: SparkSession, location: str) -> str:
    """A database of its own for one query, placed in the query's folder."""
    name = f"silt_{uuid.uuid4().hex[:10]}"
    create_database(spark, name, f"{location}/warehouse")
    return name


def drop_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP DATABASE {name} CASCADE")
