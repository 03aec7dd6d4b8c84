"""SILVER: typed, newest version per id, upserted into run-month partitions."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.config import RunConfig
from siltstone.functions.names import label_last_page, label_stamp
from siltstone.functions.stamps import (
    month_start,
    parse_date,
    parse_instant,
    stamp_text_between,
    wall_clock,
)
from siltstone.operators.bounds import read_bound
from siltstone.operators.columns import rename_cast
from siltstone.operators.latest import latest_per_key, total_order
from siltstone.operators.merge import split_null_keys
from siltstone.schemas import PUBLICATION_FORMAT, RENAMES, SILVER_SCHEMA, STAMP_LENGTH
from siltstone.sources.listing import partition_values
from siltstone.sources.swaps import tracked_range
from siltstone.sources.tables import append_batch, compact, ensure_table, read_table, save_merged


def silver_start(cfg: RunConfig, ingested: DataFrame, batches: Sequence[str]) -> date:
    """Month start of silver's newest ingestion; of bronze's oldest batch when silver is empty.

    ``ingested`` is one row with the range of silver's ingestion times, ``batches`` are the stamps of bronze: both are
    metadata, no column is scanned for the bound.
    """
    newest = ingested.select(wall_clock("hi", cfg.zone).cast("date").alias("d"))
    start = read_bound(newest.select(month_start("d").alias("start")), "start")
    if start is not None:
        return start
    return date(int(batches[0][:4]), int(batches[0][4:6]), 1) if batches else cfg.default_start


def newest_first(df: DataFrame) -> list[Column]:
    """Batch stamp, then landing stamp and page end (one batch can hold a page twice), then
    publication time, then every other column, so the kept row never depends on timing.

    What follows the stamp in ``DTPROC`` numbers the micro-batches of one streamed load, which say nothing about age."""
    first = [
        F.left("DTPROC", F.lit(STAMP_LENGTH)).desc(),
        label_stamp("PAGE").desc(),
        label_last_page("PAGE").desc(),
        F.try_to_timestamp("data_publicacao", F.lit(PUBLICATION_FORMAT)).desc(),
    ]
    return total_order(df, first, ignore=["DTPROC", "id"])


def silver_rows(bronze: DataFrame, cfg: RunConfig, start: date) -> DataFrame:
    """The run's silver rows: batches from ``start`` to the run date, newest per id, typed."""
    df = bronze.filter(stamp_text_between("DTPROC", start, cfg.run_date))
    return typed_rows(latest_per_key(df, ["id"], newest_first(df)), cfg)


def typed_rows(df: DataFrame, cfg: RunConfig, *carry: str) -> DataFrame:
    """Bronze rows with the names and types of silver, and ``carry`` columns."""
    return df.select(
        month_start(parse_date("data_publicacao", PUBLICATION_FORMAT)).alias("referenceMonthDate"),
        "id",
        *rename_cast(df, RENAMES),
        parse_instant("data_publicacao", PUBLICATION_FORMAT, cfg.zone).alias("publicationDate"),
        F.lit(cfg.run_ts).alias("dateIngestion"),
        F.lit(cfg.period).alias("dt"),
        *carry,
    ).select(*SILVER_SCHEMA.names, *carry)


def batches_of(spark: SparkSession, bronze_name: str) -> list[str]:
    """Batch stamps of bronze, one per run, from the catalog's partitions."""
    rows = spark.sql(f"SHOW PARTITIONS {bronze_name}").collect()
    return sorted(r[0].partition("=")[2] for r in rows)


def save_silver(
    spark: SparkSession,
    cfg: RunConfig,
    bronze_name: str,
    name: str,
    path: str,
    reject_path: str | None = None,
    ledger_path: str | None = None,
) -> list[str]:
    """Upsert the run's rows on id; returns the partitions rewritten.

    The range starts at the month of silver's newest ingestion, or earlier at the day of the oldest
    batch that silver has not taken yet: a batch made up later under an old stamp is read, and
    with it all later ones, so that the newest row per id still wins. The batches taken are
    remembered beside the table (``ledger_path``), after the merge.

    Rows without an id never match and are added by each run, as in SQL MERGE. With
    ``reject_path`` every one of them goes there instead, under its batch stamp, once.
    """
    bronze = read_table(spark, bronze_name)
    silver = ensure_table(spark, name, path, SILVER_SCHEMA, "dt")
    batches = batches_of(spark, bronze_name)
    start = silver_start(cfg, tracked_range(silver, path, "dt", "dateIngestion"), batches)
    ledger_path = ledger_path or f"{path.rstrip('/')}_batches"
    taken = set(partition_values(spark, ledger_path, "DTPROC"))
    upto = f"{cfg.run_date:%Y%m%d}_999999"
    missing = [b for b in batches if b not in taken and b <= upto]
    if taken and missing:
        day = missing[0][:8]
        start = min(start, date(int(day[:4]), int(day[4:6]), int(day[6:])))
    if reject_path is not None:
        bronze, rejects = split_null_keys(bronze, ["id"])
        rejects = rejects.filter(stamp_text_between("DTPROC", start, cfg.run_date))
        append_batch(typed_rows(rejects, cfg, "DTPROC"), reject_path, "DTPROC")
    rows = silver_rows(bronze, cfg, start)
    # Newest per id: unique by construction.
    tracked = ["dateIngestion"]
    written = save_merged(rows, name, path, SILVER_SCHEMA, ["id"], own=[cfg.period], unique_source=True, tracked=tracked)
    compact(spark, name, path, "dt", written, least=cfg.small_files, keys=["id"], tracked=tracked)
    if missing:
        entries = spark.createDataFrame([(b, cfg.stamp) for b in missing], "DTPROC string, run string")
        append_batch(entries, ledger_path, "DTPROC")
    return written
