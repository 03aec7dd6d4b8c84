"""GOLD: silver columns plus one column per JSON key, upserted per run month."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.config import RunConfig
from siltstone.functions.stamps import instant_day_between, month_start, wall_clock
from siltstone.operators.bounds import read_bound
from siltstone.operators.map_pivot import json_columns_to_maps, known_names, map_pivot
from siltstone.schemas import GOLD_BASE_SCHEMA
from siltstone.sources.swaps import tracked_range
from siltstone.sources.tables import compact, ensure_table, read_table, save_merged, table_path


def gold_start(cfg: RunConfig, gold: DataFrame, silver: DataFrame) -> date:
    """Month start of gold's newest ingestion, of silver's oldest when gold is empty.

    Both come as one row with the range of a table's ingestion times, which its summaries hold.
    """
    for frame, pick in ((gold, "hi"), (silver, "lo")):
        day = frame.select(wall_clock(pick, cfg.zone).cast("date").alias("d"))
        start = read_bound(day.select(month_start("d").alias("start")), "start")
        if start is not None:
            return start
    return cfg.default_start


def silver_range(silver: DataFrame, cfg: RunConfig, start: date) -> DataFrame:
    """Silver rows ingested from ``start`` to the run date.

    Partition and ingestion time come from one run clock, so the day range implies a month
    range, which prunes partitions.
    """
    months = F.col("dt").between(start.strftime("%Y%m"), cfg.period)
    return silver.filter(
        months & instant_day_between("dateIngestion", start, cfg.run_date, cfg.zone)
    )


def gold_rows(
    silver: DataFrame,
    cfg: RunConfig,
    json_columns: Sequence[str] = ("images",),
    mode: str = "all_keys",
    max_keys: int | None = None,
    table: T.StructType | None = None,
) -> DataFrame:
    """Silver rows stamped with the run, JSON columns flattened under the names that ``table`` has."""
    stamped = silver.withColumns(
        {"dateIngestion": F.lit(cfg.run_ts), "dt": F.lit(cfg.period)}
    )
    maps = json_columns_to_maps(stamped, json_columns)
    known = known_names(table) if table is not None else None
    return map_pivot(maps, GOLD_BASE_SCHEMA.names, mode, max_keys=max_keys, known=known)


def save_gold(
    spark: SparkSession,
    cfg: RunConfig,
    silver_name: str,
    name: str,
    path: str,
    json_columns: Sequence[str] = ("images",),
    mode: str = "all_keys",
    max_keys: int | None = None,
) -> list[str]:
    """Upsert the run's rows on (id, dt); only the run's own partition is rewritten.

    A key keeps the column of its first run, whatever other keys a later run finds.
    """
    silver = read_table(spark, silver_name)
    gold = ensure_table(spark, name, path, GOLD_BASE_SCHEMA, "dt")
    ingested = tracked_range(gold, path, "dt", "dateIngestion")
    source = tracked_range(silver, table_path(spark, silver_name), "dt", "dateIngestion")
    chosen = silver_range(silver, cfg, gold_start(cfg, ingested, source))
    rows = gold_rows(chosen, cfg, json_columns, mode, max_keys, gold.schema)
    keys, tracked = ["id", "dt"], ["dateIngestion"]
    written = save_merged(rows, name, path, GOLD_BASE_SCHEMA, keys, own=[cfg.period], tracked=tracked)
    compact(spark, name, path, "dt", written, least=cfg.small_files, keys=keys, tracked=tracked)
    return written
