"""BRONZE: unprocessed JSON folders appended with their batch stamp."""

from __future__ import annotations

import json
from collections.abc import Iterable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.config import RunConfig
from siltstone.functions.names import label_folder
from siltstone.operators.segments import floor_div
from siltstone.operators.worklist import chunk_folders, folder_state
from siltstone.schemas import BRONZE_SCHEMA, LEDGER_SCHEMA, STAMP_LENGTH, UNFIT
from siltstone.scratch import materialize
from siltstone.sources.fields import noted_fields, record_columns, row_schema
from siltstone.sources.json_folders import list_folders, period_lines
from siltstone.sources.listing import child_names, make_folder, partition_values, read_text, remove_path, write_text
from siltstone.sources.swaps import partitions_of
from siltstone.sources.tables import add_columns, append_batch, compact, ensure_table, read_path, refresh_partitions

#: A run appends its loads in at most so many writes; of more loads, several are written at once.
APPENDS = 64


def processed_folders(
    spark: SparkSession, cfg: RunConfig, ledger_path: str, bronze_path: str, period: str
) -> DataFrame:
    """Folders of the ledger, and of batches appended by a run lost before its ledger entry.

    Ledger and bronze both have one partition per batch stamp, so two listings show which
    batches the ledger lacks; only those are looked into.
    """
    known = partition_values(spark, ledger_path, "DTPROC")
    folders = spark.createDataFrame([], "folder string")
    if known:
        ledger = read_path(spark, ledger_path, LEDGER_SCHEMA)
        folders = ledger.filter(F.col("period") == period).select("folder")
    batches = partitions_of(spark, bronze_path, "DTPROC")
    lost = sorted(set(batches) - set(known))
    if lost:
        paths = [f"{bronze_path}/{batches[stamp]}" for stamp in lost]
        labels = spark.read.schema(BRONZE_SCHEMA).parquet(*paths).select("PAGE").distinct()
        folders = folders.union(labels.filter("PAGE IS NOT NULL").select(label_folder(cfg.folder_prefix, "PAGE")))
    return folders


def batch_stamps(cfg: RunConfig, used: Iterable[str], count: int) -> list[str]:
    """The run's stamp and the next seconds no batch has: a batch never shares its partition."""
    taken, ts, stamps = set(used), cfg.local_ts, []
    while len(stamps) < count:
        stamp = ts.strftime("%Y%m%d_%H%M%S")
        if stamp not in taken:
            stamps.append(stamp)
        ts += timedelta(seconds=1)
    return stamps


def undo_open_appends(spark: SparkSession, bronze_path: str) -> None:
    """Remove what a run lost while it appended several loads has left of them; their folders are pending again.

    The loads of one append take their places one by one and in no order, so later pages could stand under an older stamp
    than earlier ones. None of them is in the ledger or registered yet.
    """
    notes = f"{bronze_path.rstrip('/')}_open"
    for note in (n for n in child_names(spark, notes) if not n.startswith(".")):
        for stamp in json.loads(read_text(spark, f"{notes}/{note}")):
            remove_path(spark, f"{bronze_path}/DTPROC={stamp}")
        remove_path(spark, f"{notes}/{note}")


def bronze_run(
    spark: SparkSession,
    cfg: RunConfig,
    raw_root: str,
    bronze_path: str,
    ledger_path: str,
    name: str,
    period: str | None = None,
    schema: T.StructType | None = None,
    folders_per_load: int | None = None,
) -> int:
    """Append every unprocessed folder of ``period``; returns their number.

    The folder is a partition column of the raw files, so folders already processed are
    pruned by the semi join (dynamic partition pruning) and not read.

    One load takes them all, or with ``folders_per_load`` so many at a time, the first pages first. A load is a batch of its
    own: its rows are appended under its stamp, then its folders are entered in the ledger. So a failed load leaves
    its folders pending, and a run lost among several repeats none that had been written. Of more than ``APPENDS`` loads
    several are written at once: a run lost meanwhile leaves those pending.

    Fields that the table lacks are added to it; without ``schema`` they are those noted by the landing. Values that fit no
    column are kept in ``UNFIT``.
    """
    schema = row_schema(spark, noted_fields(spark, raw_root)) if schema is None else schema
    period = period or cfg.period
    table_schema = T.StructType([*schema.fields, BRONZE_SCHEMA[UNFIT], BRONZE_SCHEMA["DTPROC"]])
    table = ensure_table(spark, name, bronze_path, table_schema, "DTPROC")
    have = {c.lower() for c in table.columns}
    add_columns(spark, name, [f for f in table_schema if f.name.lower() not in have])
    undo_open_appends(spark, bronze_path)
    landed = list_folders(spark, raw_root, period).select("folder")
    processed = processed_folders(spark, cfg, ledger_path, bronze_path, period)
    state = materialize(folder_state(landed, processed, "folder"), "folders")
    pending = state.filter("processed = 0").select("folder")
    total, count = state.agg(F.count(F.lit(1)), F.count_if(F.col("processed") == 0)).first()
    loads = 1 if count else 0
    if folders_per_load is not None and count > folders_per_load:
        loads = -(-count // folders_per_load)
    used = partitions_of(spark, bronze_path, "DTPROC")
    # Batches of a run lost before it registered them.
    unknown = set(used) - set(partition_values(spark, ledger_path, "DTPROC"))
    refresh_partitions(
        spark, name, "DTPROC", sorted(s for s in unknown if len(s) == STAMP_LENGTH and used[s] == f"DTPROC={s}"))
    stamps = batch_stamps(cfg, used, loads)
    if loads == 1:
        lines = period_lines(spark, raw_root, period)
        if count != total:
            lines = lines.join(pending, "folder", "left_semi")
        rows = record_columns(spark, lines, schema).withColumn("DTPROC", F.lit(stamps[0]))
        _append(spark, rows, pending.withColumn("DTPROC", F.lit(stamps[0])), period, stamps, name, bronze_path, ledger_path)
    elif loads:
        at_once = -(-loads // APPENDS)
        of_load = spark.createDataFrame(list(enumerate(stamps)), "chunk bigint, DTPROC string")
        pending = chunk_folders(pending, folders_per_load).join(F.broadcast(of_load), "chunk")
        pending = materialize(pending.withColumn("__append", floor_div(F.col("chunk"), at_once)).drop("chunk"), "loads")
        # The period is read and parsed once, its rows stored by append, which then reads only its own files.
        lines = period_lines(spark, raw_root, period).join(pending, "folder")
        staged = materialize(record_columns(spark, lines, schema, "DTPROC", "__append"), "staged", split_by="__append")
        for n, first in enumerate(range(0, loads, at_once)):
            rows = staged.filter(F.col("__append") == n).drop("__append")
            entry = pending.filter(F.col("__append") == n)
            some = stamps[first:first + at_once]
            _append(spark, rows, entry, period, some, name, bronze_path, ledger_path)
    compact(spark, name, bronze_path, "DTPROC", stamps, least=cfg.small_files)
    return count


def _append(
    spark: SparkSession, rows: DataFrame, folders: DataFrame, period: str, stamps: list[str],
    name: str, bronze_path: str, ledger_path: str,
) -> None:
    """Append the loads of ``stamps``: their rows, then their ``folders`` to the ledger; both have their load's ``DTPROC``."""
    note = f"{bronze_path.rstrip('/')}_open"
    if len(stamps) > 1:
        rows = rows.hint("rebalance", "DTPROC")
        # An entry is a small file of its own for each load.
        folders = folders.repartition(spark.sparkContext.defaultParallelism, "DTPROC")
        make_folder(spark, note)
        write_text(spark, f"{note}/{stamps[0]}", json.dumps(stamps))
    append_batch(rows, bronze_path, "DTPROC")
    if len(stamps) > 1:
        remove_path(spark, f"{note}/{stamps[0]}")
    refresh_partitions(spark, name, "DTPROC", stamps)
    append_batch(folders.select("folder", F.lit(period).alias("period"), "DTPROC"), ledger_path, "DTPROC")
