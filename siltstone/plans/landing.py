"""RAW: landed page envelopes to JSON folders, one per group of pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siltstone.config import RunConfig
from siltstone.functions.names import folder_name, page_label
from siltstone.operators.paging import page_slot, resume_page, slot_ranges
from siltstone.scratch import materialize
from siltstone.sources.envelopes import read_pages
from siltstone.sources.fields import note_fields
from siltstone.sources.json_folders import list_folders, newest_folders, write_lines
from siltstone.sources.listing import make_folder, partition_values
from siltstone.sources.tables import append_batch



def label_pages(pages: DataFrame, slots: DataFrame, cfg: RunConfig) -> DataFrame:
    """JSON lines of the items of closed page groups, with PAGE appended, and their period and folder.

    ``slots`` is one small row per group of pages. When it is a materialized table its size
    is known, and the join is a broadcast only below the session's threshold.
    """
    stamp = F.lit(cfg.stamp)
    labelled = pages.withColumn("slot", page_slot("page", cfg.pages_per_folder)).join(
        slots, "slot"
    )
    lines = labelled.select(
        page_label("first_page", "last_page", stamp).alias("label"),
        F.lit(cfg.period).alias("period"),
        folder_name(cfg.folder_prefix, "first_page", "last_page", stamp).alias("folder"),
        F.explode("items").alias("item"),
    )
    item = F.coalesce("item", F.lit("{}"))
    opened = F.when(item == "{}", F.lit("{")).otherwise(F.concat(F.expr("left(item, length(item) - 1)"), F.lit(",")))
    line = F.concat(opened, F.lit('"PAGE":"'), "label", F.lit('"}'))
    return lines.select(line.alias("value"), "period", "folder")


def raw_ingestion(
    spark: SparkSession,
    cfg: RunConfig,
    landing_path: str,
    raw_root: str,
    multi_line: bool = False,
    first_page: int = 1,
    reject_path: str | None = None,
) -> int:
    """Land the pages from the resume page on; returns that page.

    The last landed page is taken again, as it may have grown since. The pages are parsed once, only as
    envelopes: an item is landed as the text it came as, so every field in any case and of any type is kept, and the names of
    its fields are noted for bronze.

    A page that is no envelope, says no number or has an item that is no object is an error before anything is
    written; with ``reject_path`` its text goes there under the run's stamp instead.

    Folders are renamed one by one when a run commits, so a run lost in between may leave a gap. Each run
    therefore notes the pages of its folders before it writes, and a run that finds pages missing
    starts at the first of them.
    """
    resume = resume_page(newest_folders(spark, raw_root), first_page).first()["resume_page"]
    gap = first_gap(spark, raw_root, cfg.folder_prefix)
    resume = resume if gap is None else min(resume, gap)
    items = F.when(F.col("page") >= resume, F.col("items")).alias("items")
    pages = read_pages(spark, landing_path, multi_line).select("page", "totalPages", items, "n_items", "fields", "bad")
    pages = materialize(pages, "pages")
    is_good = F.col("bad").isNull()
    n_bad, total, last = pages.agg(
        F.count("bad"), F.max(F.when(is_good, F.col("totalPages"))), F.max(F.when(is_good, F.col("page")))).first()
    if reject_path is not None:
        bad = pages.filter("bad IS NOT NULL").select("page", F.col("bad").alias("text"), F.lit(cfg.stamp).alias("stamp"))
        append_batch(bad, reject_path, "stamp")
    elif n_bad:
        raise ValueError(f"{n_bad} malformed pages in {landing_path}; name a reject path to go on without them")
    good = pages.filter(is_good)
    counts = good.groupBy("page").agg(F.sum("n_items").alias("n_items"))
    if total is not None and n_bad:
        # A rejected last page closes no group, so the last good one does.
        total = min(total, last)
    if total is None or resume > total:
        return resume
    taken = F.col("page") >= resume
    slots = slot_ranges(counts.filter(taken), total, cfg.pages_per_folder)
    slots = materialize(slots, "slots")
    note_fields(good.filter(taken).select(F.explode("fields").alias("field")), cfg.stamp, raw_root)
    note_pages(landed_runs(counts.filter(taken), slots, cfg), cfg, raw_root)
    write_lines(label_pages(good.filter(taken), slots, cfg), raw_root)
    return resume


#: Folder label of a run, and a run of neighbouring pages that the folder holds.
_NOTES = "first_page bigint, last_page bigint, from_page bigint, to_page bigint, period string, stamp string"


def landed_runs(pages: DataFrame, slots: DataFrame, cfg: RunConfig) -> DataFrame:
    """The label of each folder and the runs of neighbouring pages in it; a group of empty pages gets no folder.

    A run is found inside a slot of ``pages_per_folder`` pages, so no task orders more than that.
    """
    slotted = pages.withColumn("slot", page_slot("page", cfg.pages_per_folder)).join(slots, "slot")
    filled = slotted.groupBy("first_page", "last_page").agg(F.sum("n_items").alias("n")).filter("n > 0").drop("n")
    within = Window.partitionBy("slot").orderBy("page")
    runs = slotted.withColumn("run", F.col("page") - F.row_number().over(within))
    runs = runs.groupBy("first_page", "last_page", "slot", "run").agg(F.min("page").alias("from_page"), F.max("page").alias("to_page"))
    return runs.join(filled, ["first_page", "last_page"], "left_semi").drop("slot", "run")


def note_pages(runs: DataFrame, cfg: RunConfig, raw_root: str) -> None:
    """Write the run's page runs beside the folders, before these are written."""
    notes = runs.select("*", F.lit(cfg.period).alias("period"), F.lit(cfg.stamp).alias("stamp"))
    append_batch(notes, f"{raw_root.rstrip('/')}_pages", "stamp")


def uncovered(wanted: DataFrame, held: DataFrame) -> DataFrame:
    """Page ranges (``from_page, to_page``) of ``wanted`` that no range of ``held`` covers.

    Each wanted range meets the held ranges that overlap it, cut to it; in their order, what lies between the end reached so far
    and the next beginning is uncovered.
    """
    want = wanted.select(F.col("from_page").alias("lo"), F.col("to_page").alias("hi")).distinct()
    cover = held.select(F.col("from_page").alias("a"), F.col("to_page").alias("b")).distinct()
    met = want.join(cover, (F.col("a") <= F.col("hi")) & (F.col("b") >= F.col("lo")), "left")
    # One more range behind the end closes the last gap.
    ends = want.select("lo", "hi", (F.col("hi") + 1).alias("a"), (F.col("hi") + 1).alias("b"))
    ordered = Window.partitionBy("lo", "hi").orderBy("a", "b").rowsBetween(Window.unboundedPreceding, -1)
    steps = met.filter("a IS NOT NULL").unionByName(ends)
    reached = F.coalesce(F.max("b").over(ordered), F.col("lo") - 1)
    gaps = steps.select(F.greatest(reached + 1, "lo").alias("from_page"), F.least(F.col("a") - 1, "hi").alias("to_page"))
    return gaps.filter("from_page <= to_page")


def first_gap(spark: SparkSession, raw_root: str, prefix: str) -> int | None:
    """First page that a run meant to land and that no folder holds, of any run since the last one without a gap.

    A run's notes are compared with the folders in place. Pages of its lost folders stay missing until folders of the same or
    later runs hold them; a run whose notes are all covered is closed, and neither its notes nor its periods are looked at again.
    """
    path, closed_path = f"{raw_root.rstrip('/')}_pages", f"{raw_root.rstrip('/')}_closed"
    stamps = sorted(set(partition_values(spark, path, "stamp")) - set(partition_values(spark, closed_path, "stamp")))
    if not stamps:
        return None
    notes = spark.read.schema(_NOTES).parquet(path).filter(F.col("stamp") >= stamps[0])
    notes = notes.withColumn("folder", folder_name(prefix, "first_page", "last_page", F.col("stamp")))
    periods = [r[0] for r in notes.select("period").distinct().collect()]
    there = None
    for period in sorted(periods):
        listed = list_folders(spark, raw_root, period)
        there = listed if there is None else there.unionByName(listed)
    lost = materialize(notes.join(there, ["period", "folder"], "left_anti"), "lost")
    held = notes.join(there, ["period", "folder"], "left_semi")
    first = None if lost.isEmpty() else uncovered(lost, held).agg(F.min("from_page")).first()[0]
    if first is None:
        for stamp in stamps:
            make_folder(spark, f"{closed_path}/stamp={stamp}")
    return first
