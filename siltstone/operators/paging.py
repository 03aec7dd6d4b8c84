"""Where a feed run starts, which pages it takes, and how pages are grouped into folders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions.names import folder_last_page
from siltstone.operators.segments import WIDTH, floor_div, next_flagged


def resume_page(folders: DataFrame, first_page: int = 1) -> DataFrame:
    """One row: the highest last page inside the newest period, ``first_page`` if there is none.

    ``folders`` has (period, folder). One aggregate: the greatest (period, page) pair.
    """
    newest = F.max(F.struct("period", folder_last_page("folder").alias("page")))
    return folders.agg(F.coalesce(newest["page"], F.lit(first_page)).alias("resume_page"))


def pages_to_fetch(spark: SparkSession, resume: int, total_pages: int) -> DataFrame:
    """Pages from the resume page to the last one, both included; none if already past it."""
    return spark.range(resume, total_pages + 1).withColumnRenamed("id", "page")


def page_stats(envelopes: DataFrame) -> DataFrame:
    """One narrow row per landed page: its item count and the page total it reported."""
    return envelopes.groupBy("page").agg(
        F.sum(F.coalesce(F.array_size("items"), F.lit(0))).cast("long").alias("n_items"),
        F.max("totalPages").alias("total_pages"),
    )


def page_slot(page: Column | str, per_folder: int) -> Column:
    """Slot 0 holds pages 1..n, slot 1 pages n+1..2n, and so on."""
    page = F.col(page) if isinstance(page, str) else page
    return floor_div(page - 1, per_folder)


def slot_ranges(
    pages: DataFrame, total_pages: int, per_folder: int = 10, width: int = WIDTH
) -> DataFrame:
    """(slot, first_page, last_page): the page range of the group each slot falls into.

    A group closes at a non-empty page that is a multiple of ``per_folder``, or at the last
    page of the feed. A slot whose closing page is empty or absent flows into the next
    closing slot. Slots behind the last close stay open and are left out; the next run
    starts at the last closed page and takes them up again.
    """
    page = F.col("page")
    closes = ((page % per_folder == 0) & (F.col("n_items") > 0)) | (page == total_pages)
    slots = pages.groupBy(page_slot("page", per_folder).alias("slot")).agg(
        F.min("page").alias("__lo"), F.max("page").alias("__hi"), F.bool_or(closes).alias("__closes")
    )
    slots = next_flagged(slots, "slot", F.col("__closes"), "__close", width)
    slots = slots.filter(F.col("__close").isNotNull())
    groups = slots.groupBy("__close").agg(
        F.min("__lo").alias("first_page"), F.max("__hi").alias("last_page")
    )
    return slots.join(groups, "__close").select("slot", "first_page", "last_page")


def page_groups(
    pages: DataFrame, total_pages: int, per_folder: int = 10, width: int = WIDTH
) -> DataFrame:
    """One row per closed group that has items: first page, last page, pages, items."""
    slots = slot_ranges(pages, total_pages, per_folder, width)
    return (
        pages.withColumn("slot", page_slot("page", per_folder))
        .groupBy("slot")
        .agg(F.count(F.lit(1)).alias("__pages"), F.sum("n_items").alias("__items"))
        .join(slots, "slot")
        .groupBy("first_page", "last_page")
        .agg(F.sum("__pages").alias("n_pages"), F.sum("__items").alias("n_items"))
        .filter("n_items > 0")
    )
