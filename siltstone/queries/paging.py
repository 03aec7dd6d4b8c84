"""Work lists, resume pages, page groups and envelopes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions import names
from siltstone.functions.stamps import run_stamp
from siltstone.operators.paging import page_groups, pages_to_fetch, resume_page
from siltstone.operators.worklist import chunk_folders, symmetric_difference, unprocessed
from siltstone.queries.feed import FEED_SQL, envelopes, feed_records, last_page
from siltstone.queries.registry import query, table
from siltstone.schemas import RECORD_FIELDS
from siltstone.scratch import new_folder
from siltstone.sources.envelopes import flatten_items, parse_records, read_envelopes
from siltstone.sources.tables import row_count

PREFIX = "feedpage"


def _order_folders(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Keys of orders and of lineitem, as names of landed and of processed folders."""
    landed = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("order_"), F.col("o_orderkey")).alias("folder")
    )
    processed = table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("order_"), F.col("l_orderkey")).alias("folder")
    )
    return landed, processed


@query("""
  (SELECT 'order_' || o_orderkey AS folder, true AS in_left, false AS in_right FROM orders
   WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem))
  UNION
  (SELECT 'order_' || l_orderkey, false, true FROM lineitem
   WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders))
""")
def folder_symdiff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names on exactly one side."""
    return symmetric_difference(*_order_folders(spark, sf_dir), "folder")


_PENDING = """
  SELECT DISTINCT 'order_' || o_orderkey AS folder FROM orders o
  WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)
"""


@query(_PENDING)
def unprocessed_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed names without a processed entry."""
    return unprocessed(*_order_folders(spark, sf_dir), "folder")


@query(f"SELECT count(*) AS n_rows FROM ({_PENDING})")
def pending_folder_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of folders still to be processed."""
    return row_count(unprocessed(*_order_folders(spark, sf_dir), "folder"))


def _folder_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One folder name per month and priority of orders: its order keys' range and newest day."""
    return (
        table(spark, sf_dir, "orders")
        .groupBy(F.date_format("o_orderdate", "yyyyMM").alias("period"), "o_orderpriority")
        .agg(
            F.min("o_orderkey").alias("lo"),
            F.max("o_orderkey").alias("hi"),
            run_stamp(F.max("o_orderdate")).alias("stamp"),
        )
        .select("period", names.folder_name(PREFIX, "lo", "hi", F.col("stamp")).alias("folder"))
    )


_FOLDER_NAMES = """
  SELECT strftime(o_orderdate, '%Y%m') AS period,
         'feedpage_' || min(o_orderkey) || '_to_' || max(o_orderkey) || '_'
         || strftime(max(o_orderdate), '%Y%m%d_%H%M%S') AS folder
  FROM orders GROUP BY strftime(o_orderdate, '%Y%m'), o_orderpriority
"""


@query(f"""
  SELECT period, folder, CAST(split_part(folder, '_', 2) AS BIGINT) AS first_page,
         CAST(split_part(folder, '_', 4) AS BIGINT) AS last_page
  FROM ({_FOLDER_NAMES})
""")
def folder_name_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page numbers read from folder names."""
    return _folder_names(spark, sf_dir).select(
        "period",
        "folder",
        names.folder_first_page("folder").alias("first_page"),
        names.folder_last_page("folder").alias("last_page"),
    )


@query(f"""
  SELECT max(CAST(split_part(folder, '_', 4) AS BIGINT)) AS resume_page
  FROM ({_FOLDER_NAMES}) WHERE period = (SELECT strftime(max(o_orderdate), '%Y%m') FROM orders)
""")
def resume_page_newest_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Highest last page inside the newest period."""
    return resume_page(_folder_names(spark, sf_dir))


@query(f"""
  SELECT page FROM generate_series(
    (SELECT max(CAST(split_part(folder, '_', 4) AS BIGINT)) FROM ({_FOLDER_NAMES})
     WHERE period = (SELECT strftime(max(o_orderdate), '%Y%m') FROM orders)),
    (SELECT max(l_orderkey) + count(*) FROM lineitem)) AS g(page)
""")
def pages_after_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages from the resume page to the total, both included."""
    resume = resume_page(_folder_names(spark, sf_dir)).first()[0]
    total = table(spark, sf_dir, "lineitem").agg(F.max("l_orderkey") + F.count(F.lit(1))).first()[0]
    return pages_to_fetch(spark, resume, total)


def _labelled(groups: DataFrame) -> DataFrame:
    stamp = F.lit("20240201_120000")
    return groups.select(
        "first_page",
        "last_page",
        "n_pages",
        "n_items",
        names.page_label("first_page", "last_page", stamp).alias("label"),
        names.folder_name(PREFIX, "first_page", "last_page", stamp).alias("folder"),
    )


_LABELS = """
  first_page || ' - to - ' || last_page || ' - 20240201_120000' AS label,
  'feedpage_' || first_page || '_to_' || last_page || '_20240201_120000' AS folder
"""


@query(f"""
  WITH g AS (
    SELECT min(page) AS first_page, max(page) AS last_page, count(DISTINCT page) AS n_pages,
           count(*) AS n_items
    FROM (SELECT event_id // 100 + 1 AS page FROM events) GROUP BY (page - 1) // 10)
  SELECT first_page, last_page, n_pages, n_items, {_LABELS} FROM g
""")
def page_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of ten pages with label and folder name."""
    pages = feed_records(spark, sf_dir).groupBy("page").agg(F.count(F.lit(1)).alias("n_items"))
    return _labelled(page_groups(pages, last_page(pages), width=16))


@query(f"""
  WITH p AS (
    SELECT event_id // 10 + 1 AS page, count(*) FILTER (event_type = 'purchase') AS n_items
    FROM events GROUP BY 1),
  f AS (
    SELECT *, CASE WHEN (page % 10 = 0 AND n_items > 0) OR page = max(page) OVER () THEN 1 ELSE 0 END AS closes
    FROM p),
  b AS (
    SELECT *, coalesce(sum(closes) OVER (ORDER BY page ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS bucket
    FROM f),
  g AS (
    SELECT min(page) AS first_page, max(page) AS last_page, count(*) AS n_pages,
           CAST(sum(n_items) AS BIGINT) AS n_items
    FROM b GROUP BY bucket HAVING sum(n_items) > 0)
  SELECT first_page, last_page, n_pages, n_items, {_LABELS} FROM g
""")
def page_buckets_empty_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A group whose closing page is empty goes on to the next non-empty multiple of ten."""
    page = (F.floor(F.col("event_id") / 10) + 1).cast("long").alias("page")
    pages = (
        table(spark, sf_dir, "events")
        .groupBy(page)
        .agg(F.count_if(F.col("event_type") == "purchase").alias("n_items"))
    )
    return _labelled(page_groups(pages, last_page(pages), width=16))


@query("""
  SELECT CAST(split_part(folder, '_', 2) AS BIGINT) AS first_page, folder,
         (row_number() OVER (ORDER BY CAST(split_part(folder, '_', 2) AS BIGINT), folder) - 1) // 10 AS chunk
  FROM (SELECT DISTINCT 'feedpage_' || l_orderkey || '_to_' || l_linenumber || '_' ||
               strftime(l_shipdate, '%Y%m%d_%H%M%S') AS folder FROM lineitem)
""")
def chunk_of_ten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A work list in numbered chunks of ten."""
    name = names.folder_name(PREFIX, "l_orderkey", "l_linenumber", run_stamp("l_shipdate"))
    folders = table(spark, sf_dir, "lineitem").select(name.alias("folder")).distinct()
    return chunk_folders(folders, 10).select(
        names.folder_first_page("folder").alias("first_page"), "folder", "chunk"
    )


@query(f"""
  SELECT page, id, strftime(published, '%d/%m/%Y %H:%M:%S') AS data_publicacao, imagens,
         CAST(event_id AS VARCHAR) AS produto_id
  FROM ({FEED_SQL})
""")
def flatten_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed page envelopes to one row per record."""
    records = feed_records(spark, sf_dir)
    path = new_folder(spark, "envelopes")
    envelopes(records, last_page(records)).write.json(path)
    return flatten_items(read_envelopes(spark, path)).select(
        "page", "id", "data_publicacao", "imagens", "produto_id"
    )


@query(f"""
  SELECT page, id, event_type AS destaque, imagens, CAST(NULL AS VARCHAR) AS produtos_relacionados
  FROM ({FEED_SQL})
""")
def records_from_json_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON text to records under a declared schema; a field the text lacks is null."""
    text = F.to_json(F.struct(*RECORD_FIELDS)).alias("body")
    bodies = feed_records(spark, sf_dir).select("page", text)
    return parse_records(bodies, "body").select(
        "page", "id", "destaque", "imagens", "produtos_relacionados"
    )
