"""Sinks, scans and catalog tables, written to a folder of their own and read back."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.functions import names
from siltstone.functions.stamps import stamp_text_between
from siltstone.operators.merge import merge_upsert
from siltstone.queries.feed import FEED_SQL, feed_records
from siltstone.queries.registry import drop_database, new_database, query, table
from siltstone.scratch import materialize, new_folder
from siltstone.sources import json_folders, swaps, tables

STAMP = "20240201_120000"


def _written_folders(spark: SparkSession, sf_dir: str) -> str:
    """The feed as JSON folders of ten pages."""
    records = feed_records(spark, sf_dir)
    first = F.floor((F.col("page") - 1) / 10) * 10 + 1
    last = first + 9
    root = new_folder(spark, "raw")
    rows = records.select(
        *[c for c in records.columns if c != "page"],
        names.page_label(first, last, F.lit(STAMP)).alias("PAGE"),
        F.lit(STAMP[:6]).alias("period"),
        names.folder_name("feedpage", first, last, F.lit(STAMP)).alias("folder"),
    )
    json_folders.write_folders(rows, root)
    return root


_FOLDER = """
  'feedpage_' || ((page - 1) // 10 * 10 + 1) || '_to_' || ((page - 1) // 10 * 10 + 10)
  || '_20240201_120000'
"""


@query(f"""
  SELECT id, imagens, CAST(event_id AS VARCHAR) AS produto_id,
         ((page - 1) // 10 * 10 + 1) || ' - to - ' || ((page - 1) // 10 * 10 + 10)
         || ' - 20240201_120000' AS label
  FROM ({FEED_SQL})
""")
def json_folder_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows written as JSON folders and read by wildcard under the declared schema."""
    root = _written_folders(spark, sf_dir)
    rows = json_folders.scan_paths(spark, f"{root}/period={STAMP[:6]}/*")
    return rows.select("id", "imagens", "produto_id", F.col("PAGE").alias("label"))


@query(f"SELECT DISTINCT '202402' AS period, {_FOLDER} AS folder FROM ({FEED_SQL})")
def folder_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct folder names of a period, from file paths."""
    return json_folders.list_folders(spark, _written_folders(spark, sf_dir), STAMP[:6])


@query(f"SELECT {_FOLDER} AS folder, count(*) AS n_rows FROM ({FEED_SQL}) GROUP BY 1")
def folder_of_each_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per folder, the folder taken from the file metadata of the scan."""
    root = _written_folders(spark, sf_dir)
    rows = json_folders.folder_from_metadata(json_folders.scan_paths(spark, f"{root}/*/*"))
    return rows.groupBy("folder").agg(F.count(F.lit(1)).alias("n_rows"))


@query("""
  SELECT o_orderkey, strftime(o_orderdate, '%Y%m') AS period, 'orders_199801' AS folder
  FROM orders WHERE strftime(o_orderdate, '%Y%m') = '199801'
""")
def period_selector(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders written by month, one month read; the other months are not listed."""
    root = new_folder(spark, "periods")
    period = F.date_format("o_orderdate", "yyyyMM")
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        period.alias("period"),
        F.concat(F.lit("orders_"), period).alias("folder"),
    )
    json_folders.write_folders(rows, root)
    schema = T.StructType([T.StructField("o_orderkey", T.LongType())])
    return json_folders.scan_period(spark, root, "199801", schema)


@query("""
  SELECT event_id, user_id, props FROM events WHERE event_type = 'click'
  UNION ALL BY NAME
  SELECT event_id, event_type FROM events WHERE event_type <> 'click'
""")
def schema_drift_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two folders with different fields in one scan; what a folder lacks is null."""
    events = table(spark, sf_dir, "events")
    root = new_folder(spark, "drift")
    events.filter("event_type = 'click'").select("event_id", "user_id", "props").write.json(f"{root}/a")
    events.filter("event_type <> 'click'").select("event_id", "event_type").write.json(f"{root}/b")
    schema = events.select("event_id", "user_id", "props", "event_type").schema
    return json_folders.scan_paths(spark, [f"{root}/a", f"{root}/b"], schema)


_DAILY = T.StructType(
    [
        T.StructField("event_id", T.LongType(), True, {"comment": "Identifier"}),
        T.StructField("event_type", T.StringType(), True, {"comment": "Kind"}),
        T.StructField("dt", T.StringType(), True, {"comment": "Day, partition"}),
    ]
)


def _daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", "event_type", F.date_format("ts", "yyyyMMdd").alias("dt")
    )


_PER_DAY = """
  SELECT strftime(ts, '%Y%m%d') AS dt, count(*) AS n_rows, CAST(sum(event_id) AS BIGINT) AS id_sum
  FROM events GROUP BY 1
"""


def _per_day(df: DataFrame) -> DataFrame:
    return df.groupBy("dt").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("event_id").alias("id_sum")
    )


@query(_PER_DAY)
def external_table_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed external table over a path, dropped, registered again and read by name."""
    path = new_folder(spark, "external")
    db = new_database(spark, path)
    name = f"{db}.daily"
    tables.ensure_table(spark, name, f"{path}/daily", _DAILY, "dt")
    tables.append_batch(_daily(spark, sf_dir), f"{path}/daily", "dt")
    tables.drop_registration(spark, name)
    rows = tables.ensure_table(spark, name, f"{path}/daily", _DAILY, "dt")
    out = materialize(_per_day(rows), "result")
    drop_database(spark, db)
    return out


@query("SELECT count(*) AS n_rows FROM events")
def path_scan_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row count of a scan by path."""
    return tables.row_count(tables.read_path(spark, f"{sf_dir}/events.parquet"))


@query("SELECT event_id, user_id, event_type, props FROM events ORDER BY event_id LIMIT 5")
def table_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First five rows."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "props")
    return tables.preview(events, 5, ["event_id"])


@query("""
  SELECT event_id, event_type, strftime(ts, '%Y%m%d') AS dt,
         CASE WHEN ts >= TIMESTAMP '2024-01-16' THEN props END AS props
  FROM events
""")
def evolved_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A later batch brings a new column; earlier rows show null."""
    path = new_folder(spark, "evolved")
    db = new_database(spark, path)
    name = f"{db}.daily"
    events = table(spark, sf_dir, "events")
    dt = F.date_format("ts", "yyyyMMdd").alias("dt")
    early = events.filter("ts < TIMESTAMP_NTZ '2024-01-16'").select("event_id", "event_type", dt)
    late = events.filter("ts >= TIMESTAMP_NTZ '2024-01-16'").select("event_id", "event_type", "props", dt)
    tables.ensure_table(spark, name, f"{path}/daily", _DAILY, "dt")
    tables.append_batch(early, f"{path}/daily", "dt")
    tables.add_columns(spark, name, [late.schema["props"]])
    tables.append_batch(late, f"{path}/daily", "dt")
    tables.refresh_partitions(spark, name)
    schema = spark.table(name).schema
    drop_database(spark, db)
    return tables.read_path(spark, f"{path}/daily", schema)


@query(_PER_DAY)
def compacted_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many small files per partition put together, by their sizes."""
    path = new_folder(spark, "compacted")
    db = new_database(spark, path)
    name = f"{db}.daily"
    _daily(spark, sf_dir).repartition(8, "event_id").write.partitionBy("dt").parquet(f"{path}/daily")
    rows = tables.ensure_table(spark, name, f"{path}/daily", _DAILY, "dt")
    days = [r[0] for r in rows.select("dt").distinct().collect()]
    tables.compact(spark, name, f"{path}/daily", "dt", days)
    out = materialize(_per_day(spark.table(name)), "result")
    drop_database(spark, db)
    return out


@query(_PER_DAY)
def batch_append_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch appended twice under its stamp counts once."""
    path = new_folder(spark, "batches")
    rows = _daily(spark, sf_dir)
    tables.append_batch(rows, path, "dt")
    tables.append_batch(rows, path, "dt")
    return _per_day(tables.read_path(spark, path, _DAILY))


@query("""
  SELECT event_id, strftime(ts, '%Y%m%d') || '_120000' AS dtproc FROM events
  WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'
""")
def stamp_range_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches appended under a stamp a day; a day range reads the partitions of its stamps only."""
    path = new_folder(spark, "stamped")
    events = table(spark, sf_dir, "events").select("event_id", F.concat(F.date_format("ts", "yyyyMMdd"), F.lit("_120000")).alias("dtproc"))
    tables.append_batch(events, path, "dtproc")
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("dtproc", T.StringType())])
    return tables.read_path(spark, path, schema).filter(stamp_text_between("dtproc", date(2024, 1, 5), date(2024, 1, 20)))


_HALF = "event_id % 3 = 0"


@query(f"""
  SELECT event_id, CASE WHEN {_HALF} THEN 'changed' ELSE event_type END AS event_type,
         CASE WHEN {_HALF} THEN strftime(ts + INTERVAL 1 DAY, '%Y%m%d') ELSE strftime(ts, '%Y%m%d') END AS dt
  FROM events
""")
def exchange_finished_later(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A merge that moves rows to the next day, whose driver is lost when the new partitions are in force but the catalog does
    not know them yet: the next use of the table finishes it."""
    path = new_folder(spark, "exchange")
    db = new_database(spark, path)
    name = f"{db}.daily"
    tables.save_merged(_daily(spark, sf_dir), name, f"{path}/daily", _DAILY, ["event_id"])
    moved = F.date_format(F.col("ts") + F.expr("INTERVAL 1 DAY"), "yyyyMMdd")
    source = table(spark, sf_dir, "events").filter(_HALF).select("event_id", F.lit("changed").alias("event_type"), moved.alias("dt"))
    merged = merge_upsert(spark.table(name), source, ["event_id"], unique_target=True)
    folders = swaps.write_version(merged, f"{path}/daily", "dt", True, ["event_id"], [])
    held = swaps.partitions_of(spark, f"{path}/daily", "dt")
    swaps.put_in_force(spark, f"{path}/daily", "dt", folders | {v: "" for v in held if v not in folders})
    rows = tables.ensure_table(spark, name, f"{path}/daily", _DAILY, "dt")
    out = materialize(rows, "result")
    drop_database(spark, db)
    return out


@query("""
  SELECT strftime(date_trunc('month', min(ts)), '%Y-%m-%d') AS oldest, strftime(date_trunc('month', max(ts)), '%Y-%m-%d') AS newest
  FROM events
""")
def bounds_from_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Month starts of a merged table's oldest and newest stamp, from the summaries beside its partitions."""
    path = new_folder(spark, "bounds")
    db = new_database(spark, path)
    name = f"{db}.daily"
    schema = T.StructType([*_DAILY.fields[:-1], T.StructField("ts", T.TimestampNTZType()), _DAILY.fields[-1]])
    events = table(spark, sf_dir, "events")
    rows = events.select("event_id", "event_type", "ts", F.date_format("ts", "yyyyMMdd").alias("dt"))
    tables.save_merged(rows, name, f"{path}/daily", schema, ["event_id"], unique_source=True, tracked=["ts"])
    found = swaps.tracked_range(spark.table(name), f"{path}/daily", "dt", "ts")
    out = materialize(found.select(
        F.trunc("lo", "MM").cast("string").alias("oldest"), F.trunc("hi", "MM").cast("string").alias("newest")), "result")
    drop_database(spark, db)
    return out
