"""Scalar functions, projections, filters and global aggregates."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions import stamps
from siltstone.operators.bounds import lower_bound_frame
from siltstone.operators.columns import map_columns, named, present, rename_cast
from siltstone.operators.latest import latest_per_key
from siltstone.operators.map_pivot import json_columns_to_maps
from siltstone.queries.registry import query, table
from siltstone.schemas import PUBLICATION_FORMAT

ZONE = "America/Sao_Paulo"
START, END = date(2024, 1, 5), date(2024, 1, 20)


@query("""
  SELECT user_id, event_id, ts, event_type, props FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
""")
def dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest row per key."""
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type", "props")
    return latest_per_key(events, ["user_id"], [F.col("ts").desc(), F.col("event_id").desc()])


def _publication_text() -> F.Column:
    return F.date_format("o_orderdate", PUBLICATION_FORMAT)


@query("""
  SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS reference_month FROM orders
""")
def month_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publication text to the first day of its month."""
    day = stamps.parse_date(_publication_text(), PUBLICATION_FORMAT)
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", stamps.month_start(day).alias("reference_month")
    )


@query("SELECT o_orderkey, o_orderdate AS publication_ts FROM orders")
def publication_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publication text to timestamp."""
    ts = stamps.parse_timestamp(_publication_text(), PUBLICATION_FORMAT)
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", ts.cast("timestamp_ntz").alias("publication_ts")
    )


@query("""
  WITH t AS (
    SELECT o_orderkey,
           CASE WHEN o_orderstatus = 'P' THEN replace(strftime(o_orderdate, '%d/%m/%Y %H:%M:%S'), '/', '?')
                WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%d/%m/%Y %H:%M:%S') END AS txt
    FROM orders)
  SELECT o_orderkey, CAST(try_strptime(txt, '%d/%m/%Y %H:%M:%S') AS DATE) AS publication_day,
         try_strptime(txt, '%d/%m/%Y %H:%M:%S') AS publication_ts
  FROM t
""")
def bad_dates_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Malformed and missing publication texts become null, the others parse."""
    text = F.when(
        F.col("o_orderstatus") == "P", F.replace(_publication_text(), F.lit("/"), F.lit("?"))
    ).when(F.col("o_orderstatus") == "F", _publication_text())
    orders = table(spark, sf_dir, "orders").select("o_orderkey", text.alias("txt"))
    return orders.select(
        "o_orderkey",
        stamps.parse_date("txt", PUBLICATION_FORMAT).alias("publication_day"),
        stamps.parse_timestamp("txt", PUBLICATION_FORMAT).cast("timestamp_ntz").alias("publication_ts"),
    )


@query("""
  SELECT CAST(o_orderkey AS VARCHAR) AS id_text, CAST(o_custkey AS VARCHAR) AS product_id,
         o_orderstatus AS type, o_orderpriority AS title, 'orders' AS source_table
  FROM orders
""")
def rename_cast_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rename and cast from one mapping, plus a literal, in a fixed column order."""
    orders = table(spark, sf_dir, "orders")
    mapping = {
        "o_orderkey": "id_text",
        "o_custkey": "product_id",
        "o_orderstatus": "type",
        "o_orderpriority": "title",
    }
    return orders.select(*rename_cast(orders, mapping), F.lit("orders").alias("source_table"))


@query("SELECT event_id, user_id, props FROM events")
def run_time_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixed columns, then those of a wish list that exist, then none of a kind that is absent."""
    events = table(spark, sf_dir, "events")
    chosen = present(events, ["user_id", "no_such_column", "props"])
    return events.select("event_id", *map(named, chosen), *map(named, map_columns(events)))


@query("SELECT event_id, CAST(len(json_keys(props)) AS INTEGER) AS n_keys FROM events")
def columns_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns picked by their map type."""
    events = json_columns_to_maps(table(spark, sf_dir, "events"), ["props", "no_such_column"])
    return events.select("event_id", *[F.size(named(c)).alias("n_keys") for c in map_columns(events)])


_STAMPED = """
  SELECT event_id, strftime(ts, '%Y%m%d_%H%M%S') AS dtproc FROM events
  WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'
"""


@query(_STAMPED)
def stamp_range_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inclusive day range on a text stamp, by parsing its day."""
    events = table(spark, sf_dir, "events").select("event_id", stamps.run_stamp("ts").alias("dtproc"))
    return events.filter(stamps.stamp_day_between("dtproc", START, END))


@query(_STAMPED)
def stamp_range_filter_pushed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same range as a text range on the bare stamp."""
    events = table(spark, sf_dir, "events").select("event_id", stamps.run_stamp("ts").alias("dtproc"))
    return events.filter(stamps.stamp_text_between("dtproc", START, END))


@query("""
  SELECT event_id, event_type, ts FROM events
  WHERE CAST(left(CAST(ts AS VARCHAR), 10) AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'
""")
def ts_range_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inclusive day range on a timestamp; reaches the scan as two bounds."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "ts")
    return events.filter(stamps.local_day_between("ts", START, END))


@query("""
  SELECT left(CAST(ts AS VARCHAR), 10) AS day, substr(strftime(ts, '%Y%m%d_%H%M%S'), 1, 8) AS stamp_day,
         count(*) AS n_rows
  FROM events GROUP BY 1, 2
""")
def text_prefix_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day prefix of a timestamp's text and of a stamp."""
    day = F.left(F.col("ts").cast("string"), F.lit(10)).alias("day")
    prefix = F.substring(stamps.run_stamp("ts"), 1, 8).alias("stamp_day")
    return table(spark, sf_dir, "events").groupBy(day, prefix).agg(F.count(F.lit(1)).alias("n_rows"))


@query("SELECT strftime(date_trunc('month', max(ts)), '%Y-%m-%d') AS lower_bound FROM events")
def lower_bound_from_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Month start of the target's newest day."""
    target = table(spark, sf_dir, "events").select(F.col("ts").cast("date"))
    source = table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date"))
    return lower_bound_frame(target, source)


@query("SELECT strftime(date_trunc('month', min(o_orderdate)), '%Y-%m-%d') AS lower_bound FROM orders")
def lower_bound_from_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Month start of the source's oldest stamp, as there is no target."""
    stamp = stamps.run_stamp("o_orderdate")
    return lower_bound_frame(None, table(spark, sf_dir, "orders").select(stamps.stamp_day(stamp)))


@query("""
  SELECT strftime(date_trunc('month', coalesce(
    (SELECT max(ts) FROM events WHERE event_type = 'retracted'),
    (SELECT min(o_orderdate) FROM orders))), '%Y-%m-%d') AS lower_bound
""")
def lower_bound_empty_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target exists but has no row: the source decides."""
    target = table(spark, sf_dir, "events").filter("event_type = 'retracted'")
    source = table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date"))
    return lower_bound_frame(target.select(F.col("ts").cast("date")), source)


@query("""
  SELECT event_type, CAST(max(ts) AS DATE) AS upper_bound, CAST(max(ts) AS DATE) - 7 AS default_start
  FROM events GROUP BY event_type
""")
def default_day_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upper bound and the default lower bound seven days before it, per event type."""
    upper = F.max("ts").cast("date")
    return table(spark, sf_dir, "events").groupBy("event_type").agg(
        upper.alias("upper_bound"), F.date_sub(upper, 7).alias("default_start")
    )


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y%m') AS dt, 'silver' AS layer FROM orders")
def run_month_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partition value yyyyMM of a date."""
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        stamps.period_of(F.col("o_orderdate").cast("date")).alias("dt"),
        F.lit("silver").alias("layer"),
    )


@query("SELECT event_id, ts - INTERVAL 3 HOUR AS date_ingestion FROM events")
def ingest_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixed offset of minus three hours."""
    return table(spark, sf_dir, "events").select(
        "event_id", stamps.shift_hours("ts", -3).alias("date_ingestion")
    )


@query("""
  SELECT event_id, strftime(ts - INTERVAL 3 HOUR, '%Y%m%d_%H%M%S') AS local_stamp,
         strftime(ts - INTERVAL 3 HOUR, '%Y-%m-%dT%H:%M:%S') AS iso_stamp
  FROM events
""")
def local_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run stamps on the feed's own clock, from UTC times."""
    local = stamps.utc_wall_clock("ts", ZONE)
    return table(spark, sf_dir, "events").select(
        "event_id",
        stamps.run_stamp(local).alias("local_stamp"),
        stamps.iso_stamp(local).alias("iso_stamp"),
    )


@query("SELECT event_id, CAST(epoch(date_trunc('second', ts)) AS BIGINT) + 3 * 3600 AS seconds FROM events")
def instant_of_local_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text of the feed's wall clock to the instant it names, and back to text, whatever the session's zone is."""
    zone = "America/Sao_Paulo"
    text = F.date_format("ts", "dd/MM/yyyy HH:mm:ss")
    instant = stamps.parse_instant(text, "dd/MM/yyyy HH:mm:ss", zone)
    events = table(spark, sf_dir, "events").select("event_id", text.alias("text"), instant.alias("instant"))
    back = F.date_format(stamps.wall_clock("instant", zone), "dd/MM/yyyy HH:mm:ss")
    return events.filter(back == F.col("text")).select("event_id", F.unix_timestamp("instant").alias("seconds"))


@query("SELECT event_id, length(strftime(ts, '%Y%m%d_%H%M%S')) AS length, ts < now()::TIMESTAMP AS earlier, 1::BIGINT AS n_stamps FROM events")
def stamp_of_the_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stamp of now on the feed's clock: one for all rows of a query, and later than every event's."""
    now = stamps.current_run_stamp("America/Sao_Paulo")
    events = table(spark, sf_dir, "events").select("event_id", stamps.run_stamp("ts").alias("own"), now.alias("now"))
    n_stamps = events.agg(F.count_distinct("now")).first()[0]
    return events.select(
        "event_id", F.length("now").alias("length"), (F.col("own") < F.col("now")).alias("earlier"),
        F.lit(n_stamps).cast("bigint").alias("n_stamps"))
