"""The four jobs and their streaming forms over the events feed, in two runs.

Run one lands the first half of the pages, run two resumes at the last landed page and lands
the rest; together they hold every event.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.config import RunConfig
from siltstone.functions.names import folder_last_page
from siltstone.functions.stamps import wall_clock
from siltstone.operators.map_pivot import json_columns_to_maps, known_names, map_pivot
from siltstone.plans.bronze import bronze_run
from siltstone.plans.gold import save_gold
from siltstone.plans.landing import raw_ingestion
from siltstone.plans.silver import save_silver
from siltstone.queries.feed import FEED_SQL, envelopes, feed_records, last_page
from siltstone.queries.registry import drop_database, new_database, query, table
from siltstone.schemas import BRONZE_SCHEMA, RAW_SCHEMA, RECORD_FIELDS, STAMP_FORMAT
from siltstone.scratch import new_folder
from siltstone.sources.json_folders import PARTITIONS, scan_paths, write_folders
from siltstone.sources.listing import child_names, remove_path
from siltstone.sources.tables import ensure_table, read_path, save_merged
from siltstone.streaming.ingest import ingest_stream
from siltstone.streaming.upsert import upsert_stream

# The clocks of the two runs.
RUNS = (
    RunConfig(datetime(2024, 2, 10, 15, 0, tzinfo=timezone.utc)),
    RunConfig(datetime(2024, 3, 5, 15, 0, tzinfo=timezone.utc)),
)
JOBS = ("raw", "bronze", "silver", "gold")


def run_layers(spark: SparkSession, sf_dir: str, last_job: str) -> tuple[str, T.StructType | None]:
    """Both runs up to ``last_job``; returns its path and table schema."""
    base = new_folder(spark, "layers")
    db = new_database(spark, base)
    path = {job: f"{base}/{job}" for job in (*JOBS, "ledger")}
    name = {job: f"{db}.{job}_news" for job in JOBS}
    records = feed_records(spark, sf_dir)
    total = last_page(records)
    upto = JOBS.index(last_job)
    for cfg, pages in zip(RUNS, ((total + 1) // 2, total)):
        landing = f"{base}/landing_{cfg.stamp}"
        envelopes(records.filter(F.col("page") <= pages), pages).write.json(landing)
        raw_ingestion(spark, cfg, landing, path["raw"])
        if upto >= 1:
            bronze_run(spark, cfg, path["raw"], path["bronze"], path["ledger"], name["bronze"])
        if upto >= 2:
            save_silver(spark, cfg, name["bronze"], name["silver"], path["silver"])
        if upto >= 3:
            save_gold(spark, cfg, name["silver"], name["gold"], path["gold"])
    schema = spark.table(name[last_job]).schema if upto else None
    drop_database(spark, db)
    return path[last_job], schema


# Both runs as SQL: the landed rows with run, page group and label.
_LANDED = f"""
  feed AS ({FEED_SQL}),
  totals AS (SELECT max(page) AS n, (max(page) + 1) // 2 AS half FROM feed),
  landed AS (
    SELECT feed.*, 1 AS run, '20240210_120000' AS stamp, 1 AS start, half AS total
    FROM feed, totals WHERE page <= half
    UNION ALL
    SELECT feed.*, 2, '20240305_120000', half, n FROM feed, totals WHERE page >= half),
  raw AS (
    SELECT *, greatest((page - 1) // 10 * 10 + 1, start) AS first_page,
           least((page - 1) // 10 * 10 + 10, total) AS last_page,
           greatest((page - 1) // 10 * 10 + 1, start) || ' - to - '
           || least((page - 1) // 10 * 10 + 10, total) || ' - ' || stamp AS label
    FROM landed)
"""


@query(f"""
  WITH {_LANDED}
  SELECT left(stamp, 6) AS period, 'feedpage_' || first_page || '_to_' || last_page || '_' || stamp AS folder,
         label, id, CAST(event_id AS VARCHAR) AS produto_id, imagens
  FROM raw
""")
def raw_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed pages as JSON folders; the second run resumes at the last landed page."""
    root, _ = run_layers(spark, sf_dir, "raw")
    schema = T.StructType([*RAW_SCHEMA.fields, *PARTITIONS.fields])
    return scan_paths(spark, root, schema).select(
        "period", "folder", F.col("PAGE").alias("label"), "id", "produto_id", "imagens"
    )


@query(f"""
  WITH {_LANDED}
  SELECT stamp AS dtproc, label, id, CAST(event_id AS VARCHAR) AS produto_id FROM raw
""")
def bronze_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every folder appended once, with its batch stamp."""
    path, schema = run_layers(spark, sf_dir, "bronze")
    return read_path(spark, path, schema).select(
        F.col("DTPROC").alias("dtproc"), F.col("PAGE").alias("label"), "id", "produto_id"
    )


# Newest row per id of one run's range: batch stamp, page end, publication time, then columns.
_NEWEST = """
  QUALIFY row_number() OVER (
    PARTITION BY id ORDER BY stamp DESC, last_page DESC, published DESC,
    strftime(published, '%d/%m/%Y %H:%M:%S') DESC, event_type DESC, props DESC, imagens DESC) = 1
"""
_TYPED = """
  CAST(date_trunc('month', published) AS DATE) AS "referenceMonthDate", id,
  event_type AS "newsHighlight", props AS editorials, imagens AS images,
  published AS "publicationDate", event_type || ' by ' || id AS introduction,
  'https://feed.example/items/' || event_id AS link, CAST(event_id AS VARCHAR) AS product_id,
  event_type AS products, CAST(NULL AS VARCHAR) AS "relatedProducts", event_type AS type,
  'event ' || event_id AS title
"""


def _shown(df: DataFrame) -> DataFrame:
    """Timestamps as wall clock of the feed's zone."""
    zone = RUNS[0].zone
    return df.withColumns(
        {c: wall_clock(c, zone) for c in ("publicationDate", "dateIngestion")}
    )


@query(f"""
  WITH {_LANDED}
  SELECT {_TYPED}, TIMESTAMP '2024-03-05 12:00:00' AS "dateIngestion", '202403' AS dt
  FROM raw {_NEWEST}
""")
def silver_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed rows, newest per id, moved to the partition of the run that wrote them last.

    Run two reads from the month of run one, so it updates every id.
    """
    path, schema = run_layers(spark, sf_dir, "silver")
    return _shown(read_path(spark, path, schema))


_KEYS = """
  CASE WHEN event_type = 'click' THEN CAST(event_id AS VARCHAR) END AS click,
  CASE WHEN event_type = 'error' THEN CAST(event_id AS VARCHAR) END AS error,
  json_extract_string(props, '$.k') AS k,
  CASE WHEN event_type = 'purchase' THEN CAST(event_id AS VARCHAR) END AS purchase,
  CASE WHEN event_type = 'signup' THEN CAST(event_id AS VARCHAR) END AS signup,
  CASE WHEN event_type = 'view' THEN CAST(event_id AS VARCHAR) END AS view
"""


@query(f"""
  WITH {_LANDED},
  one AS (SELECT *, TIMESTAMP '2024-02-10 12:00:00' AS ingested, '202402' AS dt FROM raw WHERE run = 1 {_NEWEST}),
  two AS (SELECT *, TIMESTAMP '2024-03-05 12:00:00' AS ingested, '202403' AS dt FROM raw {_NEWEST})
  SELECT {_TYPED}, ingested AS "dateIngestion", dt, {_KEYS}
  FROM (SELECT * FROM one UNION ALL SELECT * FROM two)
""")
def medallion_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold after two runs of all four jobs: one row per id and run month, one column per key."""
    path, schema = run_layers(spark, sf_dir, "gold")
    return _shown(read_path(spark, path, schema))


@query(f"""
  WITH {_LANDED}
  SELECT label, id, CAST(event_id AS VARCHAR) AS produto_id, imagens FROM raw
""")
def stream_ingest_available_now(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The JSON folders as a stream; a second start finds nothing new."""
    root, _ = run_layers(spark, sf_dir, "raw")
    base = new_folder(spark, "stream")
    db = new_database(spark, base)
    for _ in range(2):
        ingest_stream(
            spark, RUNS[1], f"{root}/*/*", f"{base}/bronze", f"{base}/checkpoint", f"{db}.bronze", root
        ).awaitTermination()
    drop_database(spark, db)
    rows = read_path(spark, f"{base}/bronze", BRONZE_SCHEMA)
    return rows.select(F.col("PAGE").alias("label"), "id", "produto_id", "imagens")


@query(f"""
  WITH {_LANDED}
  SELECT {_TYPED}, TIMESTAMP '2024-03-05 12:00:00' AS "dateIngestion", '202403' AS dt, 1::BIGINT AS n_read
  FROM raw {_NEWEST}
""")
def stream_medallion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed folders streamed to bronze in two runs of several micro-batches, read by silver after each: the rows of the
    batch jobs. The last micro-batch of the first run is replayed by the second."""
    base = new_folder(spark, "streamed")
    db = new_database(spark, base)
    records = feed_records(spark, sf_dir)
    total = last_page(records)
    for cfg, pages in zip(RUNS, ((total + 1) // 2, total)):
        landing = f"{base}/landing_{cfg.stamp}"
        envelopes(records.filter(F.col("page") <= pages), pages).write.json(landing)
        raw_ingestion(spark, cfg, landing, f"{base}/raw")
        streamed = (f"{base}/raw/*/*", f"{base}/bronze", f"{base}/checkpoint", f"{db}.bronze", f"{base}/raw")
        ingest_stream(spark, cfg, *streamed).awaitTermination()
        if cfg is RUNS[0]:
            # As if the driver had been lost before the checkpoint knew that its last batch was done.
            commits = f"{base}/checkpoint/commits"
            remove_path(spark, f"{commits}/{max((int(n) for n in child_names(spark, commits) if n.isdigit()), default=0)}")
        save_silver(spark, cfg, f"{db}.bronze", f"{db}.silver", f"{base}/silver")
    bronze = spark.table(f"{db}.bronze")
    n_read = bronze.groupBy("PAGE", "produto_id").count().agg(F.max("count")).first()[0]
    schema = spark.table(f"{db}.silver").schema
    drop_database(spark, db)
    return _shown(read_path(spark, f"{base}/silver", schema)).withColumn("n_read", F.lit(n_read).cast("bigint"))


@query("""
  SELECT user_id, event_id, event_type, strftime(ts, '%Y%m%d') AS dt FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
""")
def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events arriving in three parts, the oldest last, upserted per micro-batch: the newest row per
    user stays."""
    base = new_folder(spark, "stream")
    db = new_database(spark, base)
    events = table(spark, sf_dir, "events").select(
        "user_id", "event_id", "event_type", F.date_format("ts", "yyyyMMdd").alias("dt"), "ts"
    )
    day = F.col("ts").cast("date")
    parts = (day.between("2024-01-11", "2024-01-20"), day > "2024-01-20", day < "2024-01-11")
    for part in parts:
        events.filter(part).write.mode("append").parquet(f"{base}/in")
        upsert_stream(
            spark.readStream.schema(events.schema).parquet(f"{base}/in"),
            f"{db}.newest",
            f"{base}/newest",
            events.schema,
            ["user_id"],
            lambda batch: [F.col("ts").desc(), F.col("event_id").desc()],
            f"{base}/checkpoint",
        ).awaitTermination()
    schema = spark.table(f"{db}.newest").schema
    drop_database(spark, db)
    return read_path(spark, f"{base}/newest", schema).drop("ts")


_CUT = "page % 7 = 3"


@query(f"""
  SELECT page, count(*) AS n_items, bool_or({_CUT}) AS rejected FROM ({FEED_SQL}) GROUP BY page
""")
def landing_with_malformed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some pages are cut short in the landing: their text is rejected, all other records are landed."""
    base = new_folder(spark, "malformed")
    records = feed_records(spark, sf_dir)
    total = last_page(records)
    body = F.to_json(F.struct("page", "totalPages", "items"))
    cut = F.when(F.expr(_CUT), F.expr("substring(body, 1, length(body) - 5)")).otherwise(F.col("body"))
    envelopes(records, total).select("page", body.alias("body")).select(cut).write.text(f"{base}/landing")
    raw_ingestion(spark, RUNS[0], f"{base}/landing", f"{base}/raw", reject_path=f"{base}/rejects")
    schema = T.StructType([*RAW_SCHEMA.fields, *PARTITIONS.fields])
    landed = scan_paths(spark, f"{base}/raw", schema).select(
        (F.floor(F.col("produto_id").cast("long") / 100) + 1).cast("long").alias("page"), F.lit(False).alias("rejected"))
    texts = spark.read.parquet(f"{base}/rejects").select("text")
    rejected = texts.select(
        F.regexp_extract("text", '"page":([0-9]+)', 1).cast("long").alias("page"), F.lit(True).alias("rejected"),
        F.explode(F.regexp_extract_all("text", F.lit('"produto_id":'), F.lit(0))))
    return landed.union(rejected.select("page", "rejected")).groupBy("page").agg(
        F.count(F.lit(1)).alias("n_items"), F.bool_or("rejected").alias("rejected"))


@query(f"SELECT id, event_id, event_type FROM ({FEED_SQL})")
def landing_after_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run whose folders were not all renamed: the next run lands the missing pages again."""
    base = new_folder(spark, "gap")
    records = feed_records(spark, sf_dir)
    total = last_page(records)
    envelopes(records, total).write.json(f"{base}/landing")
    # What a lost run leaves: all ranges noted, but only the last folder in place.
    raw_ingestion(spark, RUNS[0], f"{base}/landing", f"{base}/whole")
    schema = T.StructType([*RAW_SCHEMA.fields, *PARTITIONS.fields])
    whole = scan_paths(spark, f"{base}/whole", schema)
    ranges = read_path(spark, f"{base}/whole_pages")
    ranges.write.partitionBy("stamp").parquet(f"{base}/raw_pages")
    last = ranges.agg(F.max("last_page")).first()[0]
    ends = folder_last_page("folder") == last
    write_folders(whole.filter(ends), f"{base}/raw")
    raw_ingestion(spark, RUNS[1], f"{base}/landing", f"{base}/raw")
    landed = scan_paths(spark, f"{base}/raw", schema).select(
        "id", F.col("produto_id").cast("long").alias("event_id"), F.col("destaque").alias("event_type"))
    return landed.distinct()


@query(f"""
  WITH {_LANDED}
  SELECT id, CAST(event_id AS VARCHAR) AS product_id FROM raw
  QUALIFY row_number() OVER (
    PARTITION BY id ORDER BY run, last_page DESC, published DESC,
    strftime(published, '%d/%m/%Y %H:%M:%S') DESC, event_type DESC, props DESC, imagens DESC) = 1
""")
def silver_backfilled_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch made up after silver's March run under a February stamp is read by the next run.

    Its rows are those of the second half of the pages, so ids known from the earlier March batch keep it.
    """
    base = new_folder(spark, "backfill")
    db = new_database(spark, base)
    records = feed_records(spark, sf_dir)
    total = last_page(records)
    half = (total + 1) // 2
    late, march = (RunConfig(datetime(2024, m, d, 15, 0, tzinfo=timezone.utc)) for m, d in ((2, 20), (3, 5)))
    again = RunConfig(datetime(2024, 3, 6, 15, 0, tzinfo=timezone.utc))
    for cfg, part, raw in ((march, F.col("page") <= half, "raw_a"), (late, F.col("page") >= half, "raw_b")):
        envelopes(records.filter(part), total if raw == "raw_b" else half).write.json(f"{base}/{raw}_landing")
        raw_ingestion(spark, cfg, f"{base}/{raw}_landing", f"{base}/{raw}")
        bronze_run(spark, cfg, f"{base}/{raw}", f"{base}/bronze", f"{base}/ledger", f"{db}.bronze")
        save_silver(spark, march if raw == "raw_a" else again, f"{db}.bronze", f"{db}.silver", f"{base}/silver")
    schema = spark.table(f"{db}.silver").schema
    drop_database(spark, db)
    return read_path(spark, f"{base}/silver", schema).select("id", "product_id")


@query("""
  SELECT event_id, CASE WHEN event_id % 2 = 1 THEN event_type END AS autor FROM events
""")
def bronze_new_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A field that only the second run's items have: bronze gets its column, older rows have null."""
    base = new_folder(spark, "field")
    db = new_database(spark, base)
    events = feed_records(spark, sf_dir).withColumn("autor", F.col("destaque"))
    even = F.col("produto_id").cast("long") % 2 == 0
    for cfg, part, raw, fields in (
        (RUNS[0], even, "raw_a", RECORD_FIELDS), (RUNS[1], ~even, "raw_b", [*RECORD_FIELDS, "autor"])):
        rows = events.filter(part)
        pages = rows.groupBy("page").agg(F.collect_list(F.struct(*fields)).alias("items"))
        pages.withColumn("totalPages", F.lit(last_page(rows))).write.json(f"{base}/{raw}_landing")
        raw_ingestion(spark, cfg, f"{base}/{raw}_landing", f"{base}/{raw}")
        bronze_run(spark, cfg, f"{base}/{raw}", f"{base}/bronze", f"{base}/ledger", f"{db}.bronze")
    schema = spark.table(f"{db}.bronze").schema
    drop_database(spark, db)
    return read_path(spark, f"{base}/bronze", schema).select(F.col("produto_id").cast("long").alias("event_id"), "autor")


_SECOND = "event_type <> 'click'"


@query(f"""
  SELECT event_id, 1 AS run, CASE WHEN event_type <> 'error' THEN event_id END AS k,
         json_extract_string(props, '$.k') AS second_k, event_type AS "Name"
  FROM events
  UNION ALL
  SELECT event_id, 2, NULL, json_extract_string(props, '$.k'), event_type FROM events WHERE {_SECOND}
""")
def gold_keys_across_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two JSON columns with the key k, over two runs: in the second the first column lacks k, and a
    key comes in another case. Every key stays in the column of its first run."""
    base = new_folder(spark, "keys")
    db = new_database(spark, base)
    events = table(spark, sf_dir, "events").withColumn("dt", F.lit("a"))
    name = f"{db}.keys"
    fixed = T.StructType().add("event_id", T.LongType()).add("run", T.IntegerType()).add("dt", T.StringType())
    for run, rows, first, key in (
        (1, events, F.when(F.col("event_type") != "error", F.to_json(F.struct(F.col("event_id").alias("k")))), "Name"),
        (2, events.filter(_SECOND), F.lit("{}"), "name")):
        named_rows = rows.select(
            "event_id", F.lit(run).alias("run"), F.lit(str(run)).alias("dt"), first.alias("one"),
            F.to_json(F.struct(F.get_json_object("props", "$.k").alias("k"), F.col("event_type").alias(key))).alias("two"))
        target = ensure_table(spark, name, f"{base}/keys", fixed, "dt")
        flat = map_pivot(json_columns_to_maps(named_rows, ["one", "two"]), fixed.names, known=known_names(target.schema))
        save_merged(flat, name, f"{base}/keys", fixed, ["event_id", "run"])
    schema = spark.table(name).schema
    drop_database(spark, db)
    out = read_path(spark, f"{base}/keys", schema)
    return out.select("event_id", "run", F.col("k").cast("long").alias("k"), F.col("two_dict_k").alias("second_k"), F.col("Name").alias("Name"))


@query("""
  SELECT event_id, user_id AS id, event_type AS autor,
         CASE WHEN event_id % 4 = 3 THEN 'other ' || event_id END AS second_autor,
         CASE WHEN event_id % 5 = 0 THEN 'no number' END AS wrong_id,
         CASE WHEN event_id % 2 = 0 THEN 'event ' || event_id END AS titulo, event_type || ' page' AS own_page
  FROM (SELECT * REPLACE (CASE WHEN event_id % 5 <> 0 THEN user_id END AS user_id) FROM events)
""")
def landing_fields_in_any_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items that spell a field in several cases, have one twice, a mistyped id, and a field named like a column of the layers.

    Every value arrives in bronze: in the field's column, or as text in UNFIT.
    """
    base = new_folder(spark, "cases")
    db = new_database(spark, base)
    records = feed_records(spark, sf_dir)
    n = F.col("produto_id").cast("long")
    name = F.element_at(F.array(F.lit("autor"), F.lit("Autor"), F.lit("AUTOR"), F.lit("autor")), (n % 4 + 1).cast("int"))
    item = F.concat(
        F.lit("{"), F.when(n % 5 == 0, F.lit('"id":"no number"')).otherwise(F.concat(F.lit('"id":'), F.col("id").cast("string"))),
        F.lit(',"produto_id":"'), "produto_id", F.lit('","'), name, F.lit('":"'), "destaque", F.lit('"'),
        F.when(n % 4 == 3, F.concat(F.lit(',"AUTOR":"other '), "produto_id", F.lit('"'))).otherwise(F.lit("")),
        F.when(n % 2 == 0, F.concat(F.lit(',"Titulo":"'), "titulo", F.lit('"'))).otherwise(F.lit("")),
        F.lit(',"Page":"'), "destaque", F.lit(' page"}'))
    pages = records.select("page", item.alias("item")).groupBy("page").agg(F.array_join(F.collect_list("item"), ",").alias("items"))
    text = F.concat(F.lit('{"page":'), F.col("page").cast("string"), F.lit(f',"totalPages":{last_page(records)},"items":['), "items", F.lit("]}"))
    pages.select(text).write.text(f"{base}/landing")
    raw_ingestion(spark, RUNS[0], f"{base}/landing", f"{base}/raw")
    bronze_run(spark, RUNS[0], f"{base}/raw", f"{base}/bronze", f"{base}/ledger", f"{db}.bronze")
    schema = spark.table(f"{db}.bronze").schema
    drop_database(spark, db)
    unfit = F.from_json("UNFIT", "map<string,string>")
    return read_path(spark, f"{base}/bronze", schema).select(
        F.col("produto_id").cast("long").alias("event_id"), "id", "autor", unfit["AUTOR"].alias("second_autor"),
        unfit["id"].alias("wrong_id"), "titulo", F.col("item_Page").alias("own_page"))


@query(f"""
  WITH {_LANDED},
  folders AS (SELECT DISTINCT first_page, last_page FROM raw WHERE run = 1),
  loads AS (SELECT first_page, (row_number() OVER (ORDER BY first_page) - 1) // 3 AS load FROM folders)
  SELECT load::BIGINT AS load, count(*) AS n_rows, sum(event_id)::BIGINT AS id_sum FROM raw JOIN loads USING (first_page)
  WHERE run = 1 GROUP BY load
""")
def bronze_backlog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A backlog appended three folders at a time: every load a batch of its own, in the order of the pages."""
    base = new_folder(spark, "backlog")
    db = new_database(spark, base)
    records = feed_records(spark, sf_dir)
    half = (last_page(records) + 1) // 2
    envelopes(records.filter(F.col("page") <= half), half).write.json(f"{base}/landing")
    raw_ingestion(spark, RUNS[0], f"{base}/landing", f"{base}/raw")
    bronze_run(spark, RUNS[0], f"{base}/raw", f"{base}/bronze", f"{base}/ledger", f"{db}.bronze", folders_per_load=3)
    schema = spark.table(f"{db}.bronze").schema
    drop_database(spark, db)
    rows = read_path(spark, f"{base}/bronze", schema)
    per_load = rows.groupBy("DTPROC").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.col("produto_id").cast("long")).alias("id_sum"))
    # A load takes the next second that no batch has.
    seconds = lambda stamp: F.unix_timestamp(stamp, STAMP_FORMAT)
    load = seconds(F.col("DTPROC")) - seconds(F.lit(RUNS[0].stamp))
    return per_load.select(load.alias("load"), "n_rows", "id_sum")
