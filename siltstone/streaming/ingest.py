"""JSON folders to bronze as a stream: each file once, each micro-batch a partition that silver reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from siltstone.config import RunConfig
from siltstone.schemas import BRONZE_SCHEMA, UNFIT
from siltstone.sources.fields import noted_fields, record_columns, row_schema
from siltstone.sources.listing import child_names, few_listing_tasks, glob_count, make_folder
from siltstone.sources.swaps import partitions_of
from siltstone.sources.tables import add_columns, append_batch, ensure_table, refresh_partitions

#: A start takes a backlog in about so many triggers, each of at most so many batches of files.
TRIGGERS, BATCHES_PER_TRIGGER = 64, 64


def raw_stream(
    spark: SparkSession,
    glob: str,
    max_files: int | None = 10,
    max_bytes: str | None = None,
    *carry: Column,
) -> DataFrame:
    """Stream of the JSON lines (``value``) below a wildcard, at most ``max_files`` per micro-batch, with ``carry`` columns.

    For a large feed give ``max_bytes`` (such as ``"500g"``) and no file limit.
    """
    reader = spark.readStream
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    elif max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    with few_listing_tasks(spark):
        return reader.text(glob).select("value", *carry)


def batches_per_trigger(spark: SparkSession, glob: str, bronze_path: str, files_per_batch: int) -> int:
    """How many batches of files a trigger takes: one, or more when the folders not taken yet would make many triggers.

    A trigger has a cost of its own, whatever it holds. The folders below ``glob`` stand for files, each partition of bronze for a
    batch: the number of triggers is a matter of time only.
    """
    waiting = glob_count(spark, glob) - files_per_batch * len(partitions_of(spark, bronze_path, "DTPROC"))
    return max(1, min(BATCHES_PER_TRIGGER, waiting // (files_per_batch * TRIGGERS)))


def batch_partition(
    spark: SparkSession, notes: str, query_id: str, batch_id: int, stamp: str, known: list[str] | None = None,
    files_per_batch: int | None = None,
) -> str:
    """The DTPROC of a micro-batch: the run's stamp and the batch's number, chosen once.

    The choice is noted, as the name of an empty folder, before the batch is written. A batch that is replayed by a later run
    finds the note and replaces its own partition, whatever that run's stamp is. ``known``, the notes listed when the stream
    started, spares a listing per batch; a new note is added to it.

    With ``files_per_batch`` the micro-batch is to be divided: that number is the last part of the choice, so a replay divides
    its files as before.
    """
    start = f"{query_id}.{batch_id}="
    names = child_names(spark, notes) if known is None else known
    noted = [name for name in names if name.startswith(start)]
    if noted:
        return min(noted).removeprefix(start)
    value = f"{stamp}.{batch_id:08d}" + ("" if files_per_batch is None else f".{files_per_batch}")
    make_folder(spark, f"{notes}/{start}{value}")
    if known is not None:
        known.append(f"{start}{value}")
    return value


def append_divided(rows: DataFrame, bronze_path: str, stamp: str, files_per_batch: int) -> list[str]:
    """Write ``rows`` to a partition for every so many files, the oldest first; returns the partitions.

    ``rows`` have their ``__file`` and its time ``__at``. The files of a micro-batch are always the same, so a replay makes the
    same partitions.
    """
    rows = rows.persist()
    try:
        # At most BATCHES_PER_TRIGGER batches of names.
        files = [r[0] for r in rows.select("__file", "__at").distinct().orderBy("__at", "__file").collect()]
        if not files:
            return []
        at = [(file, f"{stamp}.{n // files_per_batch:04d}") for n, file in enumerate(files)]
        of_file = rows.sparkSession.createDataFrame(at, "__file string, DTPROC string")
        stamped = rows.drop("__at").join(F.broadcast(of_file), "__file").drop("__file")
        append_batch(stamped.hint("rebalance", "DTPROC"), bronze_path, "DTPROC")
    finally:
        rows.unpersist()
    return sorted({value for _, value in at})


def ingest_stream(
    spark: SparkSession,
    cfg: RunConfig,
    glob: str,
    bronze_path: str,
    checkpoint: str,
    name: str,
    raw_root: str | None = None,
    schema: T.StructType | None = None,
    max_bytes: str | None = None,
) -> StreamingQuery:
    """Append all files not seen before to the bronze table ``name``, then stop.

    Each micro-batch is written to the partition of its own stamp, which replaces what an earlier attempt at the same batch has
    written, and is registered then: readers by name, silver among them, see whole batches only. Micro-batches of one
    run count as one load where the newest row of an id is chosen.

    A batch holds ``folders_per_batch`` files. Of a long backlog a micro-batch takes several batches (``batches_per_trigger``)
    and writes the partitions of all of them at once.

    Columns are those of ``schema``, or the declared ones and the fields that landings under ``raw_root`` have noted;
    all other values are kept in ``UNFIT``. The batch job may follow the stream, whose batches it finds. A stream does not
    know which folders the batch job took, so it must not follow it on the same folders.
    """
    if schema is None:
        schema = row_schema(spark, noted_fields(spark, raw_root) if raw_root else [])
    full = T.StructType([*schema.fields, BRONZE_SCHEMA[UNFIT], BRONZE_SCHEMA["DTPROC"]])
    table = ensure_table(spark, name, bronze_path, full, "DTPROC")
    have = {c.lower() for c in table.columns}
    add_columns(spark, name, [f for f in full if f.name.lower() not in have])
    notes = f"{bronze_path.rstrip('/')}_batches"
    # Listed once per start: only this stream adds notes while it runs.
    known = list(child_names(spark, notes))

    per_batch = cfg.folders_per_batch
    width = 1 if max_bytes is not None or per_batch is None else batches_per_trigger(spark, glob, bronze_path, per_batch)
    divide = per_batch if width > 1 else None

    def append(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        query_id = session.sparkContext.getLocalProperty("sql.streaming.queryId")
        stamp = batch_partition(session, notes, query_id, batch_id, cfg.stamp, known, divide)
        value, number, *files = stamp.split(".")
        if files:
            rows = record_columns(session, batch, schema, "__file", "__at")
            stamps = append_divided(rows, bronze_path, f"{value}.{number}", int(files[0]))
        else:
            rows = record_columns(session, batch, schema)
            rows.write.mode("overwrite").parquet(f"{bronze_path}/DTPROC={stamp}")
            stamps = [stamp]
        # In the caller's session, which may have listed the files of an earlier attempt.
        refresh_partitions(spark, name, "DTPROC", stamps)

    origin = (F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_modification_time").alias("__at"))
    lines = raw_stream(spark, glob, per_batch if width == 1 else width * per_batch, max_bytes, *origin)
    writer = lines.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()
