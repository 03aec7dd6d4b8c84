import json
from datetime import date, datetime, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from siltstone import RunConfig
from siltstone.plans import bronze as bronze_plan
from siltstone.plans import landing
from siltstone.plans.bronze import bronze_run
from siltstone.plans.gold import save_gold, silver_range
from siltstone.plans.landing import raw_ingestion
from siltstone.plans.silver import save_silver, silver_start
from siltstone.schemas import BRONZE_SCHEMA, SILVER_SCHEMA
from siltstone.sources import fields
from siltstone.sources.json_folders import list_folders, scan_period
from siltstone.sources.tables import ensure_table, read_path
from siltstone.streaming import ingest as ingest_module
from siltstone.streaming.ingest import ingest_stream
from siltstone.streaming.upsert import upsert_stream


def cfg(month, day=10, hour=15, **options):
    return RunConfig(datetime(2024, month, day, hour, tzinfo=timezone.utc), **options)


def item(key, text="01/01/2024 10:00:00", **fields):
    return {"id": key, "data_publicacao": text, **fields}


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


class Layers:
    def __init__(self, spark, root, db):
        self.spark, self.root, self.db = spark, root, db
        self.raw, self.bronze, self.ledger = (f"{root}/{n}" for n in ("raw", "bronze", "ledger"))
        self.silver, self.gold = f"{root}/silver", f"{root}/gold"

    def land(self, run, pages):
        """pages: {page: items}; the highest page number is the feed's total."""
        folder = Path(self.root, f"landing_{run.stamp}")
        folder.mkdir()
        for page, items in pages.items():
            body = {"page": page, "totalPages": max(pages), "items": items}
            (folder / f"{page}.json").write_text(json.dumps(body))
        return raw_ingestion(self.spark, run, str(folder), self.raw)

    def load_bronze(self, run, **options):
        return bronze_run(
            self.spark, run, self.raw, self.bronze, self.ledger, f"{self.db}.bronze", **options)

    def load_silver(self, run, **options):
        return save_silver(self.spark, run, f"{self.db}.bronze", f"{self.db}.silver", self.silver, **options)

    def load_gold(self, run, **options):
        return save_gold(self.spark, run, f"{self.db}.silver", f"{self.db}.gold", self.gold, **options)

    def run(self, run, pages):
        self.land(run, pages)
        self.load_bronze(run)
        self.load_silver(run)
        return self.load_gold(run)

    def table(self, name):
        return self.spark.table(f"{self.db}.{name}")


@pytest.fixture
def layers(spark, db, folder):
    return Layers(spark, folder, db)


def test_landing_resumes_at_the_last_page(layers, spark):
    first, second, third = cfg(1), cfg(2), cfg(3)
    pages = {p: [item(p * 10), item(p * 10 + 1)] for p in range(1, 13)}
    assert layers.land(first, pages) == 1
    pages[12].append(item(122))  # the last page grew
    pages.update({p: [item(p * 10)] for p in range(13, 16)})
    assert layers.land(second, pages) == 12
    assert rows(list_folders(spark, layers.raw)) == [
        ("202401", "feedpage_11_to_12_20240110_120000"),
        ("202401", "feedpage_1_to_10_20240110_120000"),
        ("202402", "feedpage_12_to_15_20240210_120000"),
    ]
    grown = scan_period(spark, layers.raw, "202402")
    assert rows(grown.select("id")) == [(120,), (121,), (122,), (130,), (140,), (150,)]
    assert rows(grown.select("PAGE").distinct()) == [("12 - to - 15 - 20240210_120000",)]
    # a shorter feed than what was landed: nothing is written
    assert layers.land(third, {1: [item(1)]}) == 15
    assert list_folders(spark, layers.raw, "202403").count() == 0


def test_bronze_takes_each_folder_once(layers):
    layers.land(cfg(1), {p: [item(p)] for p in range(1, 25)})
    assert layers.load_bronze(cfg(1)) == 3
    assert layers.load_bronze(cfg(1, hour=16)) == 0
    layers.land(cfg(1, hour=17), {p: [item(p)] for p in range(1, 27)})
    assert layers.load_bronze(cfg(1, hour=18)) == 1
    assert rows(layers.table("bronze").groupBy("DTPROC").count()) == [
        ("20240110_120000", 24), ("20240110_150000", 3)]
    assert layers.table("bronze").columns == BRONZE_SCHEMA.names


def test_folder_known_only_to_the_ledger_is_no_work(layers, spark):
    layers.land(cfg(1), {1: [item(1)]})
    layers.load_bronze(cfg(1))
    assert layers.load_bronze(cfg(2), period="202402") == 0
    assert layers.load_bronze(cfg(2), period="202401") == 0


def test_batches_of_one_run_do_not_share_a_partition(layers):
    layers.land(cfg(1), {1: [item(1)]})
    layers.land(cfg(2), {1: [item(1)], 2: [item(2)]})
    run = cfg(3)
    assert [layers.load_bronze(run, period=p) for p in ("202401", "202402")] == [1, 1]
    assert rows(layers.table("bronze").groupBy("DTPROC").count()) == [
        ("20240310_120000", 1), ("20240310_120001", 2)]
    assert [layers.load_bronze(run, period=p) for p in ("202401", "202402")] == [0, 0]


def test_run_lost_before_its_ledger_entry_is_not_appended_again(layers, spark):
    layers.land(cfg(1), {1: [item(1)], 2: [item(2)]})
    layers.load_bronze(cfg(1))
    lost = f"{layers.root}/lost_ledger"  # as if the ledger had never been written
    again = bronze_run(spark, cfg(1, hour=16), layers.raw, layers.bronze, lost, f"{layers.db}.bronze")
    assert again == 0 and layers.table("bronze").count() == 2


def test_failed_append_leaves_the_folders_pending(layers, monkeypatch):
    def fail(*args):
        raise RuntimeError("no space")

    layers.land(cfg(1), {1: [item(1)]})
    with monkeypatch.context() as patch:
        patch.setattr(bronze_plan, "append_batch", fail)
        with pytest.raises(RuntimeError):
            layers.load_bronze(cfg(1))
    assert layers.load_bronze(cfg(1)) == 1


def test_backlog_lost_in_one_load_repeats_only_that(layers, spark, monkeypatch):
    layers.land(cfg(1), {p: [item(p)] for p in range(1, 46)})
    real, calls = bronze_plan.append_batch, []

    def fail(df, path, partition):
        calls.append(path)
        if calls.count(layers.bronze) == 3:
            raise RuntimeError("lost")
        real(df, path, partition)

    with monkeypatch.context() as patch:
        patch.setattr(bronze_plan, "append_batch", fail)
        with pytest.raises(RuntimeError):
            layers.load_bronze(cfg(1), folders_per_load=2)
    assert layers.table("bronze").count() == 40 and layers.table("bronze").agg(F.max("id")).first()[0] == 40
    assert layers.load_bronze(cfg(2), period="202401", folders_per_load=2) == 1
    counts = rows(layers.table("bronze").groupBy("DTPROC").count())
    assert counts == [("20240110_120000", 20), ("20240110_120001", 20), ("20240210_120000", 5)]
    assert rows(layers.table("bronze").select("id")) == [(k,) for k in sorted(range(1, 46), key=lambda k: repr((k,)))]


def test_backlog_reads_the_period_once_for_all_loads(layers, monkeypatch):
    layers.land(cfg(1), {p: [item(p)] for p in range(1, 46)})
    real, calls = bronze_plan.period_lines, []

    def count(*args):
        calls.append(args)
        return real(*args)

    monkeypatch.setattr(bronze_plan, "period_lines", count)
    assert layers.load_bronze(cfg(1), folders_per_load=2) == 5
    assert len(calls) == 1
    counts = rows(layers.table("bronze").groupBy("DTPROC").count())
    assert counts == [("20240110_120000", 20), ("20240110_120001", 20), ("20240110_120002", 5)]


def test_many_loads_share_an_append_and_a_lost_append_is_undone(layers, spark, monkeypatch):
    monkeypatch.setattr(bronze_plan, "APPENDS", 2, raising=False)
    run = cfg(1, pages_per_folder=1)
    layers.land(run, {p: [item(p)] for p in range(1, 6)})
    real, calls = bronze_plan.append_batch, []

    def lose(df, path, partition):
        real(df, path, partition)
        calls.append(path)
        if calls.count(layers.bronze) == 2:  # a later load is in its place, an earlier one is not
            Path(layers.bronze, "DTPROC=20240110_120003").rename(Path(layers.root, "nowhere"))
            raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(bronze_plan, "append_batch", lose)
        with pytest.raises(RuntimeError):
            layers.load_bronze(run, folders_per_load=1)
    by_load = lambda: rows(layers.table("bronze").select("id", "DTPROC"))
    assert by_load() == [(p, f"20240110_12000{p - 1}") for p in range(1, 4)]
    calls.clear()
    monkeypatch.setattr(bronze_plan, "append_batch", lambda *a: calls.append(a[1]) or real(*a))
    assert layers.load_bronze(run, folders_per_load=1) == 2
    assert by_load() == [(p, f"20240110_12000{p - 1}") for p in range(1, 6)]
    assert layers.load_bronze(run, folders_per_load=1) == 0 and calls.count(layers.bronze) == 2


def test_stamps_of_many_loads_skip_those_in_use():
    used = bronze_plan.batch_stamps(cfg(1), [], 6000)[::2]
    got = bronze_plan.batch_stamps(cfg(1), used, 6000)
    assert got == sorted(got) and len(set(got) | set(used)) == 9000 and got[0] == "20240110_120001"


def test_silver_types_and_keeps_the_newest(layers):
    run = cfg(1)
    layers.land(run, {
        1: [item(1, titulo="page 1"), item(2, "31/12/2023 23:59:59", imagens='{"a": 1}', tipo="T")],
        11: [item(1, titulo="page 11"), item(3, "99/99/2024 00:00:00")],
        12: [item(4, None)],
    })
    layers.load_bronze(run)
    layers.load_silver(run)
    silver = layers.table("silver").orderBy("id")
    assert silver.columns == SILVER_SCHEMA.names
    got = [(r.id, r.title, r.referenceMonthDate, r.images, r.type, r.dt) for r in silver.collect()]
    assert got == [
        (1, "page 11", date(2024, 1, 1), None, None, "202401"),
        (2, None, date(2023, 12, 1), '{"a": 1}', "T", "202401"),
        (3, None, None, None, None, "202401"),
        (4, None, None, None, None, "202401"),
    ]
    second = silver.filter("id = 2").select(F.unix_timestamp("publicationDate"), F.unix_timestamp("dateIngestion"))
    assert tuple(second.first()) == (
        int(datetime(2024, 1, 1, 2, 59, 59, tzinfo=timezone.utc).timestamp()), int(run.run_ts.timestamp()))


def test_silver_moves_an_updated_id_to_the_new_month(layers):
    layers.run(cfg(1), {1: [item(1, titulo="old"), item(2, titulo="kept")]})
    before = rows(layers.table("silver").select("id", "title", "dt"))
    assert before == [(1, "old", "202401"), (2, "kept", "202401")]
    layers.land(cfg(3), {1: [item(1, titulo="new")]})
    layers.load_bronze(cfg(3))
    # the range starts at the month of silver's newest ingestion, so both batches are read
    assert layers.load_silver(cfg(3)) == ["202401", "202403"]
    assert rows(layers.table("silver").select("id", "title", "dt")) == [
        (1, "new", "202403"), (2, "kept", "202403")]
    # the next run starts at March: id 2 is not seen any more and stays
    layers.land(cfg(4), {1: [item(1, titulo="newest")]})
    layers.load_bronze(cfg(4))
    layers.load_silver(cfg(4))
    assert rows(layers.table("silver").select("id", "title", "dt")) == [
        (1, "newest", "202404"), (2, "kept", "202403")]
    assert layers.load_silver(cfg(4, hour=16)) == ["202404"]  # same batch again: nothing else changes
    assert layers.table("silver").count() == 2


def test_rows_without_id_are_added_each_run_or_rejected(layers, spark):
    layers.land(cfg(1), {1: [item(None, titulo="x"), item(None, titulo="y"), item(5)]})
    layers.load_bronze(cfg(1))
    layers.load_silver(cfg(1))
    layers.load_silver(cfg(1, hour=16))
    assert layers.table("silver").filter("id is null").count() == 2
    rejects = f"{layers.root}/rejects"
    layers.load_silver(cfg(1, hour=17), reject_path=rejects)
    assert layers.table("silver").filter("id is null").count() == 2
    assert rows(spark.read.parquet(rejects).select("title")) == [("x",), ("y",)]
    layers.load_silver(cfg(1, hour=18), reject_path=rejects)  # the same batch again: no more rejects
    assert spark.read.parquet(rejects).count() == 2


def test_silver_start(spark):
    run, batches = cfg(1), ["20231215_101010", "20240105_101010"]
    none = spark.createDataFrame([(None,)], "hi timestamp")
    assert silver_start(run, none, batches) == date(2023, 12, 1)
    assert silver_start(run, none, []) == date(2024, 1, 3)
    # 01:00 UTC on 1 February is still January on the feed's clock
    late = spark.createDataFrame([(datetime(2024, 2, 1, 1, tzinfo=timezone.utc),)], "hi timestamp")
    assert silver_start(run, late, batches) == date(2024, 1, 1)


def test_jobs_put_small_files_together(layers, spark):
    layers.land(cfg(1, pages_per_folder=1), {p: [item(p)] for p in range(1, 13)})
    layers.load_bronze(cfg(1, small_files=4))
    assert len(list(Path(layers.bronze).rglob("_v/*/DTPROC=*/*.parquet"))) == 1
    assert layers.load_bronze(cfg(1, hour=16)) == 0
    assert layers.table("bronze").count() == 12
    layers.load_silver(cfg(1, small_files=2))
    assert layers.table("silver").count() == 12
    lost = f"{layers.root}/lost_ledger"
    assert bronze_run(spark, cfg(1, hour=17), layers.raw, layers.bronze, lost, f"{layers.db}.bronze") == 0


def test_gold_has_a_row_per_id_and_month_and_a_column_per_key(layers, spark):
    layers.run(cfg(1), {1: [item(1, imagens='{"a": 1}'), item(2, imagens='{"b": {"c": 1}}')]})
    assert layers.table("gold").columns == [*SILVER_SCHEMA.names[:-1], "a", "b", "dt"]
    assert layers.run(cfg(2), {1: [item(1, imagens='{"z": 3}')]}) == ["202402"]
    got = layers.table("gold").select("id", "dt", "a", "b", "z")
    assert rows(got) == sorted([
        (1, "202401", "1", None, None), (2, "202401", None, '{"c":1}', None),
        (1, "202402", None, None, "3"), (2, "202402", None, '{"c":1}', None)], key=repr)
    # the same month again: updated in place; a key the run does not produce keeps its value
    layers.land(cfg(2, day=11), {1: [item(1, imagens='{"a": 7}'), item(2, imagens="oops")]})
    for step in (layers.load_bronze, layers.load_silver, layers.load_gold):
        step(cfg(2, day=11))
    assert rows(layers.table("gold").filter("dt = '202402'").select("id", "a", "b", "z")) == [
        (1, "7", None, "3"), (2, None, '{"c":1}', None)]
    assert layers.table("gold").groupBy("id", "dt").count().filter("count > 1").count() == 0
    assert rows(read_path(spark, layers.gold, layers.table("gold").schema).select("id", "dt")) == rows(
        layers.table("gold").select("id", "dt"))


def test_runs_without_rows(layers, spark):
    assert layers.load_bronze(cfg(1)) == 0
    layers.load_silver(cfg(1))
    layers.load_gold(cfg(1))
    assert layers.table("silver").count() == layers.table("gold").count() == 0
    layers.run(cfg(2), {1: [item(1)]})
    layers.load_silver(cfg(4, day=1, hour=1))  # nothing new in bronze since
    assert rows(layers.table("silver").select("id", "dt")) == [(1, "202403")]
    assert rows(layers.table("gold").select("id", "dt")) == [(1, "202402")]


def test_gold_reads_only_the_months_of_its_range(layers):
    layers.run(cfg(1), {1: [item(1)]})
    layers.land(cfg(3), {1: [item(2)]})
    layers.load_bronze(cfg(3))
    chosen = silver_range(layers.table("silver"), cfg(3), date(2024, 2, 1))
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan
    assert chosen.count() == 0


def test_stream_gives_the_rows_of_the_batch_job(layers, spark):
    layers.land(cfg(1), {p: [item(p, autor=f"a{p}")] for p in range(1, 25)})
    layers.load_bronze(cfg(1))
    path, name = f"{layers.root}/streamed", f"{layers.db}.streamed"

    def start(run):
        query = ingest_stream(spark, run, f"{layers.raw}/*/*", path, f"{layers.root}/checkpoint", name, layers.raw)
        query.awaitTermination()
        return sum(p["numInputRows"] for p in query.recentProgress)

    run = cfg(1, folders_per_batch=2)
    assert start(run) == 24
    assert start(run) == 0
    columns = [c for c in BRONZE_SCHEMA.names if c != "DTPROC"] + ["autor"]
    assert rows(spark.table(name).select(*columns)) == rows(layers.table("bronze").select(*columns))
    assert [r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()] == [
        "DTPROC=20240110_120000.00000000", "DTPROC=20240110_120000.00000001"]
    # The batch job finds nothing that the stream has not taken, though the ledger knows nothing of it.
    again = bronze_run(spark, cfg(1, hour=16), layers.raw, path, f"{layers.root}/no_ledger", name)
    assert again == 0
    layers.land(cfg(2), {p: [item(p)] for p in range(1, 26)})
    assert start(cfg(2)) == 2
    save_silver(spark, cfg(2), name, f"{layers.db}.silver", layers.silver)
    layers.load_bronze(cfg(2))
    batch = f"{layers.root}/silver_of_batch"
    save_silver(spark, cfg(2), f"{layers.db}.bronze", f"{layers.db}.other", batch)
    assert rows(layers.table("silver")) == rows(layers.table("other")) and layers.table("silver").count() == 25


def test_replayed_micro_batch_keeps_its_partition(layers, spark):
    layers.land(cfg(1), {p: [item(p)] for p in range(1, 6)})
    path, name, checkpoint = f"{layers.root}/streamed", f"{layers.db}.streamed", Path(layers.root, "checkpoint")

    def start(run):
        ingest_stream(spark, run, f"{layers.raw}/*/*", path, str(checkpoint), name).awaitTermination()

    start(cfg(1))
    for file in (checkpoint / "commits").iterdir():
        file.unlink()  # lost before the checkpoint knew that the batch was done
    start(cfg(2))
    assert rows(spark.table(name).groupBy("DTPROC").count()) == [("20240110_120000.00000000", 5)]


def test_stream_lists_its_batch_notes_once_per_start(layers, spark, monkeypatch):
    run = cfg(1, pages_per_folder=1, folders_per_batch=1)
    layers.land(run, {p: [item(p)] for p in range(1, 6)})
    path, name = f"{layers.root}/streamed", f"{layers.db}.streamed"
    real, listed = ingest_module.child_names, []

    def count(session, folder):
        listed.append(folder)
        return real(session, folder)

    monkeypatch.setattr(ingest_module, "child_names", count)
    ingest_stream(spark, run, f"{layers.raw}/*/*", path, f"{layers.root}/checkpoint", name).awaitTermination()
    assert listed == [f"{path}_batches"]
    assert rows(spark.table(name).groupBy("DTPROC").count()) == [
        (f"20240110_120000.{n:08d}", 1) for n in range(5)]


def test_trigger_of_several_batches_writes_a_partition_for_each(layers, spark, monkeypatch):
    monkeypatch.setattr(ingest_module, "TRIGGERS", 1, raising=False)
    options = {"pages_per_folder": 1, "folders_per_batch": 2}
    layers.land(cfg(1, **options), {p: [item(p)] for p in range(1, 6)})
    path, name, checkpoint = f"{layers.root}/streamed", f"{layers.db}.streamed", Path(layers.root, "checkpoint")

    def start(run):
        query = ingest_stream(spark, run, f"{layers.raw}/*/*", path, str(checkpoint), name)
        query.awaitTermination()
        return [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]

    # Two of the three batches fill a trigger.
    assert start(cfg(1, **options)) == [4, 1]
    once = rows(spark.table(name).select("DTPROC", "id"))
    assert rows(spark.table(name).groupBy("DTPROC").count()) == [
        ("20240110_120000.00000000.0000", 2), ("20240110_120000.00000000.0001", 2), ("20240110_120000.00000001.0000", 1)]
    for file in (checkpoint / "commits").iterdir():
        file.unlink()
    # A replay divides the files as the first attempt did, whatever its own run says.
    start(cfg(2, folders_per_batch=1))
    assert rows(spark.table(name).select("DTPROC", "id")) == once
    assert rows(spark.table(name).select("id")) == [(p,) for p in range(1, 6)]
    layers.land(cfg(2), {p: [item(p)] for p in range(1, 7)})
    assert start(cfg(2, folders_per_batch=10)) == [2]
    assert "20240210_120000.00000002" in {r.DTPROC for r in spark.table(name).select("DTPROC").distinct().collect()}


def test_stream_upsert_keeps_the_newest(layers, spark):
    path, source = f"{layers.root}/newest", f"{layers.root}/in"
    schema = "id long, v string, t int, dt string"
    order = lambda batch: [F.col("t").desc()]
    for data in ([(1, "a", 1, "x"), (1, "b", 2, "x"), (2, "c", 1, "y")], [(1, "d", 3, "y")]):
        spark.createDataFrame(data, schema).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        for _ in range(2):  # the second start finds nothing
            upsert_stream(stream, f"{layers.db}.newest", path, spark.read.parquet(source).schema,
                          ["id"], order, f"{layers.root}/cp").awaitTermination()
    assert rows(layers.table("newest")) == [(1, "d", 3, "y"), (2, "c", 1, "y")]


# fields


def land_text(layers, spark, run, *pages):
    folder = Path(layers.root, f"landing_{run.stamp}")
    folder.mkdir()
    (folder / "pages.json").write_text("\n".join(pages))
    return raw_ingestion(spark, run, str(folder), layers.raw)


def test_no_value_of_a_landed_item_is_lost(layers, spark):
    land_text(layers, spark, cfg(1),
              '{"page":1,"totalPages":2,"items":[{"id":1,"autor":"a"},{"id":2,"Autor":"b","AUTOR":"c"},{"id":"x9","Titulo":"t"}]}',
              '{"page":2,"totalPages":2,"items":[{"id":"7","autor":"","imagens":{"a":[1.50]}},{"PAGE":"own","unfit":1,"dtproc":[2]},null]}')
    layers.load_bronze(cfg(1))
    bronze = layers.table("bronze")
    assert bronze.columns == [*BRONZE_SCHEMA.names[:-2], "autor", "item_dtproc", "item_PAGE", "item_unfit", "UNFIT", "DTPROC"]
    got = bronze.select("id", "titulo", "autor", "imagens", "item_PAGE", "item_unfit", "item_dtproc", "UNFIT", "PAGE")
    label = "1 - to - 2 - 20240110_120000"
    assert rows(got) == sorted([
        (1, None, "a", None, None, None, None, None, label), (2, None, "b", None, None, None, None, '{"AUTOR":"c"}', label),
        (None, "t", None, None, None, None, None, '{"id":"x9"}', label), (7, None, "", '{"a":[1.5]}', None, None, None, None, label),
        (None, None, None, None, "own", "1", "[2]", None, label), (None, None, None, None, None, None, None, None, label)], key=repr)
    # A later landing spells the field otherwise: same column.
    land_text(layers, spark, cfg(2), '{"page":2,"totalPages":2,"items":[{"id":8,"AUTOR":"d"}]}')
    layers.load_bronze(cfg(2))
    assert layers.table("bronze").columns == bronze.columns
    assert rows(layers.table("bronze").filter("id = 8").select("autor", "UNFIT")) == [("d", None)]


def test_fields_beyond_the_limit_and_lines_that_are_no_json(spark):
    lines = spark.createDataFrame([('{"id":1,"b":"","z":5}',), ('{"id"',), (" ",)], "value string")
    got = fields.record_columns(spark, lines, fields.row_schema(spark, ["b"]))
    assert rows(got.select("id", "b", "UNFIT")) == sorted([(1, "", '{"z":"5"}'), (None, None, '{"id"')], key=repr)


def test_items_that_are_no_objects_make_a_page_malformed(layers, spark):
    page = '{"page":1,"totalPages":1,"items":[{"id":1},5]}'
    with pytest.raises(ValueError, match="1 malformed"):
        land_text(layers, spark, cfg(1), page)
    assert list_folders(spark, layers.raw).count() == 0


def test_case_sensitive_names_stay_apart(spark):
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        lines = spark.createDataFrame([('{"autor":"a","Autor":"b"}',)], "value string")
        got = fields.record_columns(spark, lines, fields.row_schema(spark, ["autor", "Autor"]))
        assert rows(got.select("autor", "Autor", "UNFIT")) == [("a", "b", None)]
    finally:
        spark.conf.unset("spark.sql.caseSensitive")


# gaps


def lose(layers, *folders):
    for name in folders:
        path = next(Path(layers.raw).rglob(f"folder={name}"))
        for file in path.iterdir():
            file.unlink()
        path.rmdir()


def test_a_gap_stays_open_until_its_pages_have_landed(layers, spark):
    pages = {p: [item(p)] for p in range(1, 41)}
    layers.land(cfg(1), pages)
    lose(layers, "feedpage_11_to_20_20240110_120000")
    # The next landing lacks pages 13 to 17, though its group is labelled with them.
    some = {p: i for p, i in pages.items() if not 13 <= p <= 17}
    assert layers.land(cfg(2), some) == 11
    assert ("202402", "feedpage_11_to_20_20240210_120000") in rows(list_folders(spark, layers.raw))
    assert layers.land(cfg(3), {p: i for p, i in pages.items() if p != 15}) == 13
    assert layers.land(cfg(4), pages) == 15
    assert layers.land(cfg(5), pages) == 40
    landed = scan_period(spark, layers.raw, "202404").union(scan_period(spark, layers.raw, "202403"))
    assert {r[0] for r in landed.select("id").collect()} >= set(range(13, 18))


def test_closed_runs_are_not_looked_at_again(layers, spark, monkeypatch):
    pages = {p: [item(p)] for p in range(1, 12)}
    layers.land(cfg(1), pages)
    layers.land(cfg(2), pages)
    layers.land(cfg(3), pages)
    seen = []
    monkeypatch.setattr(landing, "list_folders", lambda spark, root, period: seen.append(period) or list_folders(spark, root, period))
    assert landing.first_gap(spark, layers.raw, "feedpage") is None and seen == ["202403"]
    assert landing.first_gap(spark, layers.raw, "feedpage") is None and seen == ["202403"]


def test_uncovered_ranges(spark):
    def ranges(*pairs):
        return spark.createDataFrame(list(pairs), "from_page bigint, to_page bigint")

    got = landing.uncovered(ranges((1, 10), (20, 30), (40, 50)), ranges((2, 3), (3, 5), (7, 7), (10, 22), (24, 24), (24, 35), (39, 60)))
    assert rows(got) == [(1, 1), (23, 23), (6, 6), (8, 9)]
    assert rows(landing.uncovered(ranges((5, 6)), ranges((1, 2)))) == [(5, 6)]
