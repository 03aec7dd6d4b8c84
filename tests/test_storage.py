import json
from datetime import datetime, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.schemas import RAW_SCHEMA, SILVER_SCHEMA
from siltstone.scratch import materialize, new_folder, scratch_root
from siltstone.sources import json_folders, swaps, tables
from siltstone.sources.listing import child_names
from siltstone.sources.envelopes import flatten_items, parse_records, read_envelopes

DAILY = T.StructType(
    [
        T.StructField("id", T.LongType(), True, {"comment": "It's the key"}),
        T.StructField("v", T.StringType(), True, {"comment": "Value"}),
        T.StructField("dt", T.StringType(), True, {"comment": "Partition"}),
    ]
)


def daily(spark, data):
    return spark.createDataFrame(data, "id long, v string, dt string")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def data_files(path):
    return [p for p in Path(path).rglob("*.parquet")]


# envelopes


def test_envelopes_keep_page_and_item_order(spark, folder):
    pages = [
        {"page": 2, "totalPages": 2, "items": [{"id": 3, "titulo": "c"}]},
        {"page": 1, "totalPages": 2, "items": [{"id": 1, "titulo": "a", "unknown": 9}, {"id": 2, "imagens": {"x": 1}}]},
        {"page": 3, "totalPages": 2, "items": []},
    ]
    for i, page in enumerate(pages):
        Path(folder, f"{i}.json").write_text(json.dumps(page, indent=1))
    flat = flatten_items(read_envelopes(spark, folder, multi_line=True)).orderBy("page", "pos")
    # a nested value under a text field stays JSON text
    got = [(r.page, r.pos, r.id, r.titulo, json.loads(r.imagens or "null")) for r in flat.collect()]
    assert got == [(1, 0, 1, "a", None), (1, 1, 2, None, {"x": 1}), (2, 0, 3, "c", None)]


def test_records_from_text_need_no_rows_to_have_a_schema(spark):
    empty = spark.createDataFrame([], "body string")
    assert parse_records(empty, "body").columns == RAW_SCHEMA.names[:-1]



# JSON folders


def test_json_folders_replace_only_their_own_name(spark, folder):
    def write(data):
        df = spark.createDataFrame(data, "id long, PAGE string, period string, folder string")
        json_folders.write_folders(df, folder)

    write([(1, "p", "202401", "f_1"), (2, "p", "202401", "f_2"), (3, "p", "202402", "f_3")])
    write([(9, "q", "202401", "f_2")])
    got = json_folders.scan_period(spark, folder, "202401").select("id", "PAGE", "titulo", "folder")
    assert rows(got) == [(1, "p", None, "f_1"), (9, "q", None, "f_2")]
    assert rows(json_folders.scan_paths(spark, f"{folder}/period=202402/*").select("id")) == [(3,)]
    assert rows(json_folders.list_folders(spark, folder)) == [
        ("202401", "f_1"), ("202401", "f_2"), ("202402", "f_3")]
    assert rows(json_folders.list_folders(spark, folder, "202402")) == [("202402", "f_3")]
    assert rows(json_folders.newest_folders(spark, folder)) == [("202402", "f_3")]


def test_listing_of_plain_period_folders_and_of_nothing(spark, folder):
    for name in ("202411/f_1_to_10_x", "202411/f_11_to_20_x", "202410/f_1_to_2_x"):
        Path(folder, name).mkdir(parents=True)
        Path(folder, name, "part-0.json").write_text('{"id": 1}\n')
    assert rows(json_folders.list_folders(spark, folder, "202411")) == [
        ("202411", "f_11_to_20_x"), ("202411", "f_1_to_10_x")]
    assert json_folders.list_folders(spark, f"{folder}/absent").count() == 0
    assert json_folders.newest_folders(spark, f"{folder}/absent").count() == 0
    assert json_folders.newest_folders(spark, folder).count() == 2
    tagged = json_folders.folder_from_metadata(json_folders.scan_paths(spark, f"{folder}/202411/*"))
    assert rows(tagged.select("folder")) == [("f_11_to_20_x",), ("f_1_to_10_x",)]


# catalog tables


def test_created_table_is_typed_commented_and_partitioned(spark, db, folder):
    name = f"{db}.news"
    tables.ensure_table(spark, name, f"{folder}/news", SILVER_SCHEMA, "dt")
    assert spark.table(name).count() == 0
    assert [(f.name, f.dataType) for f in spark.table(name).schema] == [
        (f.name, f.dataType) for f in SILVER_SCHEMA]
    columns = {c.name: c for c in spark.catalog.listColumns(name)}
    assert columns["dt"].isPartition and columns["id"].description == "Unique identifier of the item"
    tables.ensure_table(spark, f"{db}.quoted", f"{folder}/quoted", DAILY, "dt")
    assert {c.description for c in spark.catalog.listColumns(f"{db}.quoted")} >= {"It's the key"}


def test_registration_again_finds_rows_and_later_columns(spark, db, folder):
    name, path = f"{db}.news", f"{folder}/news"
    assert not tables.has_table(spark, path) and not tables.table_exists(spark, name)
    tables.save_merged(daily(spark, [(1, "a", "202401")]), name, path, DAILY, ["id"])
    wider = daily(spark, [(2, "b", "202402")]).withColumn("extra", F.lit("x"))
    tables.save_merged(wider, name, path, DAILY, ["id"])
    before = rows(spark.table(name))
    tables.drop_registration(spark, name)
    assert tables.has_table(spark, path) and not tables.table_exists(spark, name)
    again = tables.ensure_table(spark, name, path, DAILY, "dt")
    assert again.columns == ["id", "v", "extra", "dt"]
    assert rows(again) == before == [(1, "a", None, "202401"), (2, "b", "x", "202402")]
    assert rows(tables.read_path(spark, path, again.schema)) == before


def test_merge_moves_rows_between_partitions_and_empties_one(spark, db, folder):
    name, path = f"{db}.news", f"{folder}/news"
    save = lambda data: tables.save_merged(daily(spark, data), name, path, DAILY, ["id"])
    save([(1, "a", "202401"), (2, "b", "202402"), (3, "c", "202403")])
    assert save([(1, "A", "202404"), (2, "B", "202404")]) == ["202401", "202402", "202404"]
    want = [(1, "A", "202404"), (2, "B", "202404"), (3, "c", "202403")]
    assert rows(spark.table(name)) == want
    assert rows(tables.read_path(spark, path, spark.table(name).schema)) == want
    assert save([(1, "A", "202404"), (2, "B", "202404")]) == ["202404"]
    assert rows(spark.table(name)) == want


def test_merge_leaves_other_partitions_untouched(spark, db, folder):
    name, path = f"{db}.news", f"{folder}/news"
    save = lambda data: tables.save_merged(daily(spark, data), name, path, DAILY, ["id", "dt"])
    save([(1, "a", "202401"), (None, "n", "202402")])
    before = swaps.current(spark, path).folders["202401"]
    files = {p: p.stat().st_mtime_ns for p in data_files(f"{path}/{before}")}
    assert save([(1, "a2", "202402"), (None, "n2", "202402")]) == ["202402"]
    assert swaps.current(spark, path).folders["202401"] == before
    assert {p: p.stat().st_mtime_ns for p in data_files(f"{path}/{before}")} == files
    assert rows(spark.table(name)) == sorted(
        [(1, "a", "202401"), (1, "a2", "202402"), (None, "n", "202402"), (None, "n2", "202402")], key=repr)


def test_merged_rows_are_written_once(spark, db, folder):
    name, path = f"{db}.news", f"{folder}/news"
    save = lambda data: tables.save_merged(daily(spark, data), name, path, DAILY, ["id"], unique_source=True)
    save([(k, "a", "202401") for k in range(50)])
    save([(7, "b", "202402")])
    versions = {f.split("/")[1] for f in swaps.current(spark, path).folders.values()}
    assert len(versions) == 1 and set(child_names(spark, f"{path}/_v")) >= versions
    # Every file is in a version folder: nothing was copied into place.
    assert {p.relative_to(path).parts[0] for p in data_files(path)} == {"_v", "_k"}


class Lost(Exception):
    pass


def test_driver_lost_between_two_partitions(spark, db, folder, monkeypatch):
    name, path = f"{db}.news", f"{folder}/news"
    save = lambda data: tables.save_merged(daily(spark, data), name, path, DAILY, ["id"])
    save([(1, "a", "202401"), (2, "b", "202402"), (3, "c", "202403")])
    reader = tables.read_path(spark, path, DAILY)
    want = [(1, "A", "202404"), (2, "B", "202404"), (3, "c", "202403")]
    real, seen = type(spark).sql, []

    def sql(self, text, *args, **options):
        if text.startswith("ALTER TABLE") and len(seen) == 2:
            raise Lost
        seen.extend([1] if text.startswith("ALTER TABLE") else [])
        return real(self, text, *args, **options)

    with monkeypatch.context() as patch:
        patch.setattr(type(spark), "sql", sql)
        with pytest.raises(Lost):
            save([(1, "A", "202404"), (2, "B", "202404")])
    # Two of three partitions follow in the catalog; by path all of them took effect at once, and a reader from before can end.
    assert rows(spark.table(name)) != want
    assert rows(tables.read_path(spark, path, DAILY)) == want
    assert rows(reader) == [(1, "a", "202401"), (2, "b", "202402"), (3, "c", "202403")]
    tables.ensure_table(spark, name, path, DAILY, "dt")
    assert rows(spark.table(name)) == want
    tables.drop_registration(spark, name)
    assert rows(tables.ensure_table(spark, name, path, DAILY, "dt")) == want


def test_driver_lost_before_the_exchange_changes_nothing(spark, db, folder, monkeypatch):
    name, path = f"{db}.news", f"{folder}/news"
    save = lambda data: tables.save_merged(daily(spark, data), name, path, DAILY, ["id"])
    save([(1, "a", "202401")])
    with monkeypatch.context() as patch:
        patch.setattr(swaps, "write_text", lambda *args: (_ for _ in ()).throw(Lost))
        with pytest.raises(Lost):
            save([(1, "A", "202402")])
    assert rows(spark.table(name)) == rows(tables.read_path(spark, path, DAILY)) == [(1, "a", "202401")]
    save([(1, "B", "202402")])
    save([(1, "C", "202402")])
    assert rows(spark.table(name)) == [(1, "C", "202402")]
    # Folders of the lost attempt and of older states are gone.
    assert len(child_names(spark, f"{path}/_v")) == 2 == len(child_names(spark, f"{path}/_k"))


def test_table_from_before_the_lists_is_taken_over(spark, db, folder):
    name, path = f"{db}.news", f"{folder}/news"
    old = [(1, "a", "202401"), (2, "b", "202402")]
    daily(spark, old).write.partitionBy("dt").parquet(path)
    assert rows(tables.ensure_table(spark, name, path, DAILY, "dt")) == old
    save = lambda data: tables.save_merged(daily(spark, data), name, path, DAILY, ["id"])
    assert save([(1, "A", "202403")]) == ["202401", "202403"]
    want = [(1, "A", "202403"), (2, "b", "202402")]
    assert rows(spark.table(name)) == rows(tables.read_path(spark, path, DAILY)) == want
    save([(3, "c", "202403")])
    assert not Path(path, "dt=202401").exists() and Path(path, "dt=202402").exists()
    assert rows(spark.table(name)) == [*want, (3, "c", "202403")]


def test_merge_opens_only_partitions_that_can_hold_a_key(spark, db, folder, monkeypatch):
    name, path = f"{db}.news", f"{folder}/news"
    months = [f"2024{m:02d}" for m in range(1, 7)]
    first = [(m * 100_000 + k, "a", month) for m, month in enumerate(months) for k in range(20)]
    tables.save_merged(daily(spark, first), name, path, DAILY, ["id"])
    opened = []
    real = tables._touched
    monkeypatch.setattr(tables, "_touched", lambda source, target, *rest: opened.append(target) or real(source, target, *rest))
    got = tables.save_merged(daily(spark, [(200_003, "b", "202407"), (999_999_999, "n", "202407")]), name, path, DAILY, ["id"])
    assert got == ["202403", "202407"]
    assert {Path(f).parent.name for f in opened[0].inputFiles()} == {"dt=202403"}
    assert rows(spark.table(name).filter("id in (200003, 999999999)")) == [(200_003, "b", "202407"), (999_999_999, "n", "202407")]


@pytest.mark.parametrize("kind", ["string", "int"])
def test_summaries_of_other_keys(spark, db, folder, kind):
    name, path = f"{db}.news", f"{folder}/news"
    schema = T.StructType([T.StructField("id", T.StringType() if kind == "string" else T.IntegerType()), *DAILY.fields[1:]])
    save = lambda data: tables.save_merged(
        daily(spark, data).withColumn("id", F.col("id").cast("string" if kind == "string" else "bigint")), name, path, schema, ["id"])
    save([(-5, "a", "202401"), (5, "b", "202402"), (None, "n", "202402")])
    assert save([(-5, "A", "202403")]) == ["202401", "202403"]
    assert sorted(r[0] for r in spark.table(name).filter("id is not null").select("v").collect()) == ["A", "b"]


def test_range_of_a_tracked_column(spark, db, folder):
    name, path = f"{db}.news", f"{folder}/news"
    daily(spark, [(9, "old", "202312")]).write.partitionBy("dt").parquet(path)
    table = tables.ensure_table(spark, name, path, DAILY, "dt")
    assert rows(swaps.tracked_range(table, path, "dt", "v")) == [("old", "old")]
    tables.save_merged(daily(spark, [(1, "a", "202401"), (2, "z", "202402")]), name, path, DAILY, ["id"], tracked=["v"])
    both = swaps.tracked_range(spark.table(name), path, "dt", "v")
    assert rows(both) == [("a", "z")]
    read = both.inputFiles()
    assert all("/_k/" in f or "/dt=202312/" in f for f in read) and any("/_k/" in f for f in read)
    assert rows(swaps.tracked_range(spark.table(name), path, "dt", "id")) == [(1, 9)]


def test_compaction_puts_small_files_together(spark, db, folder):
    name, path = f"{db}.news", f"{folder}/news"
    small = spark.range(200).select("id", F.lit("v").alias("v"), F.lit("202401").alias("dt"))
    small.repartition(200, "id").write.partitionBy("dt").parquet(path)
    large = spark.range(200_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("v"), F.lit("202401").alias("dt"))
    large.coalesce(1).write.mode("append").partitionBy("dt").parquet(path)
    tables.ensure_table(spark, name, path, DAILY, "dt")
    n = len(data_files(path))
    assert n > 100
    size = 1 << 20
    bins = tables.small_file_bins(spark, name, path, "dt", ["202401"], size)
    assert bins.count() == n - 1 and bins.agg(F.max("bin")).first()[0] <= 1
    before = rows(spark.table(name).groupBy("dt").agg(F.count("*"), F.sum(F.hash("id", "v"))))
    assert tables.compact(spark, name, path, "dt", ["202401", "202402"], size) == ["202401"]
    now = data_files(f"{path}/{swaps.current(spark, path).folders['202401']}")
    assert len(now) <= 12
    assert rows(spark.table(name).groupBy("dt").agg(F.count("*"), F.sum(F.hash("id", "v")))) == before
    assert tables.compact(spark, name, path, "dt", ["202401"], size, least=len(now) + 1) == []


def test_batch_append_is_repeatable(spark, folder):
    one, two = daily(spark, [(1, "a", "s1"), (2, "b", "s1")]), daily(spark, [(3, "c", "s2")])
    for df in (one, two, two):
        tables.append_batch(df, folder, "dt")
    assert rows(tables.read_path(spark, folder, DAILY)) == [(1, "a", "s1"), (2, "b", "s1"), (3, "c", "s2")]


def test_preview_and_count(spark):
    df = spark.range(20)
    assert rows(tables.preview(df, 2, ["id"])) == [(0,), (1,)]
    assert tables.preview(df).count() == 5
    assert rows(tables.row_count(df)) == [(20,)]


def test_row_level_merge_is_left_to_the_table_format(spark, db, folder):
    name = f"{db}.news"
    tables.ensure_table(spark, name, f"{folder}/news", DAILY, "dt")
    with pytest.raises(Exception, match="MERGE"):
        tables.merge_into(daily(spark, [(1, "a", "202401")]), name, ["id"])


# plans


def test_filters_reach_the_scan(spark, folder):
    from siltstone.functions.stamps import instant_day_between, stamp_text_between

    now = datetime(2024, 1, 7, tzinfo=timezone.utc)
    df = spark.createDataFrame([(1, "20240107_000000", now)], "id long, s string, t timestamp")
    df.write.parquet(f"{folder}/t")
    day = now.date()
    scan = spark.read.parquet(f"{folder}/t")
    for condition in (stamp_text_between("s", day, day), instant_day_between("t", day, day, "UTC")):
        plan = scan.filter(condition).select("id")._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        assert "GreaterThanOrEqual" in plan and "LessThan" in plan


def test_a_stamp_range_prunes_partitions(spark):
    from siltstone.queries.storage import stamp_range_pruned

    scan = stamp_range_pruned(spark, "/root/testdata/sf0.001")
    plan = scan._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert ">= 20240105" in filters and "< 20240121" in filters
    assert scan.select("dtproc").distinct().count() == 16


def test_small_batch_merge_does_not_shuffle_the_target(spark, folder):
    spark.range(1000).withColumn("v", F.lit("x")).write.parquet(f"{folder}/t")
    source = materialize(spark.range(5).withColumn("v", F.lit("y")), "s")
    from siltstone.operators.merge import merge_upsert

    merged = merge_upsert(spark.read.parquet(f"{folder}/t"), source, ["id"])
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_scratch_follows_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert scratch_root(spark) == named.rstrip("/") if named else scratch_root(spark).startswith("/tmp/")
    assert new_folder(spark, "a") != new_folder(spark, "a")
