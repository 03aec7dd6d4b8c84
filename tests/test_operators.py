import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from siltstone.operators.bounds import lower_bound_frame, read_bound
from siltstone.operators.columns import conform, rename_cast
from siltstone.operators.latest import latest_per_key, total_order
from siltstone.operators.map_pivot import json_columns_to_maps, map_pivot
from siltstone.operators.merge import merge_upsert, require_unique, split_null_keys
from siltstone.operators.paging import page_groups, page_stats, pages_to_fetch, resume_page
from siltstone.operators.segments import global_row_number, segment_of, volume_row_number
from siltstone.operators.worklist import chunk_folders, symmetric_difference, unprocessed


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# newest row per key


def test_latest_keeps_one_row_per_key_and_one_for_null(spark):
    df = spark.createDataFrame(
        [(1, "a", 1), (1, "b", 2), (2, "c", 1), (None, "d", 1), (None, "e", 5)], "id int, v string, t int"
    )
    assert rows(latest_per_key(df, ["id"], [F.col("t").desc()])) == sorted(
        [(1, "b", 2), (2, "c", 1), (None, "e", 5)], key=repr
    )


def test_latest_is_the_same_whatever_the_row_order(spark):
    data = [(1, "x", i % 3, i) for i in range(60)]
    seen = set()
    for seed in range(3):
        random.Random(seed).shuffle(data)
        df = spark.createDataFrame(data, "id int, s string, v int, w int").repartition(4)
        seen.add(rows(latest_per_key(df, ["id"], total_order(df, [F.col("s").desc()])))[0])
    assert seen == {(1, "x", 2, 59)}


def test_latest_limits_groups_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    plan = latest_per_key(df, ["k"], [F.col("id").desc()])._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan ==") :]
    assert physical.count("WindowGroupLimit") == 2
    assert physical.count("Exchange hashpartitioning") == 1


# paging


def simulate_groups(pages, total, per_folder=10):
    """The grouping rule page by page: (first, last, pages, items)."""
    out, open_pages = [], []
    for page, n in pages:
        open_pages.append((page, n))
        if (n > 0 and page % per_folder == 0) or page == total:
            items = sum(i for _, i in open_pages)
            if items:
                out.append((open_pages[0][0], open_pages[-1][0], len(open_pages), items))
            open_pages = []
    return out


@pytest.mark.parametrize("seed", range(4))
def test_page_groups_follow_the_rule(spark, seed):
    rnd = random.Random(seed)
    start, total = rnd.randint(1, 25), rnd.randint(60, 140)
    pages = [(p, rnd.choice([0, 0, 1, 5])) for p in range(start, total + 1)]
    df = spark.createDataFrame(pages, "page long, n_items long")
    got = rows(page_groups(df, total, width=rnd.choice([1, 2, 3, 1000])).select(
        "first_page", "last_page", "n_pages", "n_items"))
    assert got == sorted(simulate_groups(pages, total), key=repr)


def test_resumed_run_and_open_tail(spark):
    pages = spark.createDataFrame([(p, 1) for p in range(10, 48)], "page long, n_items long")
    got = [(r.first_page, r.last_page) for r in page_groups(pages, 47).orderBy("first_page").collect()]
    assert got == [(10, 10), (11, 20), (21, 30), (31, 40), (41, 47)]
    # page 60 is the last one of the feed but not landed: pages 41..47 stay open
    assert page_groups(pages, 60).agg(F.max("last_page")).first()[0] == 40


def test_group_without_items_gives_nothing(spark):
    pages = spark.createDataFrame([(p, 0) for p in range(1, 8)], "page long, n_items long")
    assert page_groups(pages, 7).count() == 0


def test_page_stats_of_null_and_repeated_pages(spark):
    df = spark.createDataFrame(
        [(1, 3, [1, 2]), (2, 3, None), (3, 4, []), (1, 3, [5])], "page long, totalPages long, items array<int>"
    )
    assert rows(page_stats(df)) == [(1, 3, 3), (2, 0, 3), (3, 0, 4)]


def test_resume_page(spark):
    names = [("202401", "f_1_to_90_20240101_000000"), ("202402", "f_81_to_9_20240201_000000"),
             ("202402", "f_10_to_20_20240202_000000")]
    df = spark.createDataFrame(names, "period string, folder string")
    assert resume_page(df).first()[0] == 20  # only the newest period counts, as a number
    assert resume_page(df.limit(0)).first()[0] == 1
    assert [r.page for r in pages_to_fetch(spark, 3, 5).collect()] == [3, 4, 5]
    assert pages_to_fetch(spark, 6, 5).count() == 0


# work lists


def test_symmetric_difference_and_work_list(spark):
    raw = spark.createDataFrame([("a",), ("b",), ("b",), ("c",)], "folder string")
    done = spark.createDataFrame([("b",), ("z",)], "folder string")
    assert rows(symmetric_difference(raw, done, "folder")) == [
        ("a", True, False), ("c", True, False), ("z", False, True)]
    assert rows(unprocessed(raw, done, "folder")) == [("a",), ("c",)]
    assert rows(unprocessed(raw, done.limit(0), "folder")) == [("a",), ("b",), ("c",)]


def test_chunks_hold_ten_each(spark):
    df = spark.createDataFrame([(f"f_{i}_to_{i}_20240101_000000",) for i in range(1, 48)], "folder string")
    counts = rows(chunk_folders(df, 10).groupBy("chunk").count())
    assert counts == [(0, 10), (1, 10), (2, 10), (3, 10), (4, 7)]


def test_names_without_a_page_are_chunked_too(spark):
    names = [f"other{i}" for i in range(25)] + [f"f_{i}_to_{i}_20240101_000000" for i in range(1, 9)]
    df = spark.createDataFrame([(n,) for n in names], "folder string")
    chunks = chunk_folders(df, 10)
    assert rows(chunks.groupBy("chunk").count()) == [(0, 10), (1, 10), (2, 10), (3, 3)]
    assert chunks.filter("chunk < 2 and folder like 'f!_%' escape '!'").count() == 0


def test_global_row_number_over_segments(spark):
    keys = random.Random(3).sample(range(5000), 400)
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    got = global_row_number(df, segment_of("k", 64), ["k"], "n").orderBy("k").collect()
    assert [(r.k, r.n) for r in got] == [(k, i + 1) for i, k in enumerate(sorted(keys))]


# bounds


def test_lower_bounds(spark):
    target = spark.createDataFrame([(date(2024, 2, 10),), (date(2024, 3, 9),)], "d date")
    source = spark.createDataFrame([(date(2023, 7, 4),), (None,)], "d date")
    bound = lambda t, s: read_bound(lower_bound_frame(t, s), "lower_bound")
    assert bound(target, source) == date(2024, 3, 1)
    assert bound(None, source) == bound(target.limit(0), source) == date(2023, 7, 1)
    assert bound(target.limit(0), source.limit(0)) is None


# projections


def test_rename_cast_writes_nested_values_as_json(spark):
    df = spark.createDataFrame([(1, (1, ["x"]))], "a int, b struct<n:int,l:array<string>>")
    assert rows(df.select(*rename_cast(df, {"a": "A", "b": "B"}))) == [("1", '{"n":1,"l":["x"]}')]


def test_conform_orders_casts_and_fills(spark):
    df = spark.createDataFrame([(1, "x", 2)], "b int, extra string, a int")
    schema = spark.createDataFrame([], "a long, gone string, b int").schema
    out = conform(df, schema)
    assert out.columns == ["a", "gone", "b", "extra"] and rows(out) == [(2, None, 1, "x")]


# merge


def merge_by_hand(target, source, keys, target_cols, source_cols):
    """SQL MERGE row by row."""
    out_cols = target_cols + [c for c in source_cols if c not in target_cols]
    key = lambda r: tuple(r[k] for k in keys)
    result, used = [], set()
    for row in target:
        match = [s for s in source if None not in key(s) and key(s) == key(row)]
        used.update(id(s) for s in match)
        result.append({**row, **match[0]} if match else row)
    result += [s for s in source if id(s) not in used]
    return sorted((tuple(r.get(c) for c in out_cols) for r in result), key=repr)


@pytest.mark.parametrize("unique", [True, False])
@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
def test_merge_equals_merge_by_hand(spark, unique, broadcast):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        rnd = random.Random(7)
        for target_cols, source_cols in (
            (["id", "dt", "v"], ["id", "dt", "v"]),
            (["id", "dt", "v", "old"], ["id", "dt", "v", "new"]),
        ):
            def frame(cols, n, repeat):
                out, seen = [], set()
                while len(out) < n:
                    row = {c: rnd.choice("abc") for c in cols}
                    row["id"] = rnd.choice([None, *range(25)])
                    row["dt"] = rnd.choice([None, "1", "2"])
                    k = (row["id"], row["dt"])
                    if repeat or None in k or k not in seen:
                        out.append(row)
                    seen.add(k)
                return out

            target = frame(target_cols, 40, repeat=not unique)
            source = frame(source_cols, 25, repeat=False)
            t = spark.createDataFrame(target, ", ".join(f"{c} {'int' if c == 'id' else 'string'}" for c in target_cols))
            s = spark.createDataFrame(source, ", ".join(f"{c} {'int' if c == 'id' else 'string'}" for c in source_cols))
            got = rows(merge_upsert(t, s, ["id", "dt"], unique_target=unique))
            assert got == merge_by_hand(target, source, ["id", "dt"], target_cols, source_cols)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_merge_twice_equals_once(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    s = spark.createDataFrame([(2, "B"), (3, "C")], "id int, v string")
    once = merge_upsert(t, s, ["id"])
    assert rows(merge_upsert(once, s, ["id"])) == rows(once) == [(1, "a"), (2, "B"), (3, "C")]


def test_merge_without_evolution(spark):
    t = spark.createDataFrame([(1, "a")], "id int, v string")
    s = spark.createDataFrame([(1, "b", 5)], "id int, v string, extra int")
    assert merge_upsert(t, s, ["id"], evolve=False).columns == ["id", "v"]
    with pytest.raises(ValueError, match="lacks"):
        merge_upsert(s, t, ["id"], evolve=False)


def test_ambiguous_source_is_reported(spark):
    s = spark.createDataFrame([(1,), (1,), (None,), (None,)], "id int")
    with pytest.raises(ValueError, match="more than one row"):
        require_unique(s, ["id"])
    complete, keyless = split_null_keys(s, ["id"])
    assert (complete.count(), keyless.count()) == (2, 2)
    require_unique(keyless, ["id"])


# map pivot


def pivot(spark, texts, fixed=("id",), **options):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, images string")
    return map_pivot(json_columns_to_maps(df, ["images"]), list(fixed), **options)


def test_pivot_takes_every_key_or_the_greatest_list(spark):
    texts = ['{"b": 1}', '{"a": 2, "z": {"y": 1}}', None, "{broken", "{}"]
    out = pivot(spark, texts)
    assert out.columns == ["id", "a", "b", "z"]
    assert rows(out)[:2] == [(0, None, "1", None), (1, "2", None, '{"y":1}')]
    assert all(r[1:] == (None, None, None) for r in rows(out)[2:])
    assert pivot(spark, texts, mode="greatest_keys").columns == ["id", "b"]
    with pytest.raises(ValueError, match="mode"):
        pivot(spark, texts, mode="other")


def test_pivot_names_never_collide(spark):
    out = pivot(spark, ['{"id": 1, "a.b": 2, "A.B": 3, "": 4}'])
    assert out.columns == ["id", "images_dict_", "A.B", "images_dict_a.b", "images_dict_id"]
    assert rows(out) == [(0, "4", "3", "2", "1")]


def test_pivot_without_maps_or_keys(spark):
    df = spark.createDataFrame([(1,)], "id int")
    assert rows(map_pivot(json_columns_to_maps(df, ["images"]), ["id"])) == [(1,)]
    assert pivot(spark, [None, None]).columns == ["id"]
    assert pivot(spark, [None, None], mode="greatest_keys").columns == ["id"]


def test_pivot_refuses_an_unbounded_key_set(spark):
    with pytest.raises(ValueError, match="more than 2"):
        pivot(spark, ['{"a": 1, "b": 1}', '{"c": 1}'], max_keys=2)
    assert len(pivot(spark, ['{"a": 1, "b": 1}'], max_keys=2).columns) == 3


def test_numbers_by_volume(spark):
    # All on one first page, some without any: tasks still share them, and the numbers are those of one sort.
    names = [f"feed_1_to_{k}_x{k % 7}" for k in range(3000)] + ["loose", "feed_a_to_b"]
    df = spark.createDataFrame([(n,) for n in names], "folder string").repartition(5)
    got = {r["folder"]: r["chunk"] for r in chunk_folders(df, 7).collect()}
    def page(n):
        part = n.split("_")
        return int(part[1]) if len(part) > 1 and part[1].isdigit() else -1
    assert got == {n: k // 7 for k, n in enumerate(sorted(names, key=lambda n: (page(n), n)))}
    # So few rows would be put together again; without that each file has its share.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        laid = volume_row_number(df, [F.lit(1), F.col("folder")])
        assert len(laid.inputFiles()) > 1 and sorted(r[0] for r in laid.select("row_number").collect()) == list(range(1, len(names) + 1))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert volume_row_number(df.limit(0), [F.col("folder")]).count() == 0
