from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from siltstone import RunConfig
from siltstone.functions import names, stamps
from siltstone.functions.json_maps import json_map, map_value

FMT = "dd/MM/yyyy HH:mm:ss"


def one(spark, *columns):
    return spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first()


def test_dates_parse_and_bad_text_is_null_under_ansi(spark):
    spark.conf.set("spark.sql.ansi.enabled", "true")
    row = one(
        spark,
        stamps.parse_date(F.lit("29/02/2024 23:59:59"), FMT),
        stamps.parse_date(F.lit("30/02/2024 10:00:00"), FMT),
        stamps.parse_timestamp(F.lit("no date"), FMT),
        stamps.parse_date(F.lit(None).cast("string"), FMT),
        stamps.month_start(stamps.parse_date(F.lit("29/02/2024 23:59:59"), FMT)),
    )
    assert list(row) == [date(2024, 2, 29), None, None, None, date(2024, 2, 1)]


@pytest.mark.parametrize("session_zone", ["UTC", "America/Sao_Paulo", "Asia/Tokyo"])
def test_instants_do_not_depend_on_the_session_zone(spark, session_zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", session_zone)
    try:
        ts = stamps.parse_instant(F.lit("10/02/2024 12:00:00"), FMT, "America/Sao_Paulo")
        local = stamps.wall_clock(ts, "America/Sao_Paulo")
        row = one(spark, F.unix_timestamp(ts), stamps.run_stamp(local), stamps.iso_stamp(local))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert row[0] == int(datetime(2024, 2, 10, 15, tzinfo=timezone.utc).timestamp())
    assert row[1:] == ("20240210_120000", "2024-02-10T12:00:00")


def test_day_ranges_include_both_ends(spark):
    start, end = date(2024, 1, 5), date(2024, 1, 10)
    texts = ["20240104_235959", "20240105_000000", "20240110_235959", "20240111_000000", "bad"]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    parsed = {r.s for r in df.filter(stamps.stamp_day_between("s", start, end)).collect()}
    pushed = {r.s for r in df.filter(stamps.stamp_text_between("s", start, end)).collect()}
    assert parsed == pushed == set(texts[1:3])

    zone = "America/Sao_Paulo"  # midnight there is 03:00 UTC
    edge = [datetime(2024, 1, 5, 2, 59, 59), datetime(2024, 1, 5, 3), datetime(2024, 1, 11, 2, 59, 59),
            datetime(2024, 1, 11, 3)]
    instants = spark.createDataFrame([(t.replace(tzinfo=timezone.utc),) for t in edge], "t timestamp")
    kept = instants.filter(stamps.instant_day_between("t", start, end, zone)).count()
    local = spark.createDataFrame([(t - timedelta(hours=3),) for t in edge], "t timestamp_ntz")
    assert kept == local.filter(stamps.local_day_between("t", start, end)).count() == 2


def test_offsets_periods_and_now(spark):
    ts = F.lit("2024-03-01 01:30:00").cast("timestamp_ntz")
    row = one(
        spark,
        stamps.shift_hours(ts, -3),
        stamps.period_of(F.lit(date(2024, 3, 1))),
        stamps.current_run_stamp("America/Sao_Paulo"),
        stamps.utc_wall_clock(ts, "America/Sao_Paulo"),
    )
    assert row[0] == row[3] == datetime(2024, 2, 29, 22, 30)
    assert row[1] == "202403"
    now = RunConfig(datetime.now(timezone.utc)).stamp
    assert row[2][:8] in (now[:8], RunConfig(datetime.now(timezone.utc) - timedelta(minutes=5)).stamp[:8])


def test_names_and_labels(spark):
    stamp = F.lit("20240210_120000")
    folder = names.folder_name("feedpage", F.lit(11), F.lit(20), stamp)
    label = names.page_label(F.lit(11), F.lit(20), stamp)
    path = F.lit("file:/x/raw/period=202402/folder=feedpage_11_to_20_20240210_120000/part-0.json")
    plain = F.lit("dbfs:/x/raw/202402/feedpage_11_to_20_20240210_120000/part-0.json")
    row = one(
        spark, folder, names.folder_first_page(folder), names.folder_last_page(folder), label,
        names.label_last_page(label), names.label_stamp(label), names.label_folder("feedpage", label),
        names.path_folder(path), names.path_period(path), names.path_folder(plain),
        names.path_period(plain), names.folder_last_page(F.lit("other_name")),
    )
    name = "feedpage_11_to_20_20240210_120000"
    assert list(row) == [
        name, 11, 20, "11 - to - 20 - 20240210_120000", 20, "20240210_120000", name,
        name, "202402", name, "202402", None,
    ]


def test_json_maps(spark):
    text = '{"a": 1, "b.c": {"d": [2]}, "e": null}'
    m = json_map(F.lit(text))
    row = one(
        spark, map_value(m, "a"), map_value(m, "b.c"), map_value(m, "e"), map_value(m, "z"),
        json_map(F.lit('{"a": ')), json_map(F.lit(None).cast("string")),
    )
    assert list(row) == ["1", '{"d":[2]}', None, None, None, None]


def test_run_config():
    cfg = RunConfig(datetime(2024, 3, 1, 2, tzinfo=timezone.utc))
    assert (cfg.stamp, cfg.period, cfg.run_date) == ("20240229_230000", "202402", date(2024, 2, 29))
    assert cfg.default_start == date(2024, 2, 22)
    with pytest.raises(ValueError):
        RunConfig(datetime(2024, 3, 1))
    with pytest.raises(ValueError):
        RunConfig(datetime(2024, 3, 1, tzinfo=timezone.utc), folder_prefix="a_b")
