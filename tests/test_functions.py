import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.helpers import column, values
from tidegauge import functions as fn

UTC = dt.timezone.utc


@pytest.mark.parametrize(
    "text, number",
    [
        ("23.10", 23.1),
        (" 5 ", 5.0),
        ("", None),
        ("abc", None),
        (None, None),
        ("-1", -1.0),
        ("0", 0.0),
        ("Infinity", float("inf")),
        ("1d", 1.0),
    ],
)
def test_to_number(spark, text, number):
    frame = spark.createDataFrame([(text,)], "t string")
    assert frame.select(fn.to_number(F.col("t"))).first()[0] == number


def test_to_number_keeps_nan(spark):
    frame = spark.createDataFrame([("NaN",)], "t string")
    assert frame.select(F.isnan(fn.to_number(F.col("t")))).first()[0]


@pytest.mark.parametrize(
    "text, seconds",
    [
        ("1623781100", 1623781100),
        ("1623781100.7", 1623781100),
        ("-1.9", -1),
        ("abc", None),
        ("", None),
        ("NaN", None),
        ("1d", None),
        ("1e3", 1000),
        (" 12 ", 12),
        ("9000000000000", 9000000000000),
        ("99999999999999", None),
        ("-9223372036854775808", None),
        ("99999999999999999999", None),
        ("2021-06-15 10:00:00", None),
        (None, None),
    ],
)
def test_epoch_to_timestamp(spark, text, seconds):
    frame = spark.createDataFrame([(text,)], "t string")
    time = fn.epoch_to_timestamp(F.col("t"))
    assert frame.select(F.unix_seconds(time)).first()[0] == seconds


@pytest.mark.parametrize(
    "seconds, start, edge", [(0, 0, True), (299, 0, False), (300, 300, True), (-1, -300, False)]
)
def test_buckets(spark, seconds, start, edge):
    time = F.timestamp_seconds(F.lit(seconds))
    row = spark.range(1).select(
        F.unix_seconds(fn.bucket_start(time, 300)), fn.on_bucket_edge(time, 300)
    )
    assert tuple(row.first()) == (start, edge)


def test_bucket_start_agrees_with_window(spark):
    frame = spark.range(-5000, 5000, 7).select(F.timestamp_seconds("id").alias("t"))
    both = frame.select(
        F.window("t", "5 minutes")["start"].alias("w"), fn.bucket_start(F.col("t"), 300).alias("b")
    )
    assert both.count() == frame.count()
    assert both.filter(F.col("w") != F.col("b")).count() == 0


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata", "Europe/London"])
def test_wall_clock_does_not_depend_on_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        frame = spark.range(0, 400 * 86400, 12345).select((F.col("id") + 1_700_000_000).alias("s"))
        wall = frame.select("s", fn.utc_wall_clock(F.timestamp_seconds("s")).alias("wall"))
        back = wall.filter(fn.wall_clock_epoch(F.col("wall")) != F.col("s"))
        assert back.count() == 0
        first = wall.orderBy("s").select(F.col("wall").cast("string")).first()[0]
        assert first == "2023-11-14 22:13:20"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_clamp_timestamp(spark):
    now = dt.datetime(2024, 1, 15, tzinfo=UTC)
    day = dt.timedelta(days=1)
    cases = {
        now - 20 * day: dt.datetime(2024, 1, 1, 0, 0, 1, tzinfo=UTC),
        now - 14 * day: now - 14 * day,
        now - day: now - day,
        now + day: now,
        None: now,
    }
    rows = [
        (time and int(time.timestamp()), int(expected.timestamp()))
        for time, expected in cases.items()
    ]
    frame = spark.createDataFrame(rows, "s bigint, expected bigint")
    clamped = fn.clamp_timestamp(
        F.timestamp_seconds("s"), F.timestamp_seconds(F.lit(int(now.timestamp())))
    )
    assert frame.filter(F.unix_seconds(clamped) != F.col("expected")).count() == 0


@pytest.mark.parametrize(
    "name, cleaned",
    [
        (" Temp (C) ", "Temp_C"),
        ("a-b", "a_b"),
        ("x{y}=;z", "xyz"),
        ("line\nbreak\ttab", "linebreaktab"),
        ("plain", "plain"),
    ],
)
def test_clean_name(spark, name, cleaned):
    assert fn.clean_name(name) == cleaned
    frame = spark.createDataFrame([(name,)], "t string")
    assert frame.select(fn.clean_text(F.col("t"))).first()[0] == cleaned


def test_clean_names_renames_and_refuses_clashes(spark):
    frame = spark.createDataFrame([(1, 2)], "`a b` int, c int")
    assert fn.clean_names(frame).columns == ["a_b", "c"]
    with pytest.raises(ValueError, match="a_b"):
        fn.clean_names(spark.createDataFrame([(1, 2)], "`a b` int, `a-b` int"))


def test_statistics_fallbacks(spark):
    frame = spark.createDataFrame([(None,), (0.0,), (2.0,), (float("nan"),)], "v double")
    std = frame.select(fn.usable_std(F.col("v")).alias("v")).filter(~F.isnan("v"))
    assert column(std, "v") == [0.0001, 0.0001, 2.0]
    assert frame.select(fn.usable_mean(F.col("v")).alias("v")).filter("v = 0").count() == 2


def test_deviates_is_strict_and_never_null(spark):
    frame = spark.createDataFrame([(4.0,), (4.1,), (-2.1,), (None,)], "v double")
    flag = fn.deviates(F.col("v"), F.lit(1.0), F.lit(1.0))
    assert values(frame.select("v", flag.alias("f"))) == [(-2.1, 1), (4.0, 0), (4.1, 1), (None, 0)]


def test_correlation(spark):
    frame = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 4.0, 5.0), (3.0, 6.0, 5.0)], "x double, y double, k double")
    row = frame.agg(
        fn.correlation("x", "y"), fn.correlation("x", "k"), fn.correlation("k", "k"), fn.correlation("x", "x")
    ).first()
    assert row[0] == pytest.approx(1.0) and row[1] is None and row[2] is None and row[3] == 1.0
