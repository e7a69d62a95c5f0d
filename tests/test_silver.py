import pytest
from pyspark.sql import functions as F

from tests.helpers import clean, column, epoch, plan, raw, values
from tidegauge.operators import cleaning, rolling
from tidegauge.operators.keyed_join import attach_by_key
from tidegauge.operators.windows import (
    attach_window_averages,
    averages_of_sums,
    tumbling_averages,
    window_sums,
)
from tidegauge.schema import CLEAN_COLUMNS, METRICS, SILVER_COLUMNS, window_average
from tidegauge.sources.event_readings import readings_from_events

EDGE = [(0, 1.0), (100, 2.0), (300, 3.0), (301, 4.0), (600, 5.0), (1200, 7.0), (None, 9.0)]
WITH_MISSING = [*EDGE, (20, None), (2000, None)]
JOINED = [
    (1.0, 1.5),
    (2.0, 1.5),
    (3.0, 1.5),
    (3.0, 3.5),
    (4.0, 3.5),
    (5.0, 3.5),
    (5.0, 5.0),
    (7.0, 7.0),
    (9.0, None),
]


def interval_join(readings, windows):
    """The join as the plain interval condition."""
    inside = (F.col("event_time") >= F.col("window_start")) & (
        F.col("event_time") <= F.col("window_end")
    )
    return readings.join(windows, inside, "left").select(
        *readings.columns, *(window_average(metric) for metric in METRICS)
    )


def test_clean_readings(spark):
    frame = raw(spark, [("0", "1"), ("1", None), ("2", "abc"), ("3", "-1"), ("4", "0"), ("x", "2"), (None, "3"), ("5", "NaN"), ("6", "Infinity")])
    cleaned = cleaning.clean_readings(frame)
    assert cleaned.columns == list(CLEAN_COLUMNS)
    assert [t for t, *_ in values(cleaned, "time")] == ["0", "4", "5", "6", "x", None]
    assert cleaned.filter("event_time is null").count() == 2
    finite = cleaning.clean_readings(frame, reject_nonfinite=True)
    assert column(finite, "time") == ["0", "4", "x", None]


def test_clean_and_rejected_make_all(spark):
    frame = raw(spark, [("0", "1"), ("1", None), ("2", "abc"), ("3", "-1"), ("4", "NaN")])
    typed = cleaning.to_typed(frame)
    for strict in (False, True):
        kept = cleaning.keep_valid(typed, reject_nonfinite=strict)
        out = cleaning.rejected(typed, reject_nonfinite=strict)
        assert kept.count() + out.count() == frame.count()
    assert values(out, "time", "reject_reason") == [
        ("1", "temperature missing"),
        ("2", "temperature missing"),
        ("3", "temperature below 0"),
        ("4", "temperature not finite"),
    ]


def test_bounds_are_parameters(spark):
    typed = cleaning.to_typed(raw(spark, [("0", "-20"), ("1", "120"), ("2", "5")]))
    kept = cleaning.keep_valid(typed, {"temperature": (-50.0, 100.0)})
    assert column(kept, "time") == ["0", "2"]


def test_null_checks_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "bronze")
    raw(spark, [("0", "1")]).write.parquet(path)
    text = plan(cleaning.clean_readings(spark.read.parquet(path)))
    assert "IsNotNull(Temperature)" in text and "IsNotNull(Loudness)" in text


def test_tumbling_averages(spark):
    windows = tumbling_averages(clean(spark, EDGE))
    assert values(windows.select(epoch("window_start"), "avg_temp_5min", "readings")) == [
        (0, 1.5, 2),
        (300, 3.5, 2),
        (600, 5.0, 1),
        (1200, 7.0, 1),
    ]


def test_closed_join_on_edges(spark):
    readings = clean(spark, EDGE)
    joined = attach_window_averages(readings, tumbling_averages(readings))
    assert joined.columns == list(SILVER_COLUMNS)
    assert values(joined, "temperature", "avg_temp_5min") == JOINED


def test_left_closed_join_keeps_one_row_each(spark):
    readings = clean(spark, EDGE)
    joined = attach_window_averages(readings, tumbling_averages(readings), closed="left")
    assert values(joined, "temperature", "avg_temp_5min") == [
        (1.0, 1.5), (2.0, 1.5), (3.0, 3.5), (4.0, 3.5), (5.0, 5.0), (7.0, 7.0), (9.0, None)
    ]
    with pytest.raises(ValueError):
        attach_window_averages(readings, tumbling_averages(readings), closed="right")


@pytest.fixture
def shuffled_joins(spark):
    """Joins without broadcasts but those that are asked for."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("closed", ["both", "left"])
def test_shuffled_join(spark, shuffled_joins, closed):
    readings = clean(spark, EDGE + [(450, float(n)) for n in range(40)])
    shuffled = values(attach_window_averages(readings, tumbling_averages(readings), closed=closed))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")
    assert values(attach_window_averages(readings, tumbling_averages(readings), closed=closed)) == shuffled


def test_join_equals_the_interval_condition(spark, medium):
    events = spark.read.parquet(f"{medium}/events.parquet")
    readings = cleaning.clean_readings(readings_from_events(events))
    windows = tumbling_averages(readings)
    averages = [F.round(window_average(metric), 6).alias(window_average(metric)) for metric in METRICS]
    ours = attach_window_averages(readings, windows).select("time", "temperature", *averages)
    plain = interval_join(readings, windows).select("time", "temperature", *averages)
    assert ours.exceptAll(plain).count() == 0 and plain.exceptAll(ours).count() == 0
    assert ours.count() > readings.count()


def test_closed_join_adds_the_edge_rows(spark, medium):
    events = spark.read.parquet(f"{medium}/events.parquet")
    readings = cleaning.clean_readings(readings_from_events(events))
    windows = tumbling_averages(readings)
    starts = [row[0] for row in windows.select(F.unix_seconds("window_start")).collect()]
    edges = [
        row[0]
        for row in readings.select(F.unix_seconds("event_time").alias("s")).filter("s % 300 = 0").collect()
    ]
    twice = sum(edge - 300 in set(starts) for edge in edges)
    both = attach_window_averages(readings, windows).count()
    left = attach_window_averages(readings, windows, closed="left").count()
    assert twice > 0 and both == left + twice


def test_window_parts_add_up(spark):
    readings = clean(spark, WITH_MISSING)
    parts = window_sums(readings.filter("temperature < 4")).unionByName(
        window_sums(readings.filter("temperature >= 4 or temperature is null"))
    )
    whole = tumbling_averages(readings).select("window_start", "avg_temp_5min", "readings")
    assert values(averages_of_sums(parts).select(whole.columns)) == values(whole)


def test_attach_by_key_splits_hot_keys(spark, shuffled_joins):
    rows = spark.createDataFrame(
        [("hot", n) for n in range(50)] + [(f"k{n}", n) for n in range(20)] + [(None, 1)], "k string, n int"
    )
    lookup = rows.filter("k is not null").groupBy("k").agg(F.count("*").alias("c"), F.max("n").alias("m"))
    found = attach_by_key(rows, lookup, ["k"], "c")
    expected = rows.join(lookup.drop("c"), ["k"], "left")
    assert values(found.select(expected.columns)) == values(expected)
    text = plan(found)
    assert "BroadcastHashJoin" in text and "SortMergeJoin" in text
    assert "hashpartitioning(k" in text and "_part" in text.split("hashpartitioning(k")[1][:40]


def brute_rolling(rows, seconds):
    timed = [(s, t) for s, t in rows if s is not None]
    result = []
    for s, t in rows:
        near = [v for at, v in timed if s is not None and s - seconds <= at <= s and v is not None]
        result.append((t, round(sum(near) / len(near), 9) if near else None))
    return sorted(result, key=lambda row: tuple((value is None, value) for value in row))


ROLLING = [(3599, 1.0), (3600, 2.0), (3650, 3.0), (3900, 4.0), (3900, 6.0), (3901, 8.0), (7199, 5.0), (7500, 7.0), (None, 9.0), (7400, None)]


@pytest.mark.parametrize("seconds", [60, 300, 10_000])
def test_rolling_averages(spark, seconds):
    moving = rolling.rolling_averages(clean(spark, ROLLING), seconds)
    rows = values(moving.select("temperature", F.round("rolling_temp", 9)))
    assert rows == brute_rolling(ROLLING, seconds)


def test_rolling_averages_by_key(spark):
    readings = clean(spark, ROLLING).withColumn("d", (F.col("temperature") % 2).cast("int"))
    moving = rolling.rolling_averages(readings, keys=("d",))
    rows = values(moving.select("temperature", F.round("rolling_temp", 9)))
    odd = [(s, t) for s, t in ROLLING if t is not None and t % 2]
    even = [(s, t) for s, t in ROLLING if t is not None and not t % 2]
    assert rows == [*sorted(brute_rolling(odd, 300) + brute_rolling(even, 300)), (None, None)]


def test_sliding_averages(spark):
    sliding = rolling.sliding_averages(clean(spark, WITH_MISSING), 300, 60)
    spread = clean(spark, WITH_MISSING).groupBy(F.window("event_time", "5 minutes", "1 minute").alias("w")).agg(
        F.avg("temperature").alias("a"), F.count("*").alias("n")
    )
    direct = values(spread.select(F.unix_seconds("w.start").alias("s"), "a", "n"))
    assert values(sliding.select(epoch("window_start"), "sliding_temp", "readings")) == direct
    with pytest.raises(ValueError):
        rolling.sliding_averages(clean(spark, EDGE), 300, 70)
