import datetime as dt
import math
from pathlib import Path

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.helpers import clean, column, epoch, plan, values
from tidegauge.operators import metrics, rollups
from tidegauge.operators.anomalies import (
    anomaly_log,
    flag_anomalies,
    flag_anomalies_by_key,
    zscores,
)
from tidegauge.operators.baseline import baseline, baseline_of, summarize_windows
from tidegauge.operators.windows import attach_window_averages, tumbling_averages, with_previous
from tidegauge.plans.checks import check_tables
from tidegauge.plans.layers import GoldTables, Readings, layer_counts, refresh_gold, refresh_silver
from tidegauge.schema import FLAGGED_COLUMNS, METRICS, ROLLUP_COLUMNS
from tidegauge.sources.files import mark_quarantined
from tidegauge.sources.workspace import shared_folder
from tidegauge.sources.event_readings import readings_from_events
from tidegauge.sources.workspace import materialize

NAN = float("nan")
UTC = dt.timezone.utc


@pytest.fixture(scope="module")
def medium_readings(spark, medium):
    events = spark.read.parquet(f"{medium}/events.parquet")
    return Readings.from_raw(readings_from_events(events))


def temp_stats(frame):
    row = frame.first()
    return row["mean_temp"], row["std_temp"]


@pytest.mark.parametrize(
    "temperatures, mean, std",
    [([], 0.0, 0.0001), ([5.0], 5.0, 0.0001), ([5.0, 5.0], 5.0, 0.0001), ([1.0, 3.0], 2.0, math.sqrt(2))],
)
def test_baseline(spark, temperatures, mean, std):
    stats = baseline(clean(spark, [(n, t) for n, t in enumerate(temperatures)]))
    assert temp_stats(stats) == pytest.approx((mean, std))


def from_windows(readings, closed="both"):
    summary = materialize(summarize_windows(readings), "summary")
    if closed == "both":
        summary = with_previous(summary, [])
    return baseline_of(summary, closed=closed)


def direct(readings, closed="both"):
    return baseline(attach_window_averages(readings, tumbling_averages(readings), closed=closed))


@pytest.mark.parametrize("closed", ["both", "left"])
@pytest.mark.parametrize(
    "rows",
    [
        [],
        [(0, 5.0)],
        [(0, 0.1), (300, 0.1), (301, 0.1), (None, 0.1)],
        [(0, 1.0), (100, 2.0), (300, 30.0), (600, 5.0), (1200, 7.0), (None, 90.0)],
        [(0, 1.0), (100, None), (300, None), (301, 4.0), (600, 9.0), (900, None), (None, None)],
    ],
)
def test_baseline_from_windows(spark, rows, closed):
    readings = clean(spark, rows)
    ours, plain = from_windows(readings, closed).first(), direct(readings, closed).first()
    assert tuple(ours) == pytest.approx(tuple(plain), rel=1e-12)


@pytest.mark.parametrize("odd", [NAN, float("inf")])
def test_baseline_from_windows_with_odd_values(spark, odd):
    for rows in ([(0, 1.0), (300, odd), (301, 2.0)], [(0, odd), (1, odd)]):
        readings = clean(spark, rows)
        ours, plain = temp_stats(from_windows(readings)), temp_stats(direct(readings))
        assert str(ours) == str(plain)
        flagged = flag_anomalies(readings, from_windows(readings))
        assert flagged.agg(F.sum("temp_anomaly")).first()[0] == 0


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.tuples(
            st.one_of(st.none(), st.integers(0, 8).map(lambda n: n * 150)),
            st.floats(0, 1e6, allow_nan=False).map(lambda v: round(v, 3)),
        ),
        min_size=1,
        max_size=25,
    )
)
def test_baseline_from_windows_on_random_readings(spark, rows):
    readings = clean(spark, rows)
    ours, plain = from_windows(readings).first(), direct(readings).first()
    assert tuple(ours) == pytest.approx(tuple(plain), rel=1e-9)


def test_threshold_is_strict(spark):
    readings = clean(spark, [(0, 4.0), (1, 4.000001), (2, -2.0)])
    stats = spark.createDataFrame(
        [(1.0, 1.0, 1.0, 0.5)], "mean_temp double, std_temp double, mean_humidity double, std_humidity double"
    )
    flagged = flag_anomalies(readings, stats)
    assert values(flagged, "temperature", "temp_anomaly", "humidity_anomaly", "overall_anomaly") == [
        (-2.0, 0, 0, 0), (4.0, 0, 0, 0), (4.000001, 1, 0, 1)
    ]
    assert dict(flagged.dtypes)["overall_anomaly"] == "int"
    scores = zscores(readings, stats)
    assert column(scores, "z_temp") == pytest.approx([-3.0, 3.0, 3.000001])
    wide = flag_anomalies(readings, stats, metrics=("temperature",), sigmas=2.0)
    assert column(wide, "overall_anomaly") == [1, 1, 1]
    assert "humidity_anomaly" not in wide.columns


def test_scoring_adds_no_join(spark, medium_readings):
    text = plan(flag_anomalies(medium_readings.clean, medium_readings.baseline))
    assert "Join" not in text and "CartesianProduct" not in text


def test_flags_by_key(spark):
    rows = [(n, 10.0 + n % 2) for n in range(30)] + [(100, 30.0)]
    readings = clean(spark, rows).withColumn("d", F.lit("a"))
    other = clean(spark, [(n, 30.0 + n % 2) for n in range(30)]).withColumn("d", F.lit("b"))
    keyless = clean(spark, [(5, 99.0)]).withColumn("d", F.lit(None).cast("string"))
    whole = readings.unionByName(other).unionByName(keyless)
    flagged = flag_anomalies_by_key(whole, ["d"])
    assert flagged.count() == whole.count()
    assert values(flagged.filter("overall_anomaly = 1"), "d", "temperature") == [("a", 30.0)]


def flagged_fixture(spark):
    readings = clean(spark, [(0, 1.00004), (3599, 2.0), (3600, 4.0), (7200, 90.0), (7300, 91.0), (None, 92.0)])
    stats = spark.createDataFrame(
        [(3.0, 4.0, 1.0, 0.5)], "mean_temp double, std_temp double, mean_humidity double, std_humidity double"
    )
    return flag_anomalies(readings, stats)


def test_device_stats(spark):
    stats = rollups.device_stats(flagged_fixture(spark))
    assert stats.columns == list(ROLLUP_COLUMNS)
    rows = [tuple(r) for r in stats.select(epoch("window_start"), "avg_temp", "total_anomalies").collect()]
    assert rows == [(0, 1.5, 0), (3600, 4.0, 0), (7200, 90.5, 2)]
    assert dict(stats.dtypes)["total_anomalies"] == "bigint"


def test_rollups_from_the_summary(spark):
    flagged = flagged_fixture(spark)
    summary = rollups.summarize_flagged(flagged)
    assert values(rollups.device_stats_of(summary)) == values(rollups.device_stats(flagged))
    assert values(rollups.anomaly_rate_of(summary)) == values(rollups.anomaly_rate(flagged))


def test_missing_values_do_not_count_in_averages(spark):
    readings = clean(spark, [(0, 4.0), (10, None), (700, None)]).withColumn("overall_anomaly", F.lit(0))
    hourly = rollups.device_stats_of(rollups.summarize_flagged(readings))
    assert values(hourly) == values(rollups.device_stats(readings))
    assert column(hourly, "avg_temp") == [4.0]


def test_anomaly_rate_and_gaps(spark):
    flagged = flagged_fixture(spark).unionByName(
        flagged_fixture(spark).filter("temperature = 90").withColumn("event_time", F.timestamp_seconds(F.lit(9000)))
    )
    rate = rollups.anomaly_rate(flagged)
    assert values(rate.select(epoch("window_start"), "anomaly_count")) == [(7200, 2), (9000, 1)]
    first, last = (dt.datetime.fromtimestamp(s, UTC) for s in (7300, 9000))
    filled = rollups.fill_gaps(rate, first, last)
    assert values(filled.select(epoch("window_start"), "anomaly_count")) == [(7200, 2), (7800, 0), (8400, 0), (9000, 1)]
    assert rollups.fill_gaps(rate.limit(0), first, last).count() == 4
    with pytest.raises(ValueError, match="outside"):
        rollups.fill_gaps(rate, first, first)
    alerts = metrics.alert_spikes(rate, 2)
    assert values(alerts.select("anomaly_count", "message")) == [(2, "2 anomalies in one window")]


def test_anomaly_log(spark):
    log = anomaly_log(flagged_fixture(spark))
    assert log.columns == ["temp_value", "humidity_value", "detected_at", "details"]
    assert values(log.select("temp_value", epoch("detected_at"), "details")) == [
        (90.0, 7200, "Anomaly detected"), (91.0, 7300, "Anomaly detected"), (92.0, None, "Anomaly detected")
    ]
    latest = rollups.latest_anomalies(log, 2)
    assert [row[0] for row in latest.collect()] == [91.0, 90.0]


def test_reports_use_top_k(spark):
    stats = rollups.device_stats(flagged_fixture(spark), ordered=False)
    first = rollups.first_windows(stats, ["avg_temp"], 2)
    assert [row["avg_temp"] for row in first.collect()] == [1.5, 4.0]
    assert "TakeOrderedAndProject" in first._jdf.queryExecution().executedPlan().toString()
    assert rollups.hourly_plot_feed(stats).columns == ["window_start", "avg_temp", "avg_humidity", "total_anomalies"]


def test_trend_is_the_same_before_and_after_the_join(spark):
    readings = clean(spark, [(0, 1.0), (300, 2.0), (300, 4.0), (None, 9.0), (None, 11.0)])
    joined = attach_window_averages(readings, tumbling_averages(readings))
    before = values(rollups.temperature_trend(readings).select(epoch("event_time"), "avg_temp"))
    after = values(rollups.temperature_trend(joined).select(epoch("event_time"), "avg_temp"))
    assert before == after == [(0, 1.0), (300, 3.0), (None, 10.0)]


def test_correlation_matrix(spark, medium_readings):
    matrix = rollups.correlation_matrix(medium_readings.repeated)
    cells = {(x, y): c for x, y, c in values(matrix)}
    assert len(cells) == len(METRICS) ** 2
    assert all(cells[x, y] == cells[y, x] for x, y in cells)
    assert all(cells[m, m] == 1.0 for m in METRICS)
    constant = rollups.correlation_matrix(clean(spark, [(0, 1.0), (1, 2.0)]))
    assert {c for x, y, c in values(constant) if (x, y) != ("temperature", "temperature")} == {None}


def test_metric_records(spark):
    now = dt.datetime(1970, 1, 15, 1, 30, tzinfo=UTC)
    summary = rollups.summarize_flagged(flagged_fixture(spark))
    records = metrics.metric_records(rollups.device_stats_of(summary), rollups.anomaly_rate_of(summary), now)
    rows = values(records.select("namespace", "metric_name", epoch("timestamp"), "value", "unit", F.size("dimensions")))
    oldest = 1800 * 3
    assert rows == [
        ("IoT/GoldLayer", "AnomalyRate_10min", 7200, 2.0, "Count", 0),
        ("IoT/GoldLayer", "TotalAnomalies", oldest + 1, 0.0, "Count", 0),
        ("IoT/GoldLayer", "TotalAnomalies", oldest + 1, 0.0, "Count", 0),
        ("IoT/GoldLayer", "TotalAnomalies", 7200, 2.0, "Count", 0),
    ]
    named = metrics.as_metric(
        rollups.anomaly_rate_of(summary), "x", "anomaly_count", dimensions=F.array(F.struct(F.lit("site"), F.lit("a")))
    )
    row = named.first()
    assert row["dimensions"][0].asDict() == {"name": "site", "value": "a"}
    assert abs((row["timestamp"] - dt.datetime.now()).total_seconds()) < 15 * 86400


def test_retain(spark):
    now = dt.datetime(1970, 1, 3, tzinfo=UTC)
    kept = metrics.retain(clean(spark, [(0, 1.0), (86400, 2.0), (90000, 3.0), (None, 4.0)]), 1, now)
    assert column(kept, "temperature") == [2.0, 3.0]


def test_in_key_order(spark):
    readings = clean(spark, [(n * 37 % 101, float(n)) for n in range(100)]).withColumn("d", F.lit("hot"))
    ordered = metrics.in_key_order(readings, ["d"])
    assert [r[0] for r in ordered.select(F.unix_seconds("event_time")).collect()] == sorted(
        n * 37 % 101 for n in range(100)
    )


def test_layers_agree(spark, medium_readings):
    scored = medium_readings.scored
    timed = scored.filter("event_time is not null and overall_anomaly = 1").count()
    assert rollups.device_stats(scored).agg(F.sum("total_anomalies")).first()[0] == timed == 375
    assert rollups.anomaly_rate(scored).agg(F.sum("anomaly_count")).first()[0] == timed
    assert anomaly_log(scored).count() == 376
    assert scored.filter("overall_anomaly <> greatest(temp_anomaly, humidity_anomaly)").count() == 0
    assert medium_readings.flagged.columns == list(FLAGGED_COLUMNS)
    assert scored.agg(F.sum("temp_anomaly"), F.sum("humidity_anomaly")).first() == (177, 204)


def test_layer_counts(spark, medium, medium_readings):
    source = readings_from_events(spark.read.parquet(f"{medium}/events.parquet"))
    assert values(layer_counts(source, medium_readings)) == [("bronze", 10000), ("silver", 9710), ("valid", 9688)]


def test_refresh_tables(spark, medium, medium_readings):
    source = readings_from_events(spark.read.parquet(f"{medium}/events.parquet"))
    spark.sql("CREATE DATABASE IF NOT EXISTS gauge")
    lines = source.withColumn("_corrupt_record", F.lit(None).cast("string"))
    broken = spark.createDataFrame([("{",)], "_corrupt_record string")
    marked = mark_quarantined(lines.unionByName(broken, allowMissingColumns=True))
    marked.write.mode("overwrite").partitionBy("quarantined").saveAsTable("gauge.raw")
    refresh_silver(spark, "gauge.raw", "gauge.silver", partition_by_date=True)
    tables = GoldTables("gauge.device_stats", "gauge.anomaly_rate", "gauge.anomaly_log", "gauge.metrics", "gauge.flagged", "gauge.baseline")
    now = dt.datetime(2024, 1, 22, tzinfo=UTC)
    for _ in range(2):
        refresh_gold(spark, "gauge.silver", tables, "2024-01-31", now)
    assert spark.table("gauge.silver").count() == 9710
    assert spark.table("gauge.anomaly_log").count() == 376
    stats = spark.table("gauge.device_stats")
    direct = values(rollups.device_stats(medium_readings.scored))
    for ours, plain in zip(values(stats), direct, strict=True):
        assert ours[:2] == plain[:2] and ours[2:] == pytest.approx(plain[2:], abs=1.01e-4)
    assert spark.table("gauge.metrics").count() == stats.count() + spark.table("gauge.anomaly_rate").count()
    assert spark.table("gauge.baseline").count() == 1
    report = check_tables(spark, "gauge.flagged", "gauge.device_stats")
    failed = report.filter("status <> 'passed'").select("check", "status")
    assert values(failed) == [("temperature_range", "failed")]
    assert report.count() == 10
    refresh_gold(spark, "gauge.silver", tables, "2024-02-01", now)
    assert spark.table("gauge.anomaly_log").count() == 376
    assert column(spark.table("gauge.anomaly_log").select("run_id").distinct(), "run_id") == ["2024-02-01"]
    late = metrics.retain(spark.table("gauge.silver"), 7, now)
    assert "PartitionFilters: [isnotnull(event_date" in plan(late)
    logged = anomaly_log(spark.table("gauge.flagged"))
    assert "PushedFilters: [IsNotNull(overall_anomaly), EqualTo(overall_anomaly,1)]" in plan(logged)
    assert [path.name for path in Path(shared_folder(spark)).iterdir() if path.name.startswith(("gold-", "silver-"))] == []
    day = spark.table("gauge.silver").filter("event_date = '2024-01-05'")
    assert "PartitionFilters: [isnotnull(event_date" in plan(day)
    spark.sql("DROP DATABASE gauge CASCADE")
