from pyspark.sql import functions as F

from tests.helpers import clean, plan, values
from tidegauge.operators import quality as q
from tidegauge.plans.checks import check_tables
from tidegauge.schema import METRICS

FLAGS = "temp_anomaly int, humidity_anomaly int, overall_anomaly int"


def results(frame):
    return {row["check"]: (row["bad_rows"], row["status"]) for row in frame.collect()}


def test_row_count(spark):
    full, empty = clean(spark, [(0, 1.0)]), clean(spark, [])
    assert results(q.run_checks(full, "t", [q.not_empty()])) == {"row_count": (0, "passed")}
    assert results(q.run_checks(empty, "t", [q.not_empty()])) == {"row_count": (1, "failed")}


def test_columns(spark):
    frame = clean(spark, [(0, 1.0)])
    check = q.has_columns(frame, ["time", "event_time"])
    assert results(q.run_checks(frame, "t", [check])) == {"schema_columns": (0, "passed")}
    check = q.has_columns(frame, ["time", "nope", "neither"])
    assert results(q.run_checks(frame, "t", [check])) == {"schema_columns": (2, "failed")}
    empty = frame.limit(0)
    check = q.has_columns(empty, ["time", "nope"])
    assert results(q.run_checks(empty, "t", [check])) == {"schema_columns": (1, "failed")}


def test_flags(spark):
    frame = spark.createDataFrame([(0, 1, 1), (None, 0, 0), (2, 0, 1), (0, 0, 3)], FLAGS)
    assert results(q.run_checks(frame, "t", [q.flags_are_binary()])) == {"anomaly_flags": (2, "failed")}


def test_a_missing_column_is_an_error_and_the_others_run(spark):
    frame = spark.createDataFrame([(5.0,), (101.0,), (-51.0,), (None,)], "temperature double")
    checks = [q.not_empty(), q.flags_are_binary(), *q.within_limits()]
    assert results(q.run_checks(frame, "t", checks)) == {
        "row_count": (0, "passed"),
        "anomaly_flags": (None, "error"),
        "temperature_range": (2, "failed"),
        "humidity_range": (None, "error"),
    }
    assert results(q.run_checks(frame, "t", [q.flags_are_binary()])) == {"anomaly_flags": (None, "error")}


def test_limits(spark):
    frame = spark.createDataFrame([(0.0, 0.0), (100.0, 100.0), (20.0, -1.0), (20.0, 101.0)], "temperature double, humidity double")
    assert results(q.run_checks(frame, "t", q.within_limits())) == {
        "temperature_range": (0, "passed"),
        "humidity_range": (2, "failed"),
    }


def test_all_row_checks_share_one_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(0, 1, 1)], FLAGS).withColumn("temperature", F.lit(1.0)).withColumn("humidity", F.lit(1.0)).write.parquet(path)
    checks = [q.not_empty(), q.flags_are_binary(), *q.within_limits()]
    frame = q.run_checks(spark.read.parquet(path), "t", checks)
    assert frame._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1


def test_unique_window(spark):
    frame = spark.createDataFrame([(1,), (1,), (2,), (3,), (3,), (3,)], "window_start int")
    assert results(q.unique_windows(frame, "t")) == {"unique_window": (2, "failed")}
    assert results(q.unique_windows(frame.distinct(), "t")) == {"unique_window": (0, "passed")}


def test_duplicates_both_ways(spark):
    rows = [(1, "a", 0.5)] * 3 + [(2, "a", None)] * 2 + [(3, "b", float("nan"))] * 2 + [(4, "c", 1.0)]
    frame = spark.createDataFrame(rows, "k int, s string, d double")
    assert results(q.no_duplicate_rows(frame, "t")) == {"duplicate_rows": (4, "failed")}
    for unique in (frame.distinct(), frame.limit(0)):
        assert results(q.no_duplicate_rows(unique, "t")) == {"duplicate_rows": (0, "passed")}


def test_summary(spark):
    frame = spark.createDataFrame([(0, 1, 1), (0, 1, 1)], FLAGS)
    parts = q.run_checks(frame, "t", [q.not_empty(), q.flags_are_binary(), *q.within_limits()])
    parts = parts.unionByName(q.no_duplicate_rows(frame, "t")).unionByName(q.skipped(spark, "gone", ["row_count"]))
    assert values(q.summarize_checks(parts)) == [(6, 2, 1, 2, 1)]


def test_tables_that_are_missing_are_skipped(spark):
    frame = spark.createDataFrame([(1, 2)], "window_start int, window_end int")
    frame.write.mode("overwrite").saveAsTable("rollup_only")
    report = check_tables(spark, "no_flagged", "rollup_only")
    counted = {row["status"]: row["n"] for row in report.groupBy("status").agg(F.count("*").alias("n")).collect()}
    assert counted == {"skipped": 6, "passed": 3, "failed": 1}
    spark.sql("DROP TABLE rollup_only")


def test_profile(spark):
    frame = clean(spark, [(0, 1.0), (1, 1.0), (2, 3.0), (3, None)])
    row = next(row for row in values(q.profile(frame)) if row[0] == "temperature")
    assert row == ("temperature", 3, 1.0, 3.0, 2)
    assert values(q.profile(frame)) == values(q.profile(frame, exact=False))
    assert q.profile(frame).count() == len(METRICS)


def test_checks_of_one_name(spark):
    frame = spark.createDataFrame([(1,)], "v int")
    found = q.run_checks(frame, "t", [q.not_empty(), q.not_empty(), q.has_columns(frame, ["w"])])
    assert values(found, "check", "bad_rows") == [("row_count", 0), ("row_count", 0), ("schema_columns", 1)]


def test_the_schema_is_checked_without_a_scan(spark, small):
    events = spark.read.parquet(f"{small}/events.parquet")
    assert "Scan parquet" not in plan(q.run_checks(events, "t", [q.has_columns(events, ["x"])]))
