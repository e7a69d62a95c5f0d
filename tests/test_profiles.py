"""Exact quantiles, mergeable sketches and grouping sets against plain Python."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tests.helpers import epoch, plan, values
from tidegauge.operators import quantiles, rollups, sketches
from tidegauge.operators.anomalies import flag_anomalies
from tidegauge.schema import METRICS, TIME
from tidegauge.sources.workspace import Scratch

INF = math.inf


def order(x):
    return (math.isnan(x), 0 if math.isnan(x) else x)


def plain_quantile(data, q):
    data = sorted((x for x in data if x is not None), key=order)
    return data[max(1, math.ceil(q * len(data))) - 1] if data else None


def same(a, b):
    return a is b or a == b or (a is not None and b is not None and math.isnan(a) and math.isnan(b))


CASES = {
    "one": [5.0],
    "ties": [1.0] * 50 + [2.0] * 49,
    "even": [4.0, 1.0, 3.0, 2.0],
    "missing": [None, 1.0, None, 7.0],
    "special": [math.nan, INF, -INF, 0.0, -0.0, 1.0, INF],
    "mostly nan": [math.nan] * 5 + [1.0],
    "huge": [-1.7e308, 1.7e308, 5e-324, 0.0, 1.0],
    "scales": [10.0**i for i in range(-40, 41)],
    "random": [random.Random(3).gauss(0, 1) for _ in range(4000)],
    "none": [None, None],
}


@pytest.mark.parametrize("q", [0.0, 0.5, 0.99])
@pytest.mark.parametrize("bins", [64, 2048])
def test_exact_quantiles(spark, monkeypatch, q, bins):
    """All cases as keys of one table, and each alone without keys."""
    monkeypatch.setattr(quantiles, "BINS", bins)
    rows = [(key, x) for key, data in CASES.items() for x in data] + [(None, 3.0)]
    frame = spark.createDataFrame(rows, "k string, x double")
    scratch = Scratch(spark, "quantiles")
    found = {row.k: row for row in quantiles.exact_quantile(frame, "x", q, ["k"], scratch).collect()}
    assert found.keys() == CASES.keys() - {"none"}
    for key, row in found.items():
        assert same(row.quantile, plain_quantile(CASES[key], q)), key
        assert row.n == sum(x is not None for x in CASES[key])
    for key in ("random", "special", "none"):
        alone = quantiles.exact_quantile(frame.where(F.col("k") == key), "x", q, [], scratch).first()
        assert same(alone.quantile, plain_quantile(CASES[key], q)), key
    scratch.close()


def test_robust_baseline(spark):
    """One huge outlier moves neither the median nor the deviation, and is flagged."""
    scratch = Scratch(spark, "robust")
    data = [("a", float(x), 1.0) for x in range(101)] + [("a", 1e9, 1.0), ("b", 7.0, None)]
    readings = spark.createDataFrame(data, "k string, temperature double, humidity double")
    stats = quantiles.robust_baseline(readings, scratch)
    row = stats.first()
    assert (row.readings, row.median_temp, row.mad_temp) == (103, 50.0, 26.0)
    assert row.std_temp == pytest.approx(26 * 1.4826) and row.std_humidity == 0.0001
    assert flag_anomalies(readings, stats).where("temp_anomaly = 1").count() == 1
    by_key = {row.k: row for row in quantiles.robust_baseline(readings, scratch, ("k",)).collect()}
    assert (by_key["a"].median_temp, by_key["b"].median_temp, by_key["b"].median_humidity) == (50.0, 7.0, None)
    assert by_key["b"].mean_humidity == 0.0


def clean(spark, rows):
    frame = spark.createDataFrame(rows, "s bigint, temperature double")
    others = (F.lit(1.0).alias(metric) for metric in METRICS[1:])
    return frame.select(F.timestamp_seconds("s").alias(TIME), "temperature", *others)


def test_sketches_add_up(spark):
    rnd = random.Random(1)
    rows = [(rnd.choice([None, rnd.randrange(500_000)]), float(rnd.randrange(30_000))) for _ in range(60_000)]
    rows += [(0, None), (0, 0.0), (1, -0.0)]
    stored = sketches.sketch_windows(clean(spark, rows))
    assert stored.select("window_start").distinct().count() == 140
    row = sketches.profile_of(stored).where("metric = 'temperature'").first()
    data = sorted(x for _, x in rows if x is not None)
    exact = len(set(data))
    assert (row.non_null, row.min_value, row.max_value) == (len(data), data[0], data[-1])
    assert abs(row.distinct_values - exact) <= exact * sketches.DISTINCT_ERROR
    for q, found in ((0.5, row.q50), (0.95, row.q95), (0.99, row.q99)):
        assert sum(x < found for x in data) / len(data) <= q + sketches.RANK_ERROR
        assert sum(x <= found for x in data) / len(data) >= q - sketches.RANK_ERROR
    one = sketches.profile_of(stored).where("metric = 'light'").first()
    assert (one.distinct_values, one.q50) == (1, 1.0)


def test_sketches_of_nothing(spark):
    empty = sketches.profile_of(sketches.sketch_windows(clean(spark, [(0, None)]))).where("metric = 'temperature'").first()
    assert (empty.non_null, empty.distinct_values, empty.q50) == (0, 0, None)
    assert sketches.profile_of(sketches.sketch_windows(clean(spark, []))).collect() == []


def test_groupings_in_one_pass(spark):
    rows = [("a", 0, 1.0, 1), ("a", 10, 3.0, 0), ("a", 3600, 5.0, 0), ("b", 90_000, 7.0, 1), (None, None, 9.0, 1)]
    frame = spark.createDataFrame(rows, "k string, s bigint, temperature double, overall_anomaly int")
    flagged = frame.select(
        "k", F.timestamp_seconds("s").alias(TIME), "temperature", "overall_anomaly", *(F.lit(1.0).alias(m) for m in METRICS[1:])
    )
    sets = (("k", "hour"), ("k",), ("day",), ())
    found = rollups.summarize_groups(flagged, ("k",), sets)
    got = values(found.select("grouping", "k", epoch("hour"), epoch("day"), "readings", "avg_temp", "total_anomalies"))
    assert got == sorted(
        [
            ("", None, None, None, 5, 5.0, 3),
            ("day", None, None, 0, 3, 3.0, 1),
            ("day", None, None, 86400, 1, 7.0, 1),
            ("day", None, None, None, 1, 9.0, 1),
            ("k", "a", None, None, 3, 3.0, 1),
            ("k", "b", None, None, 1, 7.0, 1),
            ("k", None, None, None, 1, 9.0, 1),
            ("k,hour", "a", 0, None, 2, 2.0, 1),
            ("k,hour", "a", 3600, None, 1, 5.0, 0),
            ("k,hour", "b", 90000, None, 1, 7.0, 1),
            ("k,hour", None, None, None, 1, 9.0, 1),
        ],
        key=lambda row: tuple((x is None, x) for x in row),
    )
    assert plan(found).count("Scan ExistingRDD\n") <= 2  # named in the tree and in the details
