"""Islands, sessions and as-of joins against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from tests.helpers import epoch, plan, values
from tidegauge.operators import asof, islands
from tidegauge.schema import METRICS, TIME


def moments(spark, rows, columns="k string"):
    return spark.createDataFrame(rows, f"{columns}, s bigint").withColumn(TIME, F.timestamp_seconds("s")).drop("s")


def plain_islands(rows, gap, closed=True):
    found = []
    for key in {key for key, _ in rows}:
        times = sorted(s for k, s in rows if k == key and s is not None)
        for i, s in enumerate(times):
            near = i and (s - times[i - 1] < gap or closed and s - times[i - 1] == gap)
            if near:
                found[-1][2:] = [s, found[-1][3] + 1]
            else:
                found.append([key, s, s, 1])
    return sorted(map(tuple, found), key=lambda row: tuple((x is None, x) for x in row))


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("closed", [True, False])
def test_islands_over_segments(spark, seed, closed):
    """Gaps within and across segments, islands that span many, and a NULL key."""
    rnd = random.Random(seed)
    rows, s = [], -500
    for _ in range(300):
        s += rnd.choice([0, 1, 9, 10, 11, 30, 400]) if rnd.random() < 0.7 else 10
        rows.append((rnd.choice(["a", "a", "b", None]), s))
    rows += [("steady", 10 * i) for i in range(200)] + [("a", None), (None, None)]
    found = islands.find_islands(
        moments(spark, rows), ["k"], 10, {"n": (F.count("*"), F.sum("n"))}, closed=closed, segment_seconds=60
    )
    assert values(found.select("k", epoch("first"), epoch("last"), "n")) == plain_islands(rows, 10, closed)


def rate_of(spark, counts):
    rows = [(600 * i, n) for i, n in counts.items()]
    frame = spark.createDataFrame(rows, "s bigint, anomaly_count bigint")
    return frame.select(F.timestamp_seconds("s").alias("window_start"), "anomaly_count")


def episodes(spark, counts, threshold=2):
    found = islands.spike_episodes(rate_of(spark, counts), threshold)
    return values(found.select(epoch("episode_start"), epoch("episode_end"), "windows", "anomalies", "peak", epoch("peak_start")))


def test_spike_episodes(spark):
    counts = {0: 2, 1: 5, 2: 5, 3: 1, 4: 3, 143: 2, 144: 7, 145: 2, 300: 9}
    assert episodes(spark, counts) == [
        (0, 1800, 3, 12, 5, 600),
        (2400, 3000, 1, 3, 3, 2400),
        (143 * 600, 146 * 600, 3, 11, 7, 144 * 600),
        (300 * 600, 301 * 600, 1, 9, 9, 300 * 600),
    ]
    assert episodes(spark, counts, 100) == []
    days = {i: 2 + (i == 500) for i in range(1000)}
    assert episodes(spark, days) == [(0, 600_000, 1000, 2001, 3, 300_000)]


def test_sessions_equal_the_built_in_window(spark):
    rnd = random.Random(9)
    rows = [(rnd.choice("ab"), rnd.randrange(0, 400_000), rnd.random()) for _ in range(500)]
    rows += [("a", 1000, 1.0), ("a", 1000 + 1800, 2.0), ("hot", 7, 3.0), ("hot", 7, 4.0)]
    frame = spark.createDataFrame([(k, float(i), s) for i, (k, s, _) in enumerate(rows)], "k string, x double, s bigint")
    readings = frame.select("k", F.timestamp_seconds("s").alias(TIME), *(F.col("x").alias(m) for m in METRICS))
    columns = ["k", "session_start", "session_end", "readings"]
    ours, built_in = (make(readings, ["k"]) for make in (islands.device_sessions, islands.session_averages))
    assert values(ours, *columns) == values(built_in, *columns)
    close = [(a, b) for a, b in zip(values(ours), values(built_in), strict=True)]
    for a, b in close:
        assert a[4:] == pytest.approx(b[4:])


def plain_asof(left, right, tolerance=None):
    out = []
    for i, (key, s) in enumerate(left):
        known = [(t, v) for k, t, v in right if key is not None and s is not None and k == key and t is not None and t <= s]
        at, value = max(known, default=(None, None), key=lambda x: (x[0], x[1] is not None, x[1] or 0))
        if at is not None and tolerance is not None and s - at > tolerance:
            at, value = None, None
        out.append((i, at, value))
    return out


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("tolerance", [None, 50])
def test_asof_join(spark, seed, tolerance):
    """Empty buckets, ties, rows at bucket edges, missing keys and times, one hot key and moment."""
    rnd = random.Random(seed)
    keys = ["a", "hot", "hot", "hot", None, "only left"]
    left = [(rnd.choice(keys), rnd.choice([None, 100, 3600, 7200, rnd.randrange(20_000)])) for _ in range(200)]
    left += [("hot", 5000)] * 50
    right = [(rnd.choice([*keys[:4], None, "only right"]), rnd.choice([None, 0, 3600, rnd.randrange(20_000)]), i) for i in range(60)]
    left_rows = spark.createDataFrame([(i, k, s) for i, (k, s) in enumerate(left)], "i int, k string, s bigint")
    right_rows = spark.createDataFrame(right, "k string, s bigint, v int")
    joined = asof.asof_join(
        left_rows.withColumn(TIME, F.timestamp_seconds("s")),
        right_rows.withColumn("at", F.timestamp_seconds("s")),
        ["k"],
        ["v"],
        right_time="at",
        tolerance_seconds=tolerance,
    )
    assert values(joined.select("i", epoch("matched_time"), "v")) == plain_asof(left, right, tolerance)


def test_asof_without_keys_and_with_missing_values(spark):
    left = moments(spark, [("x", 10), ("y", 4000), ("z", 5)])
    right = spark.createDataFrame([(10, None, 2), (10, 1, None), (3000, None, None)], "s bigint, v int, w int")
    joined = asof.asof_join(left, right.withColumn(TIME, F.timestamp_seconds("s")), [], ["v", "w"])
    assert values(joined, "k", "v", "w") == [("x", 1, None), ("y", None, None), ("z", None, None)]
    matched = values(joined.select("k", epoch("matched_time")))
    assert matched == [("x", 10), ("y", 3000), ("z", None)]


def test_asof_plan_has_no_join_of_all_rows(spark):
    left, right = (moments(spark, [("a", 1)]) for _ in range(2))
    text = plan(asof.asof_join(left, right.withColumn("v", F.lit(1)), ["k"], ["v"]))
    assert "NestedLoop" not in text and "Cartesian" not in text
