"""Operators against brute force on random readings."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.helpers import clean, values
from tidegauge.operators import quality
from tidegauge.operators.rolling import rolling_averages, sliding_averages
from tidegauge.operators.windows import attach_window_averages, tumbling_averages

FEW = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
SECONDS = st.one_of(st.none(), st.integers(-6, 30).map(lambda n: n * 150), st.integers(-900, 9000))
ROWS = st.lists(
    st.tuples(SECONDS, st.integers(0, 1000).map(lambda n: n / 4)), min_size=1, max_size=30
)


def window_means(rows):
    windows = {}
    for s, t in rows:
        if s is not None:
            windows.setdefault(s // 300 * 300, []).append(t)
    return {start: sum(ts) / len(ts) for start, ts in windows.items()}


def brute_join(rows, closed):
    means = window_means(rows)
    joined = []
    for s, t in rows:
        hits = [
            mean
            for start, mean in means.items()
            if s is not None
            and (start <= s < start + 300 or (closed == "both" and s == start + 300))
        ]
        joined += [(t, round(mean, 6)) for mean in hits] or [(t, None)]
    return sorted(joined, key=lambda row: (row[0], row[1] is None, row[1] or 0))


@FEW
@given(ROWS, st.sampled_from(["both", "left"]))
def test_interval_join(spark, rows, closed):
    readings = clean(spark, rows)
    joined = attach_window_averages(readings, tumbling_averages(readings), closed=closed)
    found = values(joined.select("temperature", F.round("avg_temp_5min", 6)))
    assert found == brute_join(rows, closed)


@FEW
@given(ROWS, st.sampled_from([60, 300, 7200]))
def test_rolling(spark, rows, seconds):
    expected = []
    for s, t in rows:
        near = [v for at, v in rows if None not in (s, at) and s - seconds <= at <= s]
        expected.append((t, round(sum(near) / len(near), 6) if near else None))
    moving = rolling_averages(clean(spark, rows), seconds)
    found = values(moving.select("temperature", F.round("rolling_temp", 6)))
    assert found == sorted(expected, key=lambda row: (row[0], row[1] is None, row[1] or 0))


@FEW
@given(ROWS)
def test_sliding(spark, rows):
    expected = {}
    for s, t in rows:
        if s is not None:
            for back in range(5):
                expected.setdefault(s // 60 * 60 - back * 60, []).append(t)
    sliding = sliding_averages(clean(spark, rows))
    found = values(
        sliding.select(F.unix_seconds("window_start"), "readings", F.round("sliding_temp", 6))
    )
    assert found == sorted(
        (start, len(ts), round(sum(ts) / len(ts), 6)) for start, ts in expected.items()
    )


@FEW
@given(st.lists(st.tuples(st.integers(0, 3), st.sampled_from(["a", "b", None])), max_size=40))
def test_duplicates(spark, rows):
    frame = spark.createDataFrame(rows, "k int, s string")
    found = quality.no_duplicate_rows(frame, "t").first()["bad_rows"]
    assert found == len(rows) - len(set(rows))
