"""Time rollups, trends, correlation and top-k reports."""

from __future__ import annotations

import datetime as dt
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions import bucket_start, correlation, shift_seconds
from tidegauge.operators.anomalies import only_anomalies
from tidegauge.operators.parts import average_of_parts, sums_of
from tidegauge.schema import (
    DECIMALS,
    METRICS,
    OVERALL_FLAG,
    RATE_SECONDS,
    REPORT_ROWS,
    ROLLUP_SECONDS,
    TIME,
    rollup_average,
)
from tidegauge.sources.workspace import materialize


def _window(time: str, seconds: int) -> Column:
    return F.window(time, f"{seconds} seconds").alias("window")


def _flat(rollup: DataFrame) -> DataFrame:
    """The window struct as two plain columns."""
    values = [name for name in rollup.columns if name != "window"]
    return rollup.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *values,
    )


def _rounded(value: Column, digits: int | None) -> Column:
    return value if digits is None else F.round(value, digits)


def device_stats(
    flagged: DataFrame,
    *,
    seconds: int = ROLLUP_SECONDS,
    metrics: tuple[str, ...] = METRICS,
    digits: int | None = DECIMALS,
    ordered: bool = True,
) -> DataFrame:
    """Average of each metric and number of anomalies per hour, in time order.

    On a stream, set a watermark first and ``ordered=False``.
    """
    rollup = flagged.groupBy(_window(TIME, seconds)).agg(
        *(_rounded(F.avg(metric), digits).alias(rollup_average(metric)) for metric in metrics),
        F.sum(OVERALL_FLAG).alias("total_anomalies"),
    )
    return _flat(rollup).orderBy("window_start") if ordered else _flat(rollup)


def anomaly_rate(flagged: DataFrame, *, seconds: int = RATE_SECONDS) -> DataFrame:
    """Number of anomalies per 10 minutes; windows without any are absent."""
    counts = only_anomalies(flagged).groupBy(_window(TIME, seconds))
    return _flat(counts.agg(F.count("*").alias("anomaly_count")))


def summarize_flagged(
    flagged: DataFrame,
    *,
    seconds: int = RATE_SECONDS,
    metrics: tuple[str, ...] = METRICS,
) -> DataFrame:
    """Sums and anomaly counts per short window, from which both rollups follow.

    With several outputs wanted, this is the one pass over the readings.
    """
    return _flat(
        flagged.groupBy(_window(TIME, seconds)).agg(
            *sums_of(metrics),
            F.sum(OVERALL_FLAG).alias("anomaly_count"),
        )
    )


def device_stats_of(
    summary: DataFrame,
    *,
    seconds: int = ROLLUP_SECONDS,
    metrics: tuple[str, ...] = METRICS,
    digits: int | None = DECIMALS,
) -> DataFrame:
    """``device_stats`` from a summary whose window divides ``seconds``."""
    averages = (
        _rounded(average_of_parts(metric), digits).alias(rollup_average(metric))
        for metric in metrics
    )
    rollup = summary.groupBy(_window("window_start", seconds)).agg(
        *averages, F.sum("anomaly_count").alias("total_anomalies")
    )
    return _flat(rollup).orderBy("window_start")


def anomaly_rate_of(summary: DataFrame) -> DataFrame:
    """``anomaly_rate`` from a summary with the same window."""
    return summary.filter(F.col("anomaly_count") > 0).select(
        "window_start", "window_end", "anomaly_count"
    )


def summarize_groups(
    flagged: DataFrame,
    keys: tuple[str, ...],
    groupings: tuple[tuple[str, ...], ...],
    metrics: tuple[str, ...] = METRICS,
) -> DataFrame:
    """Averages and anomaly counts by several groupings of keys, ``hour`` and ``day`` at once.

    The readings are read once and summed per key and hour; these sums are then added up
    by all ``groupings``. A column that a row is not grouped by is NULL there, and
    ``grouping`` names the columns that it is grouped by, so a NULL key stays apart.
    Readings without a time have NULL as hour and day.
    """
    hour = bucket_start(F.col(TIME), 3600)
    sums = flagged.groupBy(*keys, hour.alias("hour")).agg(
        F.count("*").alias("readings"), *sums_of(metrics), F.sum(OVERALL_FLAG).alias("anomalies")
    )
    parts = sums.withColumn("day", bucket_start(F.col("hour"), 24 * 3600))
    columns = [*keys, "hour", "day"]
    sets = [[F.col(name) for name in grouping] for grouping in groupings]
    named = F.concat_ws(",", *(F.when(F.grouping(name) == 0, name) for name in columns))
    return parts.groupingSets(sets, *columns).agg(
        named.alias("grouping"),
        F.sum("readings").alias("readings"),
        *(average_of_parts(metric).alias(rollup_average(metric)) for metric in metrics),
        F.sum("anomalies").alias("total_anomalies"),
    )


def fill_gaps(
    rate: DataFrame, first: dt.datetime, last: dt.datetime, *, seconds: int = RATE_SECONDS
) -> DataFrame:
    """Add the missing windows from that of ``first`` to that of ``last``, with count 0.

    The window starts come from a distributed range, so the length of the time span
    never sits in one row or one task. The caller names the ends, so a stray time cannot
    stretch the output; a window outside of them raises ``ValueError``.
    """
    rate = materialize(rate, "rate")
    step = seconds * 1_000_000
    low, high = (_micros(end) // step * step for end in (first, last))
    outside = rate.where(~F.unix_micros("window_start").between(low, high)).first()
    if outside is not None:
        raise ValueError(f"a window at {outside['window_start']} is outside of {first} to {last}")
    starts = rate.sparkSession.range(low, high + step, step).select(
        F.timestamp_micros("id").alias("window_start")
    )
    return starts.join(rate, "window_start", "left").select(
        "window_start",
        shift_seconds(F.col("window_start"), seconds).alias("window_end"),
        F.coalesce("anomaly_count", F.lit(0)).alias("anomaly_count"),
    )


def _micros(time: dt.datetime) -> int:
    if time.tzinfo is None:
        time = time.replace(tzinfo=dt.timezone.utc)
    return (time - dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)) // dt.timedelta(microseconds=1)


def temperature_trend(readings: DataFrame) -> DataFrame:
    """Average temperature per moment; readings without a time form one group.

    Readings of one moment are repeated together by the interval join, so the
    result is the same before and after it.
    """
    return readings.groupBy(TIME).agg(F.avg("temperature").alias("avg_temp"))


def correlation_matrix(readings: DataFrame, metrics: tuple[str, ...] = METRICS) -> DataFrame:
    """All pairwise correlations in long form, from one aggregation.

    Each unordered pair is computed once and reported in both directions.
    """
    pairs = list(combinations_with_replacement(metrics, 2))
    wide = readings.agg(*(correlation(x, y).alias(f"{x}__{y}") for x, y in pairs))
    cells = []
    for x, y in pairs:
        for row, column in sorted({(x, y), (y, x)}):
            cells.append(
                F.struct(
                    F.lit(row).alias("metric_x"),
                    F.lit(column).alias("metric_y"),
                    F.col(f"{x}__{y}").alias("corr"),
                )
            )
    return wide.select(F.inline(F.array(*cells)))


def first_windows(rollup: DataFrame, columns: list[str], rows: int = REPORT_ROWS) -> DataFrame:
    """The earliest windows of a rollup."""
    return rollup.select("window_start", "window_end", *columns).orderBy("window_start").limit(rows)


def latest_anomalies(log: DataFrame, rows: int = REPORT_ROWS) -> DataFrame:
    """The newest log rows; equal times are ordered by value, so the cut is stable."""
    return log.orderBy(
        F.col("detected_at").desc_nulls_last(), "temp_value", "humidity_value"
    ).limit(rows)


def hourly_plot_feed(stats: DataFrame) -> DataFrame:
    return stats.select("window_start", "avg_temp", "avg_humidity", "total_anomalies")


def rate_plot_feed(rate: DataFrame) -> DataFrame:
    return rate.select("window_start", "anomaly_count")
