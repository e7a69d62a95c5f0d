"""Metric records, alerts, retention and ordered output."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions import clamp_timestamp, shift_seconds, utc_wall_clock
from tidegauge.schema import (
    DIMENSIONS_TYPE,
    METRIC_NAMESPACE,
    METRIC_RATE,
    METRIC_TOTAL,
    METRIC_UNIT,
    TIME,
)


def as_instant(now: Column | dt.datetime | None) -> Column:
    """A fixed "now"; None takes the start time of the query."""
    if now is None:
        return F.current_timestamp()
    if isinstance(now, dt.datetime):
        if now.tzinfo is None:
            now = now.replace(tzinfo=dt.timezone.utc)
        micros = round(now.timestamp() * 1_000_000)
        return F.timestamp_micros(F.lit(micros))
    return now


def as_metric(
    rollup: DataFrame,
    name: str,
    value: str,
    *,
    time: str = "window_start",
    now: Column | dt.datetime | None = None,
    namespace: str = METRIC_NAMESPACE,
    unit: str = METRIC_UNIT,
    dimensions: Column | None = None,
) -> DataFrame:
    """One metric record per rollup row, its time clamped to the accepted range."""
    if dimensions is None:
        dimensions = F.array()
    return rollup.select(
        F.lit(namespace).alias("namespace"),
        F.lit(name).alias("metric_name"),
        dimensions.cast(DIMENSIONS_TYPE).alias("dimensions"),
        clamp_timestamp(F.col(time), as_instant(now)).alias("timestamp"),
        F.col(value).cast("double").alias("value"),
        F.lit(unit).alias("unit"),
    )


def metric_records(
    stats: DataFrame, rate: DataFrame, now: Column | dt.datetime | None = None
) -> DataFrame:
    """Records for the hourly totals and the 10-minute counts, for any batch sink."""
    totals = as_metric(stats, METRIC_TOTAL, "total_anomalies", now=now)
    return totals.unionByName(as_metric(rate, METRIC_RATE, "anomaly_count", now=now))


def alert_spikes(rate: DataFrame, threshold: int) -> DataFrame:
    """Windows with at least ``threshold`` anomalies, with a message to send."""
    return rate.filter(F.col("anomaly_count") >= threshold).withColumn(
        "message", F.concat(F.col("anomaly_count"), F.lit(" anomalies in one window"))
    )


def retain(
    readings: DataFrame, days: int, now: Column | dt.datetime | None = None, time: str = TIME
) -> DataFrame:
    """Readings of the last ``days`` days; of a table by ``event_date``, only these are read."""
    since = shift_seconds(as_instant(now), -days * 24 * 3600)
    kept = readings.filter(F.col(time) >= since)
    if "event_date" in readings.columns:
        kept = kept.filter(F.col("event_date") >= F.to_date(utc_wall_clock(since)))
    return kept


def in_key_order(readings: DataFrame, keys: list[str], time: str = TIME) -> DataFrame:
    """Readings ordered by time within each key.

    Ranges over key and time put a very busy key into several neighbouring
    partitions, where hashing on the key would put it all into one task. Equal
    times are told apart by the input partition, which a retried task keeps, so
    a pile-up at one moment is spread as well.
    """
    part = "input_partition"
    return (
        readings.withColumn(part, F.spark_partition_id())
        .repartitionByRange(*keys, time, part)
        .sortWithinPartitions(*keys, time)
        .drop(part)
    )
