"""Tumbling-window averages and their join back onto the readings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.functions import bucket_start, on_bucket_edge, shift_seconds
from tidegauge.operators.keyed_join import attach_by_key
from tidegauge.operators.parts import average_of_parts, merged, sums_of
from tidegauge.schema import AVERAGE_SECONDS, METRICS, TIME, window_average
from tidegauge.sources.workspace import materialize


def tumbling_averages(
    readings: DataFrame, seconds: int = AVERAGE_SECONDS, metrics: tuple[str, ...] = METRICS
) -> DataFrame:
    """Average of every metric per epoch-aligned window, with the row count.

    Partial sums are combined before the shuffle, so a window that holds a
    third of all rows costs its reducer no more than one row per map task.
    """
    return (
        readings.groupBy(F.window(TIME, f"{seconds} seconds").alias("window"))
        .agg(
            *(F.avg(metric).alias(window_average(metric)) for metric in metrics),
            F.count("*").alias("readings"),
        )
        .select("window.start", "window.end", "*")
        .withColumnsRenamed({"start": "window_start", "end": "window_end"})
        .drop("window")
    )


def window_sums(
    readings: DataFrame, seconds: int = AVERAGE_SECONDS, metrics: tuple[str, ...] = METRICS
) -> DataFrame:
    """Sums per window: a part that later parts of the same window can be added to."""
    return (
        readings.filter(F.col(TIME).isNotNull())
        .groupBy(bucket_start(F.col(TIME), seconds).alias("window_start"))
        .agg(F.count("*").alias("readings"), *sums_of(metrics))
    )


def merged_sums(parts: DataFrame, metrics: tuple[str, ...] = METRICS) -> DataFrame:
    """One row of sums per window from all its parts."""
    return parts.groupBy("window_start").agg(
        F.sum("readings").alias("readings"), *merged(metrics)
    )


def averages_of_sums(parts: DataFrame, metrics: tuple[str, ...] = METRICS) -> DataFrame:
    """Window averages from all parts of each window."""
    return parts.groupBy("window_start").agg(
        F.sum("readings").alias("readings"),
        *(average_of_parts(metric).alias(window_average(metric)) for metric in metrics),
    )


def with_previous(
    windows: DataFrame, columns: list[str], seconds: int = AVERAGE_SECONDS
) -> DataFrame:
    """Put the values of the window before next to each window.

    ``has_previous`` is False where that window holds no readings. Runs on the
    window table only, as an equi-join and not as one globally sorted partition.
    """
    previous = windows.select(
        shift_seconds(F.col("window_start"), seconds).alias("window_start"),
        F.lit(True).alias("has_previous"),
        *(F.col(name).alias(f"previous_{name}") for name in columns),
    )
    return windows.join(previous, "window_start", "left").withColumn(
        "has_previous", F.coalesce("has_previous", F.lit(False))
    )


def attach_window_averages(
    readings: DataFrame,
    windows: DataFrame,
    *,
    closed: str = "both",
    seconds: int = AVERAGE_SECONDS,
    columns: tuple[str, ...] = tuple(window_average(m) for m in METRICS),
) -> DataFrame:
    """Interval left join of readings with the windows made from them.

    ``closed="both"`` matches ``start <= time <= end``: a reading exactly on a
    window edge also lies at the end of the window before, and appears twice if
    that window has readings. ``closed="left"`` matches ``start <= time < end``.
    Readings without a time are kept with NULL averages.

    Each reading lies in exactly one window, so one equi-join on the window
    start finds it, and the window before comes along in the same lookup row.
    The plain interval condition would compare every reading with every window.
    """
    check_closed(closed)
    if closed == "both":
        windows = with_previous(materialize(windows, "windows"), list(columns), seconds)
    return attach_stored_windows(
        readings,
        materialize(windows, "lookup"),
        closed=closed,
        seconds=seconds,
        columns=columns,
    )


def check_closed(closed: str) -> None:
    if closed not in ("both", "left"):
        raise ValueError(f"closed must be 'both' or 'left', not {closed!r}")


def attach_stored_windows(
    readings: DataFrame,
    windows: DataFrame,
    *,
    closed: str = "both",
    seconds: int = AVERAGE_SECONDS,
    columns: tuple[str, ...] = tuple(window_average(m) for m in METRICS),
) -> DataFrame:
    """The same join for a window table that is written already.

    For ``closed="both"`` it must hold the previous window, see ``with_previous``.
    Only the columns asked for are read and broadcast.
    """
    names = list(columns)
    needed = ["window_start", "readings", *names]
    if closed == "both":
        needed += ["has_previous", *(f"previous_{name}" for name in names)]
    keyed = readings.withColumn("window_start", bucket_start(F.col(TIME), seconds))
    joined = attach_by_key(
        keyed,
        windows.select(*needed),
        ["window_start"],
        "readings",
        stored=True,
    )
    if closed == "left":
        return joined.select(*readings.columns, *names)

    in_two = on_bucket_edge(F.col(TIME), seconds) & F.col("has_previous")
    matches = F.when(in_two, F.array(F.lit(False), F.lit(True))).otherwise(
        F.array(F.lit(False))
    )
    return joined.withColumn("from_previous", F.explode(matches)).select(
        *readings.columns,
        *(
            F.when(F.col("from_previous"), F.col(f"previous_{name}"))
            .otherwise(F.col(name))
            .alias(name)
            for name in names
        ),
    )
