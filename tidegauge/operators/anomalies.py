"""Scoring readings against a baseline."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions import deviates, zscore
from tidegauge.operators.baseline import baseline_by_key, mean_name, std_name
from tidegauge.operators.keyed_join import attach_by_key
from tidegauge.schema import (
    ANOMALY_DETAILS,
    DECIMALS,
    OVERALL_FLAG,
    SCORED_METRICS,
    SIGMAS,
    TIME,
    flag,
    short,
)


def one_row(stats: DataFrame) -> Callable[[str], Column]:
    """Look up columns of a one-row frame as scalar subquery values.

    The statistics stay inside the plan: Spark runs them once, checks that there
    is one row, and puts the value into the scan of the large side. No join.
    """
    row = stats.select(F.struct(*stats.columns)).scalar()
    return lambda name: row[name]


def _flags(value_of: Callable[[str], Column], metrics: tuple[str, ...], sigmas: float) -> dict:
    flags = {
        flag(metric): deviates(
            F.col(metric), value_of(mean_name(metric)), value_of(std_name(metric)), sigmas
        )
        for metric in metrics
    }
    return {**flags, OVERALL_FLAG: reduce(F.greatest, flags.values())}


def flag_anomalies(
    readings: DataFrame,
    stats: DataFrame,
    metrics: tuple[str, ...] = SCORED_METRICS,
    sigmas: float = SIGMAS,
) -> DataFrame:
    """Add a 0/1 flag per metric and one for any of them."""
    return readings.withColumns(_flags(one_row(stats), metrics, sigmas))


def flag_anomalies_by_key(
    readings: DataFrame,
    keys: list[str],
    metrics: tuple[str, ...] = SCORED_METRICS,
    sigmas: float = SIGMAS,
) -> DataFrame:
    """The same against each key's own baseline; rows without a key get no flag."""
    stats = baseline_by_key(readings, keys, metrics)
    scored = attach_by_key(readings, stats, keys, "readings")
    return scored.withColumns(_flags(F.col, metrics, sigmas)).select(
        *readings.columns, *(flag(metric) for metric in metrics), OVERALL_FLAG
    )


def zscores(
    readings: DataFrame, stats: DataFrame, metrics: tuple[str, ...] = SCORED_METRICS
) -> DataFrame:
    """Add the signed distance from the mean in deviations, per metric."""
    value_of = one_row(stats)
    return readings.withColumns(
        {
            f"z_{short(metric)}": zscore(
                F.col(metric), value_of(mean_name(metric)), value_of(std_name(metric))
            )
            for metric in metrics
        }
    )


def only_anomalies(flagged: DataFrame) -> DataFrame:
    return flagged.filter(F.col(OVERALL_FLAG) == 1)


def anomaly_log(flagged: DataFrame, digits: int = DECIMALS) -> DataFrame:
    """One log row per flagged reading, also for those without a time."""
    return only_anomalies(flagged).select(
        F.round("temperature", digits).alias("temp_value"),
        F.round("humidity", digits).alias("humidity_value"),
        F.col(TIME).alias("detected_at"),
        F.lit(ANOMALY_DETAILS).alias("details"),
    )
