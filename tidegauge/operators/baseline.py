"""Mean and deviation that readings are scored against."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions import bucket_start, on_bucket_edge, usable_mean, usable_std
from tidegauge.schema import (
    AVERAGE_SECONDS,
    METRICS,
    SCORED_METRICS,
    TIME,
    short,
    window_average,
)


def mean_name(metric: str) -> str:
    return f"mean_{short(metric)}"


def std_name(metric: str) -> str:
    return f"std_{short(metric)}"


def _baseline_columns(metrics: tuple[str, ...]) -> list[Column]:
    columns = []
    for metric in metrics:
        columns.append(usable_mean(F.avg(metric)).alias(mean_name(metric)))
        columns.append(usable_std(F.stddev_samp(metric)).alias(std_name(metric)))
    return columns


def baseline(readings: DataFrame, metrics: tuple[str, ...] = SCORED_METRICS) -> DataFrame:
    """One row with mean and sample deviation per metric, ready to score with."""
    return readings.agg(*_baseline_columns(metrics))


def baseline_by_key(
    readings: DataFrame, keys: list[str], metrics: tuple[str, ...] = SCORED_METRICS
) -> DataFrame:
    """The same per key, with the number of readings behind it."""
    return readings.groupBy(*keys).agg(
        F.count("*").alias("readings"), *_baseline_columns(metrics)
    )


def summarize_windows(
    readings: DataFrame,
    seconds: int = AVERAGE_SECONDS,
    metrics: tuple[str, ...] = METRICS,
    scored: tuple[str, ...] = SCORED_METRICS,
) -> DataFrame:
    """One pass over the readings for both the window averages and the baseline.

    A row per window, and one with a NULL start for readings without a time.
    Next to the averages it holds the spread of each scored metric, for all
    readings of the window and for those exactly on its edge, because the edge
    readings count twice where the window before has readings.
    """
    on_edge = on_bucket_edge(F.col(TIME), seconds)
    spread = []
    for metric in scored:
        at_edge = F.when(on_edge, F.col(metric))
        spread += [
            F.count(metric).alias(f"n_{metric}"),
            F.var_pop(metric).alias(f"var_{metric}"),
            F.min(metric).alias(f"min_{metric}"),
            F.max(metric).alias(f"max_{metric}"),
            F.count(at_edge).alias(f"edge_n_{metric}"),
            F.avg(at_edge).alias(f"edge_avg_{metric}"),
            F.var_pop(at_edge).alias(f"edge_var_{metric}"),
        ]
    return readings.groupBy(bucket_start(F.col(TIME), seconds).alias("window_start")).agg(
        F.count("*").alias("readings"),
        *(F.avg(metric).alias(window_average(metric)) for metric in metrics),
        *spread,
    )


def _weighted_parts(summary: DataFrame, closed: str, scored: tuple[str, ...]) -> DataFrame:
    """Count, mean and variance of each disjoint part of the joined readings."""
    whole = summary.select(
        *(F.col(window_average(metric)).alias(f"avg_{metric}") for metric in scored),
        *(f"{what}_{metric}" for metric in scored for what in ("n", "var", "min", "max")),
    )
    if closed == "left":
        return whole
    repeated = summary.filter("has_previous").select(
        *(
            F.col(f"edge_{what}_{metric}").alias(f"{what}_{metric}")
            for metric in scored
            for what in ("n", "avg", "var")
        ),
    )
    return whole.unionByName(repeated, allowMissingColumns=True)


def baseline_of(
    summary: DataFrame,
    *,
    closed: str = "both",
    scored: tuple[str, ...] = SCORED_METRICS,
) -> DataFrame:
    """The baseline of the joined readings, from the window summary alone.

    For ``closed="both"`` the summary must hold ``has_previous``. Equal to
    ``baseline(attach_window_averages(..))`` up to float rounding, and saves that
    pass over the readings: variances of the parts add up as
    ``sum(n * var + n * (avg - mean)^2)``. A metric that never varies has
    deviation 0 exactly, as the direct aggregate has.
    """
    parts = _weighted_parts(summary, closed, scored)
    means = parts.agg(
        *(
            F.try_divide(
                F.sum(F.col(f"n_{metric}") * F.col(f"avg_{metric}")), F.sum(f"n_{metric}")
            ).alias(metric)
            for metric in scored
        )
    )
    mean_of = means.select(F.struct(*scored)).scalar()
    columns = []
    for metric in scored:
        n = F.col(f"n_{metric}")
        mean = mean_of[metric]
        off_mean = F.col(f"avg_{metric}") - mean
        squares = F.sum(n * (F.col(f"var_{metric}") + off_mean * off_mean))
        spread = F.max(f"max_{metric}") - F.min(f"min_{metric}")
        std = F.when(spread == 0, F.lit(0.0)).otherwise(
            F.sqrt(F.try_divide(squares, F.sum(n) - 1))
        )
        columns.append(usable_mean(F.max(mean)).alias(mean_name(metric)))
        columns.append(usable_std(std).alias(std_name(metric)))
    return parts.agg(*columns)
