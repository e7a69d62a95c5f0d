"""Raw text readings to typed, valid readings."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions import epoch_to_timestamp, to_number
from tidegauge.schema import METRICS, RAW_COLUMNS, TIME

Bounds = Mapping[str, tuple[float | None, float | None]]
NOT_NEGATIVE: Bounds = {metric: (0.0, None) for metric in METRICS}


def to_typed(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Lower-case names, numbers as double, and the event time of each reading."""
    time, *metrics = RAW_COLUMNS
    return raw.select(
        *keep,
        F.col(time).alias("time"),
        *(to_number(F.col(name)).alias(name.lower()) for name in metrics),
        epoch_to_timestamp(F.col(time)).alias(TIME),
    )


def metric_faults(
    bounds: Bounds = NOT_NEGATIVE, *, reject_nonfinite: bool = False
) -> list[Column]:
    """Per metric, the reason why a reading is invalid, or NULL."""
    return [_fault(name, *limits, reject_nonfinite) for name, limits in bounds.items()]


def _fault(name: str, low: float | None, high: float | None, reject_nonfinite: bool) -> Column:
    value = F.col(name)
    fault = F.when(value.isNull(), f"{name} missing")
    if reject_nonfinite:
        fault = fault.when(_nonfinite(value), f"{name} not finite")
    if low is not None:
        fault = fault.when(value < low, f"{name} below {low:g}")
    if high is not None:
        fault = fault.when(value > high, f"{name} above {high:g}")
    return fault


def is_valid(bounds: Bounds = NOT_NEGATIVE, *, reject_nonfinite: bool = False) -> Column:
    """True if every metric is present and inside its bounds; else False or NULL.

    A comparison is never true for NULL, so each value is looked at only once
    where it has a lower bound.
    """
    conditions = []
    for name, (low, high) in bounds.items():
        value = F.col(name)
        conditions.append(value.isNotNull() if low is None else value >= low)
        if high is not None:
            conditions.append(value <= high)
        if reject_nonfinite:
            conditions.append(~_nonfinite(value))
    return reduce(and_, conditions)


def _nonfinite(value: Column) -> Column:
    return F.isnan(value) | (F.abs(value) == F.lit(float("inf")))


def keep_valid(
    typed: DataFrame, bounds: Bounds = NOT_NEGATIVE, *, reject_nonfinite: bool = False
) -> DataFrame:
    return typed.filter(is_valid(bounds, reject_nonfinite=reject_nonfinite))


def rejected(
    typed: DataFrame, bounds: Bounds = NOT_NEGATIVE, *, reject_nonfinite: bool = False
) -> DataFrame:
    """The rows ``keep_valid`` leaves out, with all reasons in metric order."""
    valid = is_valid(bounds, reject_nonfinite=reject_nonfinite)
    reasons = metric_faults(bounds, reject_nonfinite=reject_nonfinite)
    return typed.filter(~F.coalesce(valid, F.lit(False))).withColumn(
        "reject_reason", F.concat_ws(", ", *reasons)
    )


def clean_readings(
    raw: DataFrame,
    keep: tuple[str, ...] = (),
    bounds: Bounds = NOT_NEGATIVE,
    *,
    reject_nonfinite: bool = False,
) -> DataFrame:
    """Raw readings to valid readings.

    From the comparisons Spark infers null checks on the text columns and pushes
    them into the scan.
    """
    return keep_valid(to_typed(raw, keep), bounds, reject_nonfinite=reject_nonfinite)
