"""Averages by way of parts: sums and counts that can be added up again.

The count is kept per metric, because an average leaves missing values out.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def part_names(metrics: tuple[str, ...]) -> list[str]:
    return [f"{what}_{metric}" for metric in metrics for what in ("sum", "n")]


def sums_of(metrics: tuple[str, ...]) -> list[Column]:
    """Aggregates that make parts out of readings."""
    columns = []
    for metric in metrics:
        columns.append(F.sum(metric).alias(f"sum_{metric}"))
        columns.append(F.count(metric).alias(f"n_{metric}"))
    return columns


def merged(metrics: tuple[str, ...]) -> list[Column]:
    """Aggregates that add parts up to larger parts."""
    return [F.sum(name).alias(name) for name in part_names(metrics)]


def average_of_parts(metric: str) -> Column:
    """Aggregate: the average over all parts."""
    return F.try_divide(F.sum(f"sum_{metric}"), F.sum(f"n_{metric}"))
