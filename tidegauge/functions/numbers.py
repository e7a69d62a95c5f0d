"""Number parsing and the statistics used for scoring."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidegauge.schema import FALLBACK_STD, SIGMAS


def to_number(text: Column) -> Column:
    """Text to double; text that is no number gives NULL under ANSI mode as well."""
    return text.try_cast("double")


def usable_mean(mean: Column) -> Column:
    """A mean to score against: 0 where there were no rows."""
    return F.coalesce(mean, F.lit(0.0))


def usable_std(std: Column, fallback: float = FALLBACK_STD) -> Column:
    """A deviation to score against: a tiny one where it is unknown or zero."""
    return F.coalesce(F.nullif(std, F.lit(0.0)), F.lit(fallback))


def deviates(value: Column, mean: Column, std: Column, sigmas: float = SIGMAS) -> Column:
    """1 if the value lies more than ``sigmas`` deviations off the mean, else 0."""
    beyond = F.abs(value - mean) > std * F.lit(float(sigmas))
    return F.coalesce(beyond.cast("int"), F.lit(0))


def zscore(value: Column, mean: Column, std: Column) -> Column:
    return F.try_divide(value - mean, std)


def correlation(x: str, y: str) -> Column:
    """Pearson correlation as an aggregate; NULL for a constant column.

    ``corr`` itself raises a division error on constant input under ANSI mode.
    """
    if x == y:
        return F.try_divide(F.var_pop(x), F.var_pop(x))
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))
