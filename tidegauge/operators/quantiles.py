"""Exact quantiles, and a baseline of median and absolute deviation that outliers don't move.

Nothing is sorted. A pass counts the values of each key in a fixed number of bins between
the key's bounds, and the bin that holds the wanted rank gives the next bounds: the least
and greatest value in it. When both are one value, that is the quantile. After the first
pass only values within the bounds are kept, a small part of all, and read again. Counts
are combined before the shuffle, so a key may hold most of the values.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.functions import usable_mean, usable_std
from tidegauge.operators.anomalies import one_row
from tidegauge.operators.baseline import mean_name, std_name
from tidegauge.operators.keyed_join import attach_by_key
from tidegauge.schema import SCORED_METRICS, short
from tidegauge.sources.workspace import Scratch

BINS = 2048
#: The deviation of normal values as a multiple of their median absolute deviation.
NORMAL_SCALE = 1.4826


def exact_quantile(rows: DataFrame, value: str, q: float, keys: list[str], scratch: Scratch) -> DataFrame:
    """``keys``, ``quantile`` and ``n``: the smallest value that a share ``q`` of values reach.

    As SQL's ``quantile_disc``. Missing values, and rows without a key, don't count. NaN is
    greater than all numbers. One row without keys, NULL if there is no value; the result
    is written.
    """
    present = F.col(value).isNotNull()
    for key in keys:
        present &= F.col(key).isNotNull()
    known = rows.where(present).select(*keys, (F.col(value) + F.lit(0.0)).alias("x"))
    finite = F.when(F.abs("x") < F.lit(float("inf")), F.col("x"))
    bounds = known.groupBy(*keys).agg(
        F.min(finite).alias("low"), F.max(finite).alias("high"), F.count("*").alias("n")
    )
    rank = F.greatest(F.ceil(F.col("n") * F.lit(q)), F.lit(1)).cast("long")
    bounds = scratch.table(bounds.withColumn("rank", rank), scratch.fresh("bounds"))
    sizes, answers = bounds.select(*keys, "n"), []
    known = _attach(known, bounds, keys)
    while True:
        chosen = scratch.table(_choose(known, keys), scratch.fresh("chosen"))
        answers.append(chosen.where("low = high").select(*keys, F.col("low").alias("quantile")))
        open_bounds = chosen.where("low <> high")
        if open_bounds.isEmpty():
            break
        inside = _attach(known.select(*keys, "x"), open_bounds, keys).where("x between low and high")
        known = scratch.table(inside, scratch.fresh("inside"))
    return scratch.table(_beside(sizes, reduce(DataFrame.union, answers), keys), scratch.fresh("quantile"))


def _beside(rows: DataFrame, more: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` with the columns of ``more``, which has a row per key, or one row at most."""
    if keys:
        return rows.join(more, keys, "left")
    value_of = one_row(more)
    return rows.withColumns({name: value_of(name) for name in more.columns})


def _attach(rows: DataFrame, bounds: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with the bounds of their key; rows of keys that have none any more go."""
    if not keys:
        return _beside(rows, bounds.select("low", "high", "rank"), keys)
    return attach_by_key(rows, bounds, keys, "n", stored=True).where("rank is not null")


def _choose(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The bin of each key that holds the wanted rank, as new bounds."""
    # halves, because the difference of two doubles may not be one; and that of halves may be 0
    share = F.try_divide(F.col("x") / 2 - F.col("low") / 2, F.col("high") / 2 - F.col("low") / 2)
    coarse = F.when(F.col("x") == F.col("low"), 0).otherwise(BINS - 1)
    place = (
        F.when(F.isnan("x"), BINS + 1)
        .when(F.col("x") == float("inf"), BINS)
        .when(F.col("x") == -float("inf"), -1)
        .when(F.col("low") == F.col("high"), 0)
        .when(share.isNull(), coarse)
        .otherwise(F.least(F.floor(share * BINS), F.lit(BINS - 1)))
    )
    counts = rows.groupBy(*keys, place.cast("int").alias("bin")).agg(
        F.count("*").alias("n"), F.min("x").alias("low"), F.max("x").alias("high"), F.first("rank").alias("rank")
    )
    in_order = Window.partitionBy(*keys).orderBy("bin")  # no more rows of a key than bins
    upto = F.sum("n").over(in_order)
    return (
        counts.withColumn("upto", upto)
        .where((F.col("upto") >= F.col("rank")) & (F.col("upto") - F.col("n") < F.col("rank")))
        .select(*keys, "low", "high", "n", (F.col("rank") - F.col("upto") + F.col("n")).alias("rank"))
    )


def robust_baseline(
    readings: DataFrame, scratch: Scratch, keys: tuple[str, ...] = (), metrics: tuple[str, ...] = SCORED_METRICS
) -> DataFrame:
    """Median and median absolute deviation per metric, overall or per key.

    ``median_temp, mad_temp`` and so on, the number of ``readings``, and the columns of
    :func:`baseline` made of them, so that readings can be scored with it: the median as
    mean, and the deviation that normal values with this median absolute deviation would
    have. Rows without a key don't count.
    """
    by = [*keys]
    counted = readings.dropna(subset=by) if by else readings
    result = counted.groupBy(*by).agg(F.count("*").alias("readings"))
    for metric in metrics:
        middle = exact_quantile(readings, metric, 0.5, by, scratch).withColumnRenamed("quantile", "middle")
        rows = readings.select(*by, F.col(metric).alias("x"))
        if by:
            placed = attach_by_key(rows, middle, by, "n", stored=True)
        else:
            placed = _beside(rows, middle.select("middle"), by)
        off = placed.select(*by, F.abs(F.col("x") - F.col("middle")).alias("off"))
        spread = exact_quantile(off, "off", 0.5, by, scratch)
        name = short(metric)
        result = _beside(result, middle.select(*by, F.col("middle").alias(f"median_{name}")), by)
        result = _beside(result, spread.select(*by, F.col("quantile").alias(f"mad_{name}")), by)
    usable = {}
    for metric in metrics:
        usable[mean_name(metric)] = usable_mean(F.col(f"median_{short(metric)}"))
        usable[std_name(metric)] = usable_std(F.col(f"mad_{short(metric)}") * NORMAL_SCALE)
    return scratch.table(result.withColumns(usable), scratch.fresh("robust"))
