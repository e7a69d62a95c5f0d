"""A profile that adds up: sketches per window, merged over any span of time.

An exact distinct count or quantile of a week cannot be had from those of its hours.
Sketches can: they are small whatever the number of readings, and merging them gives what
one sketch of all readings would have given, within the same error.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.functions import bucket_start
from tidegauge.schema import METRICS, ROLLUP_SECONDS, TIME

#: Distinct counts use 2 ** these many registers; one standard error is 1.04 / sqrt of that.
REGISTER_BITS = 12
DISTINCT_ERROR = 3 * 1.04 / 2 ** (REGISTER_BITS / 2)
#: Quantile sketches keep about this many values a level; ranks are off by this share at most
#: in 99 of 100 cases.
QUANTILE_K = 400
RANK_ERROR = 0.0068

QUANTILES = (0.5, 0.95, 0.99)


def sketch_windows(
    readings: DataFrame, seconds: int = ROLLUP_SECONDS, metrics: tuple[str, ...] = METRICS
) -> DataFrame:
    """Sketches of each metric per window: one row per window and metric.

    ``window_start, metric, non_null, min_value, max_value, distinct, quantiles``, to be
    stored and merged. Readings without a time are in the window with a NULL start.
    """
    long = readings.select(
        bucket_start(F.col(TIME), seconds).alias("window_start"),
        F.inline(F.array(*(F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in metrics))),
    )
    return long.groupBy("window_start", "metric").agg(
        F.count("value").alias("non_null"),
        F.min("value").alias("min_value"),
        F.max("value").alias("max_value"),
        # equal doubles have equal hashes, also 0.0 and -0.0
        F.hll_sketch_agg(F.when(F.col("value").isNotNull(), F.xxhash64(F.col("value") + 0.0)), REGISTER_BITS).alias("distinct"),
        F.kll_sketch_agg_double("value", QUANTILE_K).alias("quantiles"),
    )


def merge_sketches(sketches: DataFrame, keys: tuple[str, ...] = ("metric",)) -> DataFrame:
    """One row of sketches per key from those of any windows."""
    return sketches.groupBy(*keys).agg(
        F.sum("non_null").alias("non_null"),
        F.min("min_value").alias("min_value"),
        F.max("max_value").alias("max_value"),
        F.hll_union_agg("distinct").alias("distinct"),
        F.kll_merge_agg_double("quantiles").alias("quantiles"),
    )


def profile_of(
    sketches: DataFrame, keys: tuple[str, ...] = ("metric",), quantiles: tuple[float, ...] = QUANTILES
) -> DataFrame:
    """What merged sketches say: counts and extremes exactly, the rest within the errors.

    ``distinct_values`` is off by ``DISTINCT_ERROR`` at most in 997 of 1000 cases; each of
    ``q50`` and so on has a rank that is off by ``RANK_ERROR``, NULL without values.
    """
    merged = merge_sketches(sketches, keys)
    at = F.array(*(F.lit(float(q)) for q in quantiles))
    found = F.when(F.col("non_null") > 0, F.kll_sketch_get_quantile_double("quantiles", at))
    return merged.withColumn("_found", found).select(
        *keys,
        "non_null",
        "min_value",
        "max_value",
        F.hll_sketch_estimate("distinct").alias("distinct_values"),
        *(F.col("_found")[i].alias(f"q{100 * q:g}".replace(".", "_")) for i, q in enumerate(quantiles)),
    )
