"""Moving averages: one value per reading, and one per sliding window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.functions import bucket_start
from tidegauge.functions.times import MICROS
from tidegauge.operators.keyed_join import attach_by_key
from tidegauge.operators.parts import average_of_parts, part_names, sums_of
from tidegauge.schema import AVERAGE_SECONDS, METRICS, TIME, short


def rolling_name(metric: str) -> str:
    return f"rolling_{short(metric)}"


def moment_averages(
    readings: DataFrame,
    seconds: int = AVERAGE_SECONDS,
    metrics: tuple[str, ...] = METRICS,
    keys: tuple[str, ...] = (),
) -> DataFrame:
    """For each moment, the average over ``[moment - seconds, moment]``.

    Readings are first summed per moment, which folds any pile-up at one time. Time is
    cut into blocks as long as the width, so the moments that count are the end of the
    block before and the begin of the own block. One running sum forwards and one
    backwards over each block give both; the cost does not depend on the width, and
    nothing is ever subtracted. With times in whole seconds a window partition holds at
    most two rows per second of the width.
    """
    width = seconds * MICROS
    names = part_names(metrics)
    moments = (
        readings.filter(F.col(TIME).isNotNull())
        .groupBy(*keys, TIME)
        .agg(F.count("*").alias("readings"), *sums_of(metrics))
        .withColumn("at", F.unix_micros(TIME))
        .withColumn("block", F.col("at") - F.pmod("at", F.lit(width)))
    )
    # each moment also asks the block before for its sums from the moment less the width
    asks = moments.withColumns(
        {
            **{name: F.lit(None).cast(moments.schema[name].dataType) for name in names},
            "at": F.col("at") - width,
            "block": F.col("block") - width,
        }
    )
    rows = moments.withColumn("asks", F.lit(0)).unionByName(asks.withColumn("asks", F.lit(1)))
    block = Window.partitionBy(*keys, "block")
    running = (Window.unboundedPreceding, Window.currentRow)
    ahead = block.orderBy("at", "asks").rowsBetween(*running)
    back = block.orderBy(F.col("at").desc(), "asks").rowsBetween(*running)
    sums = rows.select(
        *keys,
        TIME,
        F.when(F.col("asks") == 0, F.col("readings")).alias("readings"),
        *(
            F.when(F.col("asks") == 1, F.sum(name).over(back)).otherwise(F.sum(name).over(ahead)).alias(name)
            for name in names
        ),
    )
    return sums.groupBy(*keys, TIME).agg(
        F.max("readings").alias("readings"),
        *(average_of_parts(metric).alias(rolling_name(metric)) for metric in metrics),
    )


def rolling_averages(
    readings: DataFrame,
    seconds: int = AVERAGE_SECONDS,
    metrics: tuple[str, ...] = METRICS,
    keys: tuple[str, ...] = (),
) -> DataFrame:
    """Add to each reading the averages of the ``seconds`` up to and including it.

    Readings without a time, or without a key, keep NULL averages.
    """
    lookup = moment_averages(readings, seconds, metrics, keys)
    return attach_by_key(readings, lookup, [*keys, TIME], "readings")


def sliding_averages(
    readings: DataFrame,
    seconds: int = AVERAGE_SECONDS,
    slide_seconds: int = 60,
    metrics: tuple[str, ...] = METRICS,
) -> DataFrame:
    """Averages per overlapping window.

    Readings are summed per slide first and only those sums are spread over the
    windows they belong to, so no reading is multiplied.
    """
    if seconds % slide_seconds:
        raise ValueError("the window must be a multiple of the slide")
    panes = (
        readings.filter(F.col(TIME).isNotNull())
        .groupBy(bucket_start(F.col(TIME), slide_seconds).alias("pane_start"))
        .agg(F.count("*").alias("readings"), *sums_of(metrics))
    )
    window = F.window("pane_start", f"{seconds} seconds", f"{slide_seconds} seconds")
    merged = panes.groupBy(window.alias("window")).agg(
        F.sum("readings").alias("readings"),
        *(average_of_parts(metric).alias(f"sliding_{short(metric)}") for metric in metrics),
    )
    return merged.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "readings",
        *(f"sliding_{short(metric)}" for metric in metrics),
    )
