"""The same results by the plain formulation, for timing and as brute force.

Interval condition as the join, statistics fetched to the driver, one job per
correlation. ``python -m verification.plain`` times both side by side.
"""

from __future__ import annotations

import json
import os
import sys
import time
from collections.abc import Callable
from itertools import product

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.functions import deviates
from tidegauge.operators import rollups
from tidegauge.operators.windows import tumbling_averages
from tidegauge.plans.layers import WINDOW_AVERAGES, Readings
from tidegauge.schema import METRICS, OVERALL_FLAG
from tidegauge.sources.event_readings import readings_from_events


def interval_join(readings: DataFrame) -> DataFrame:
    windows = tumbling_averages(readings)
    inside = F.col("event_time").between(F.col("window_start"), F.col("window_end"))
    return readings.join(windows, inside, "left").select(*readings.columns, *WINDOW_AVERAGES)


def device_stats(readings: DataFrame) -> DataFrame:
    silver = interval_join(readings)
    row = silver.agg(
        F.avg("temperature"), F.stddev("temperature"), F.avg("humidity"), F.stddev("humidity")
    ).first()
    hot = deviates(F.col("temperature"), F.lit(row[0]), F.lit(row[1]))
    wet = deviates(F.col("humidity"), F.lit(row[2]), F.lit(row[3]))
    return rollups.device_stats(silver.withColumn(OVERALL_FLAG, F.greatest(hot, wet)))


def correlations(readings: DataFrame) -> dict[tuple[str, str], float]:
    silver = interval_join(readings)
    return {pair: silver.corr(*pair) for pair in product(METRICS, METRICS)}


def _noop(frame: DataFrame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    raw = readings_from_events(spark.read.parquet(f"{sf_dir}/events.parquet"))
    cases: dict[str, Callable[[Readings], None]] = {
        "silver_joined": lambda r: _noop(r.silver),
        "silver_joined_plain": lambda r: _noop(interval_join(r.clean)),
        "device_stats": lambda r: _noop(rollups.device_stats(r.scored)),
        "device_stats_plain": lambda r: _noop(device_stats(r.clean)),
        "corr_matrix": lambda r: _noop(rollups.correlation_matrix(r.repeated)),
        "corr_matrix_plain": lambda r: correlations(r.clean),
    }
    wanted = sys.argv[1:] or list(cases)
    _noop(Readings.from_raw(raw).scored)
    seconds = {}
    for name in wanted:
        begin = time.perf_counter()
        cases[name](Readings.from_raw(raw))
        seconds[name] = round(time.perf_counter() - begin, 2)
    print(json.dumps({"sf_dir": sf_dir, "cpus": int(cpus), "seconds": seconds}))


if __name__ == "__main__":
    main()
