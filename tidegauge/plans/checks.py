"""The data-quality report over the gold results."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from tidegauge.operators import quality
from tidegauge.schema import FLAGGED_COLUMNS, ROLLUP_COLUMNS
from tidegauge.sources.files import load_table_if_present

ROW_CHECKS = (
    "row_count",
    "schema_columns",
    "anomaly_flags",
    "temperature_range",
    "humidity_range",
    "duplicate_rows",
)
ROLLUP_CHECKS = ("row_count", "schema_columns", "unique_window", "duplicate_rows")


def check_flagged(flagged: DataFrame, target: str = "flagged") -> DataFrame:
    """Checks on flagged readings: all but the duplicates in a single scan."""
    checks = [
        quality.not_empty(),
        quality.has_columns(flagged, FLAGGED_COLUMNS),
        quality.flags_are_binary(),
        *quality.within_limits(),
    ]
    return quality.run_checks(flagged, target, checks).unionByName(
        quality.no_duplicate_rows(flagged, target)
    )


def check_rollup(rollup: DataFrame, target: str = "device_stats") -> DataFrame:
    """Checks on the hourly rollup."""
    checks = [quality.not_empty(), quality.has_columns(rollup, ROLLUP_COLUMNS)]
    return (
        quality.run_checks(rollup, target, checks)
        .unionByName(quality.unique_windows(rollup, target))
        .unionByName(quality.no_duplicate_rows(rollup, target))
    )


def check_tables(spark: SparkSession, flagged_table: str, rollup_table: str) -> DataFrame:
    """The same on stored tables; the checks on a missing table are skipped."""

    def check(name: str, run: Callable[[DataFrame, str], DataFrame], names: tuple) -> DataFrame:
        table = load_table_if_present(spark, name)
        return quality.skipped(spark, name, names) if table is None else run(table, name)

    return reduce(
        DataFrame.unionByName,
        (
            check(flagged_table, check_flagged, ROW_CHECKS),
            check(rollup_table, check_rollup, ROLLUP_CHECKS),
        ),
    )
