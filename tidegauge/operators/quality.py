"""Data-quality checks. Each check is one row: check, target, bad_rows, status."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.schema import METRICS, OVERALL_FLAG, SCORED_METRICS, SENSOR_LIMITS, flag
from tidegauge.sources.workspace import materialize

PASSED, FAILED, ERROR, SKIPPED = "passed", "failed", "error", "skipped"
RESULT_SCHEMA = "check string, target string, bad_rows bigint, status string"


@dataclass(frozen=True)
class Check:
    """A check that one aggregate over the rows can answer, or the schema alone."""

    name: str
    columns: tuple[str, ...]
    bad_rows: Column | int


def not_empty() -> Check:
    """At least one row; an empty table counts as one fault."""
    return Check("row_count", (), (F.count("*") == 0).cast("bigint"))


def has_columns(df: DataFrame, expected: Iterable[str]) -> Check:
    """All expected columns are there; counts the missing ones, from the schema."""
    missing = [name for name in expected if name not in df.columns]
    return Check("schema_columns", (), len(missing))


def flags_are_binary(
    flags: tuple[str, ...] = (*(flag(m) for m in SCORED_METRICS), OVERALL_FLAG),
) -> Check:
    """Flags are 0 or 1; a missing flag is not counted."""
    bad = reduce(or_, (~F.col(name).isin(0, 1) for name in flags))
    return Check("anomaly_flags", flags, F.count_if(bad))


def within_limits(limits: Mapping[str, tuple[float, float]] = SENSOR_LIMITS) -> list[Check]:
    """Values inside the physical limits of the sensor; NULL is not counted."""
    return [
        Check(f"{name}_range", (name,), F.count_if(~F.col(name).between(low, high)))
        for name, (low, high) in limits.items()
    ]


def run_checks(df: DataFrame, target: str, checks: Iterable[Check]) -> DataFrame:
    """Answer all checks in a single scan of the columns they need.

    A check whose column is missing reports an error, the others still run. What the
    schema answers needs no scan. Checks may have the same name.
    """
    aggregates, results = [], []
    for i, check in enumerate(checks):
        if not set(check.columns) <= set(df.columns):
            value = F.lit(None).cast("bigint")
        elif isinstance(check.bad_rows, int):
            value = F.lit(check.bad_rows).cast("bigint")
        else:
            aggregates.append(F.coalesce(check.bad_rows, F.lit(0)).alias(f"check_{i}"))
            value = F.col(f"check_{i}")
        results.append(F.struct(F.lit(check.name).alias("check"), value.alias("bad_rows")))
    counts = df.agg(*aggregates) if aggregates else df.sparkSession.range(1)
    return _result(counts.select(F.inline(F.array(*results))), target)


def _result(counts: DataFrame, target: str) -> DataFrame:
    bad = F.col("bad_rows")
    status = F.when(bad.isNull(), ERROR).when(bad == 0, PASSED).otherwise(FAILED)
    return counts.select("check", F.lit(target).alias("target"), "bad_rows", status.alias("status"))


def unique_windows(
    rollup: DataFrame, target: str, keys: tuple[str, ...] = ("window_start",)
) -> DataFrame:
    """No two rows for one window; counts the windows that have more."""
    repeated = rollup.groupBy(*keys).agg(F.count("*").alias("rows")).filter(F.col("rows") > 1)
    return _result(
        repeated.agg(F.count("*").alias("bad_rows")).select(
            F.lit("unique_window").alias("check"), "bad_rows"
        ),
        target,
    )


def no_duplicate_rows(df: DataFrame, target: str) -> DataFrame:
    """No two equal rows; counts the rows beyond the first of each kind.

    The rows are written once. Only a 64-bit hash per row is grouped first. Rows whose
    hash occurs once have no copy; the others, found by an ordinary join whose way Spark
    chooses by bytes, are compared in full, so a hash collision cannot count as a copy.
    """
    df = materialize(df, "checked")
    row_hash = F.xxhash64(*df.columns)
    repeated = materialize(
        df.groupBy(row_hash.alias("row_hash"))
        .agg(F.count("*").alias("rows"))
        .filter(F.col("rows") > 1)
        .select("row_hash"),
        "repeated",
    )
    suspects = (
        df.withColumn("row_hash", row_hash).join(repeated, "row_hash", "left_semi").drop("row_hash")
    )
    copies = suspects.groupBy(*df.columns).agg((F.count("*") - 1).alias("copies"))
    return _result(
        copies.agg(F.coalesce(F.sum("copies"), F.lit(0)).cast("bigint").alias("bad_rows")).select(
            F.lit("duplicate_rows").alias("check"), "bad_rows"
        ),
        target,
    )


def skipped(spark: SparkSession, target: str, names: Iterable[str]) -> DataFrame:
    """Results for a table that is not there."""
    return spark.createDataFrame([(name, target, None, SKIPPED) for name in names], RESULT_SCHEMA)


def summarize_checks(results: DataFrame) -> DataFrame:
    """Number of checks run, passed, failed, in error and skipped."""
    return results.agg(
        F.count("*").alias("run"),
        *(
            F.count_if(F.col("status") == status).alias(name)
            for name, status in (
                ("passed", PASSED),
                ("failed", FAILED),
                ("errors", ERROR),
                ("skipped", SKIPPED),
            )
        ),
    )


def profile(
    df: DataFrame, metrics: tuple[str, ...] = METRICS, *, exact: bool = True
) -> DataFrame:
    """Row count, minimum, maximum and number of distinct values per column.

    The exact way groups on (column, value), so a frequent value is folded before
    the shuffle and no reducer sees all values of a column. ``exact=False``
    takes a sketch instead and shuffles next to nothing.
    """
    if not exact:
        cells = (
            F.struct(
                F.lit(metric).alias("metric"),
                F.col(f"n_{metric}").alias("non_null"),
                F.col(f"min_{metric}").alias("min_value"),
                F.col(f"max_{metric}").alias("max_value"),
                F.col(f"distinct_{metric}").alias("distinct_values"),
            )
            for metric in metrics
        )
        wide = df.agg(
            *(
                column
                for metric in metrics
                for column in (
                    F.count(metric).alias(f"n_{metric}"),
                    F.min(metric).alias(f"min_{metric}"),
                    F.max(metric).alias(f"max_{metric}"),
                    F.approx_count_distinct(metric).alias(f"distinct_{metric}"),
                )
            )
        )
        return wide.select(F.inline(F.array(*cells)))
    long = df.unpivot([], list(metrics), "metric", "value")
    values = long.groupBy("metric", "value").agg(F.count("value").alias("rows"))
    return values.groupBy("metric").agg(
        F.sum("rows").alias("non_null"),
        F.min("value").alias("min_value"),
        F.max("value").alias("max_value"),
        F.count("value").alias("distinct_values"),
    )
