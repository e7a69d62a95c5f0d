"""The layers put together: raw -> clean -> silver -> flagged -> gold outputs."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.operators.anomalies import anomaly_log, flag_anomalies
from tidegauge.operators.baseline import baseline, baseline_of, summarize_windows
from tidegauge.operators.cleaning import clean_readings, is_valid, to_typed
from tidegauge.operators.metrics import metric_records
from tidegauge.operators.rollups import (
    anomaly_rate_of,
    device_stats_of,
    summarize_flagged,
)
from tidegauge.operators.windows import attach_stored_windows, check_closed, with_previous
from tidegauge.functions import utc_wall_clock
from tidegauge.schema import (
    DECIMALS,
    METRICS,
    QUARANTINED,
    SILVER_COLUMNS,
    TIME,
    window_average,
)
from tidegauge.sinks.tables import overwrite_table, write_days
from tidegauge.sources.files import bronze_records, load_table
from tidegauge.sources.workspace import Scratch, materialize

WINDOW_AVERAGES = [window_average(metric) for metric in METRICS]


@dataclass(frozen=True)
class Readings:
    """Clean readings with what follows from them.

    Two passes over the readings give every result: the first makes the window
    summary, which is small and written once, the second joins and flags.
    """

    clean: DataFrame
    closed: str = "both"
    scratch: Scratch | None = None

    @classmethod
    def from_raw(
        cls,
        raw: DataFrame,
        keep: tuple[str, ...] = (),
        closed: str = "both",
        scratch: Scratch | None = None,
    ) -> Readings:
        """``scratch`` takes the intermediate tables, and whoever made it closes it."""
        check_closed(closed)
        return cls(clean_readings(raw, keep), closed, scratch)

    def _stored(self, df: DataFrame, label: str) -> DataFrame:
        return self.scratch.table(df, label) if self.scratch else materialize(df, label)

    @cached_property
    def window_summary(self) -> DataFrame:
        """One row per window; see ``summarize_windows``."""
        summary = self._stored(summarize_windows(self.clean), "summary")
        if self.closed == "left":
            return summary
        return self._stored(with_previous(summary, WINDOW_AVERAGES), "windows")

    @cached_property
    def baseline(self) -> DataFrame:
        return self._stored(baseline_of(self.window_summary, closed=self.closed), "baseline")

    def _attach(self, columns: list[str]) -> DataFrame:
        windows = self.window_summary.filter(F.col("window_start").isNotNull())
        return attach_stored_windows(
            self.clean, windows, closed=self.closed, columns=tuple(columns)
        )

    @cached_property
    def silver(self) -> DataFrame:
        """Clean readings with the averages of their windows."""
        return self._attach(WINDOW_AVERAGES)

    @cached_property
    def repeated(self) -> DataFrame:
        """The rows of ``silver`` without the averages, for results that need none."""
        return self._attach([])

    @cached_property
    def scored(self) -> DataFrame:
        """``repeated`` with anomaly flags."""
        return flag_anomalies(self.repeated, self.baseline)

    @cached_property
    def flagged(self) -> DataFrame:
        """``silver`` with anomaly flags."""
        return flag_anomalies(self.silver, self.baseline)


def layer_counts(raw: DataFrame, readings: Readings) -> DataFrame:
    """Rows per layer; raw and valid rows are counted in the same scan."""
    typed = to_typed(raw)
    counted = typed.agg(F.count("*").alias("bronze"), F.count_if(is_valid()).alias("valid"))
    silver = readings.repeated.agg(F.count("*").alias("silver"))
    layers = F.array(
        F.struct(F.lit("bronze").alias("layer"), F.col("bronze").alias("rows")),
        F.struct(F.lit("valid").alias("layer"), F.col("valid").alias("rows")),
    )
    return counted.select(F.inline(layers)).unionByName(
        silver.select(F.lit("silver").alias("layer"), F.col("silver").alias("rows"))
    )


def refresh_silver(
    spark: SparkSession,
    bronze_table: str,
    silver_table: str,
    *,
    closed: str = "both",
    partition_by_date: bool = False,
) -> None:
    """Rebuild the silver table from the bronze table, without its quarantine.

    ``partition_by_date`` adds an ``event_date`` (UTC) partition column, with which
    later reads of a time range skip the other days. Rows are then rebalanced by
    day at run time, so a day becomes few files, and a huge day many tasks.
    """
    raw = load_table(spark, bronze_table)
    if QUARANTINED in raw.columns:
        raw = bronze_records(raw)
    scratch = Scratch(spark, "silver")
    try:
        # parsed once; both passes read typed columns
        clean = scratch.table(clean_readings(raw), "clean")
        check_closed(closed)
        silver = Readings(clean, closed, scratch).silver.select(*SILVER_COLUMNS)
        if partition_by_date:
            silver = silver.withColumn("event_date", F.to_date(utc_wall_clock(F.col(TIME))))
            silver = silver.hint("rebalance", "event_date")
        overwrite_table(
            silver, silver_table, partition_by=("event_date",) if partition_by_date else ()
        )
    finally:
        scratch.close()


@dataclass(frozen=True)
class GoldTables:
    """Names of the tables one gold run writes; the last three only where given."""

    device_stats: str
    anomaly_rate: str
    anomaly_log: str
    metrics: str | None = None
    flagged: str | None = None
    baseline: str | None = None


def refresh_gold(
    spark: SparkSession,
    silver_table: str,
    tables: GoldTables,
    run_id: str,
    now: Column | dt.datetime | None = None,
) -> None:
    """Rebuild the gold tables from the silver table.

    Silver is read twice: for the baseline, with two columns, and to write the flagged
    readings. The rollups and metrics come from one summary of those, the log from a scan
    of them with the anomaly flag pushed down. The log holds each anomaly once, by day:
    the days of this run replace what the log had for them, with ``run_id`` beside.
    """
    scratch = Scratch(spark, "gold")
    try:
        silver = load_table(spark, silver_table)
        stats = scratch.table(baseline(silver), "baseline")
        flagged = flag_anomalies(silver, stats)
        if tables.flagged:
            overwrite_table(flagged, tables.flagged)
            flagged = load_table(spark, tables.flagged)
        else:
            flagged = scratch.table(flagged, "flagged")
        summary = scratch.table(summarize_flagged(flagged), "rollup")
        hourly = device_stats_of(summary, digits=DECIMALS)
        rate = anomaly_rate_of(summary)
        overwrite_table(hourly, tables.device_stats)
        overwrite_table(rate, tables.anomaly_rate)
        days = [row[0] for row in summary.select(day_of("window_start")).distinct().collect()]
        log = anomaly_log(flagged).withColumn("run_id", F.lit(run_id))
        write_days(log.select("*", day_of("detected_at")), tables.anomaly_log, [*days, NO_DAY])
        if tables.baseline:
            overwrite_table(stats, tables.baseline)
        if tables.metrics:
            overwrite_table(metric_records(hourly, rate, now), tables.metrics)
    finally:
        scratch.close()


#: The log's day of readings without a time.
NO_DAY = "none"


def day_of(time: str) -> Column:
    """The UTC day of a time as a partition value."""
    day = F.to_date(utc_wall_clock(F.col(time))).cast("string")
    return F.coalesce(day, F.lit(NO_DAY)).alias("event_day")
