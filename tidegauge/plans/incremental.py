"""Silver and gold tables that follow new loads of the raw layer, day by day.

A refresh computes only the days on which something can have changed:

* New readings change the averages of their windows, so all rows of their days are joined
  anew. A window that ends at midnight is the window before for readings exactly on
  midnight, so then the next day is joined anew too.
* The baseline is merged from one row per day. It moves with every load, but a flag only
  changes where a value lies between the old and the new limit. Days with such values,
  which a scan with these ranges pushed down finds, are flagged and rolled up anew.

Each table is partitioned by day and whole days are replaced. A ledger names the loads
that are in; it is written last, so a refresh that fails is simply run again.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.functions import bucket_start, shift_seconds
from tidegauge.operators.anomalies import anomaly_log, flag_anomalies
from tidegauge.operators.baseline import baseline_of, mean_name, std_name
from tidegauge.operators.cleaning import clean_readings
from tidegauge.operators.rollups import anomaly_rate_of, device_stats_of, summarize_flagged
from tidegauge.operators.windows import attach_window_averages, check_closed, tumbling_averages
from tidegauge.plans.layers import day_of
from tidegauge.schema import (
    AVERAGE_SECONDS,
    CORRUPT,
    DECIMALS,
    LOAD,
    QUARANTINED,
    SCORED_METRICS,
    SIGMAS,
    SILVER_COLUMNS,
    TIME,
    window_average,
)
from tidegauge.sinks.tables import overwrite_table, write_days, write_run
from tidegauge.sources.files import load_table, load_table_if_present
from tidegauge.sources.workspace import Scratch, ending_scratch

DAY = "event_day"
DAY_MICROS = 86_400_000_000


@dataclass(frozen=True)
class FollowingTables:
    """Names of the tables that follow the raw layer."""

    clean: str
    silver: str
    flagged: str
    device_stats: str
    anomaly_rate: str
    anomaly_log: str
    parts: str
    baseline: str
    ledger: str

    @classmethod
    def named(cls, prefix: str) -> FollowingTables:
        return cls(*(f"{prefix}_{field.name}" for field in fields(cls)))


def pending_loads(spark: SparkSession, bronze: DataFrame, ledger: str) -> list[str]:
    """Loads of the raw layer that the ledger doesn't name; only partitions are listed."""
    loads = bronze.select(F.col(LOAD).cast("string").alias(LOAD)).distinct()
    known = load_table_if_present(spark, ledger)
    if known is not None:
        loads = loads.join(known.select(LOAD), LOAD, "left_anti")
    return sorted(row[0] for row in loads.collect())


def follow_loads(
    spark: SparkSession,
    bronze: DataFrame,
    tables: FollowingTables,
    run_id: str,
    *,
    closed: str = "both",
    digits: int | None = DECIMALS,
) -> list[str]:
    """Bring all tables up to the loads of ``bronze``; returns the days written anew.

    Equal to ``refresh_silver`` and ``refresh_gold`` over the same readings, but for the
    last bits of averages. Without new loads nothing is written.
    """
    check_closed(closed)
    loads = pending_loads(spark, bronze, tables.ledger)
    if not loads:
        return []
    scratch = Scratch(spark, "follow")
    try:
        with ending_scratch():
            fresh = scratch.table(_fresh_readings(bronze, loads), "fresh")
            _write_loads(fresh, tables.clean)
            days = _touched_days(fresh)
            _join_days(spark, tables, days, closed, scratch)
            changed = _flag_days(spark, tables, days, run_id, digits, scratch)
            ledger = fresh.groupBy(LOAD).agg(F.count("*").alias("readings"))
            named = spark.createDataFrame([(load,) for load in loads], f"{LOAD} string")
            write_run(named.join(ledger, LOAD, "left").na.fill(0), tables.ledger, run_id)
    finally:
        scratch.close()
    return changed


def _fresh_readings(bronze: DataFrame, loads: list[str]) -> DataFrame:
    raw = bronze.where(F.col(LOAD).cast("string").isin(loads)).withColumn(LOAD, F.col(LOAD).cast("string"))
    if QUARANTINED in raw.columns:
        raw = raw.where(~F.col(QUARANTINED).cast("boolean")).drop(QUARANTINED, CORRUPT)
    return clean_readings(raw, (LOAD,)).withColumn(DAY, day_of(TIME))


def _write_loads(fresh: DataFrame, name: str) -> None:
    """Add the readings of new loads; the same load again replaces its own."""
    spark = fresh.sparkSession
    by_day = fresh.hint("rebalance", DAY, LOAD)
    if not spark.catalog.tableExists(name):
        by_day.write.partitionBy(DAY, LOAD).saveAsTable(name, format="parquet")
        return
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        by_day.select(*spark.read.table(name).columns).write.mode("overwrite").insertInto(name)
    finally:
        spark.conf.set(mode, before)


def _touched_days(fresh: DataFrame) -> dict[str, str]:
    """Days whose joined rows change, each with the day before it."""
    start = bucket_start(F.col(TIME), AVERAGE_SECONDS)
    windows = fresh.select(start.alias("window_start")).distinct()
    ends = F.array("window_start", shift_seconds(F.col("window_start"), AVERAGE_SECONDS))
    moments = windows.select(F.explode(ends).alias("moment"))
    day_begin = F.unix_micros("moment") - F.pmod(F.unix_micros("moment"), F.lit(DAY_MICROS))
    before = F.timestamp_micros(day_begin - 1)
    days = moments.select("moment", before.alias("before")).select(day_of("moment"), day_of("before").alias("before"))
    return {row[DAY]: row["before"] for row in days.distinct().collect()}


def _join_days(
    spark: SparkSession, tables: FollowingTables, days: dict[str, str], closed: str, scratch: Scratch
) -> None:
    clean = load_table(spark, tables.clean)
    own = clean.where(F.col(DAY).isin([*days])).drop(LOAD)
    # the last window of the day before reaches readings exactly on midnight
    others = sorted({*days.values()} - {*days})
    last_window = F.pmod(F.unix_micros(TIME), F.lit(DAY_MICROS)) >= DAY_MICROS - AVERAGE_SECONDS * 1_000_000
    before = clean.where(F.col(DAY).isin(others) & last_window).drop(LOAD)
    windows = tumbling_averages(own.unionByName(before))
    silver = attach_window_averages(own, windows, closed=closed).select(*SILVER_COLUMNS, DAY)
    write_days(scratch.table(silver, "silver").hint("rebalance", DAY), tables.silver, [*days])
    parts = load_table(spark, tables.silver).where(F.col(DAY).isin([*days])).groupBy(DAY)
    write_days(parts.agg(*_parts_of_day()), tables.parts, [*days])


def _parts_of_day() -> list[Column]:
    """What the baseline of any days is merged from, in the form of a window summary."""
    columns = []
    for metric in SCORED_METRICS:
        columns += [
            F.avg(metric).alias(window_average(metric)),
            F.count(metric).alias(f"n_{metric}"),
            F.var_pop(metric).alias(f"var_{metric}"),
            F.min(metric).alias(f"min_{metric}"),
            F.max(metric).alias(f"max_{metric}"),
        ]
    return columns


def _flag_days(
    spark: SparkSession,
    tables: FollowingTables,
    days: dict[str, str],
    run_id: str,
    digits: int | None,
    scratch: Scratch,
) -> list[str]:
    silver = load_table(spark, tables.silver)
    stats = scratch.table(baseline_of(load_table(spark, tables.parts), closed="left"), "stats")
    old = load_table_if_present(spark, tables.baseline)
    crossed = _crossing(old.first(), stats.first()) if old is not None else F.lit(True)
    moved = silver.where(crossed).select(DAY).distinct()
    changed = sorted({*days, *(row[0] for row in moved.collect())})

    flagged = flag_anomalies(silver.where(F.col(DAY).isin(changed)), stats)
    write_days(flagged.hint("rebalance", DAY), tables.flagged, changed)
    flagged = load_table(spark, tables.flagged).where(F.col(DAY).isin(changed))
    summary = scratch.table(summarize_flagged(flagged), "rollup")
    hourly, rate = device_stats_of(summary, digits=digits), anomaly_rate_of(summary)
    write_days(hourly.select("*", day_of("window_start")), tables.device_stats, changed)
    write_days(rate.select("*", day_of("window_start")), tables.anomaly_rate, changed)
    log = anomaly_log(flagged).withColumn("run_id", F.lit(run_id))
    write_days(log.select("*", day_of("detected_at")), tables.anomaly_log, changed)
    overwrite_table(stats, tables.baseline)
    return changed


def _crossing(old, new) -> Column:
    """Values between the old and the new limit of a metric, either limit included."""
    found = F.lit(False)
    for metric in SCORED_METRICS:
        for side in (-1, 1):
            limits = [row[mean_name(metric)] + side * SIGMAS * row[std_name(metric)] for row in (old, new)]
            if any(map(math.isnan, limits)):
                return F.lit(True)
            if limits[0] != limits[1]:
                found |= F.col(metric).between(min(limits), max(limits))
    return found
