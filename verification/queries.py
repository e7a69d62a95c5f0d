"""Every operator as a query over the given tables.

Each query takes all rows of ``events``, as raw sensor readings. Averages are
rounded by way of a decimal, the same as in the SQL they are checked against,
because the last bit of a float average depends on the order of addition.
"""

from __future__ import annotations

import dataclasses
import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.functions import clamp_timestamp, clean_names, clean_text, utc_wall_clock, wall_clock_epoch
from tidegauge.operators import asof, islands, quality, quantiles, rolling, rollups, sketches
from tidegauge.operators import metrics as metric_ops
from tidegauge.operators.anomalies import (
    anomaly_log,
    flag_anomalies_by_key,
    zscores,
)
from tidegauge.operators.baseline import baseline
from tidegauge.operators.cleaning import clean_readings, rejected, to_typed
from tidegauge.operators.windows import tumbling_averages
from tidegauge.plans.checks import check_flagged, check_rollup, check_tables
from tidegauge.plans.incremental import FollowingTables, follow_loads
from tidegauge.plans.ingest import convert_drop, load_bronze
from tidegauge.plans.layers import (
    GoldTables,
    Readings,
    layer_counts,
    refresh_gold,
    refresh_silver,
)
from tidegauge.schema import (
    CORRUPT,
    FLAGGED_COLUMNS,
    METRICS,
    RAW_COLUMNS,
    RAW_SCHEMA,
    TIME,
    rollup_average,
    short,
    window_average,
)
from tidegauge.sinks import retention
from tidegauge.sinks.tables import overwrite_table, to_json_lines, write_json_lines
from tidegauge.sources import files
from tidegauge.sources.event_readings import readings_from_events
from tidegauge.sources.workspace import Scratch, materialize, scratch_path
from tidegauge.streaming import bronze as bronze_stream_ops
from tidegauge.streaming import gold as gold_stream_ops
from tidegauge.streaming import rollup as rollup_ops
from tidegauge.streaming.progress import IngestListener, observed, read_progress

Query = Callable[[SparkSession, str], DataFrame]

NOW = dt.datetime(2024, 1, 22, tzinfo=dt.timezone.utc)
ALERT_THRESHOLD = 2
RETAIN_DAYS = 7
RATE_SPAN = (dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1))
IDENTITY = ("event_id", "user_id")
WINDOW_AVERAGES = tuple(window_average(metric) for metric in METRICS)
ROLLUP_AVERAGES = tuple(rollup_average(metric) for metric in METRICS)


# --- shared steps ---------------------------------------------------------------


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def raw_readings(spark: SparkSession, sf_dir: str, keep: tuple[str, ...] = ()) -> DataFrame:
    return readings_from_events(events(spark, sf_dir), keep)


def readings(spark: SparkSession, sf_dir: str, closed: str = "both") -> Readings:
    return Readings.from_raw(raw_readings(spark, sf_dir, IDENTITY), IDENTITY, closed)


def even(name: str, digits: int = 4) -> Column:
    """A double rounded as a decimal, so both engines round the same way."""
    exact = F.col(name).cast("decimal(28,8)")
    return F.round(exact, digits).cast("double").alias(name)


def shown(df: DataFrame, averages: tuple[str, ...] = (), digits: int = 4) -> DataFrame:
    """Timestamps as UTC wall clock, averages rounded."""
    columns = []
    for field in df.schema.fields:
        if field.name in averages:
            columns.append(even(field.name, digits))
        elif isinstance(field.dataType, T.TimestampType):
            columns.append(utc_wall_clock(F.col(field.name)).alias(field.name))
        else:
            columns.append(F.col(field.name))
    return df.select(*columns)


# --- sources ----------------------------------------------------------------------


def ingest_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the readings as CSV drops, read them back as text, then type them."""
    path = scratch_path(spark, "csv")
    raw_readings(spark, sf_dir).write.option("header", True).csv(path)
    return to_typed(files.read_csv_drop(spark, path)).drop(TIME)


def csv_to_json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV drops converted to JSON lines, which are then read and typed."""
    source, target = scratch_path(spark, "csv"), scratch_path(spark, "json")
    raw_readings(spark, sf_dir).write.option("header", True).csv(source)
    convert_drop(spark, source, target)
    return to_typed(files.good_records(files.read_json_lines(spark, target))).drop(TIME)


def _dropped_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "drops")
    dropped = readings_from_events(events(spark, sf_dir), ("ts",)).select(
        F.to_date("ts").alias("day"), *RAW_COLUMNS
    )
    dropped.write.partitionBy("day").option("header", True).csv(path)
    return files.read_csv_drop(spark, path, source=True)


def _mixed_drops(spark: SparkSession, sf_dir: str) -> str:
    """Drops with columns in another order, one more or one fewer, and an odd file."""
    root = scratch_path(spark, "mixed")
    raw = raw_readings(spark, sf_dir, ("event_id",))
    drops = (
        raw.select(*RAW_COLUMNS, "event_id"),
        raw.select("event_id", *reversed(RAW_COLUMNS), F.concat(F.lit("b,"), "event_id").alias("Battery")),
        raw.select("event_id", *RAW_COLUMNS[:-1]),
    )
    for i, drop in enumerate(drops):
        part = drop.where(F.pmod("event_id", F.lit(3)) == i).drop("event_id")
        part.write.option("header", True).csv(f"{root}/{i}")
    spark.range(0, 3, 1, 3).select(F.col("id").alias("x")).write.option("header", True).csv(f"{root}/odd")
    return root


def _with_battery(rows: DataFrame) -> DataFrame:
    battery = F.get_json_object("_extra", "$.Battery").alias("battery")
    return to_typed(rows.withColumn("battery", battery), ("battery",)).drop(TIME)


def ingest_csv_mixed_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All files of a drop with different headers."""
    return _with_battery(files.read_csv_drop(spark, _mixed_drops(spark, sf_dir), extras=True))


def csv_to_json_as_is(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1: files of any headers to JSON lines with all of their columns, an odd file's too."""
    target = scratch_path(spark, "json")
    convert_drop(spark, _mixed_drops(spark, sf_dir), target)
    schema = T.StructType([*RAW_SCHEMA, *(T.StructField(name, T.StringType()) for name in ("Battery", "x"))])
    lines = files.good_records(files.read_json_lines(spark, target, schema))
    renamed = lines.withColumnRenamed("Battery", "battery")
    return to_typed(renamed, ("battery", "x")).drop(TIME)


def stream_csv_mixed_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same drops as a stream; the odd file's lines are in the quarantine."""
    target, checkpoint = scratch_path(spark, "bronze"), scratch_path(spark, "commits")
    dropped = bronze_stream_ops.stream_files(spark, _mixed_drops(spark, sf_dir), max_files=5)
    once = bronze_stream_ops.ONCE
    _finish(bronze_stream_ops.start_csv_bronze(dropped, path=target, checkpoint=checkpoint, trigger=once))
    stored = spark.read.parquet(target)
    good = _with_battery(files.bronze_records(stored)).withColumn("odd_line", F.lit(None).cast("string"))
    odd = files.quarantined_lines(stored).select(F.col("line").alias("odd_line"))
    return good.unionByName(odd, allowMissingColumns=True)


def ingest_file_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: records per file of a drop, added up per day folder."""
    counts = files.count_rows_per_file(_dropped_by_day(spark, sf_dir))
    day = F.regexp_extract("source_file", r"day=(\d{4}-\d{2}-\d{2})/", 1)
    return counts.groupBy(day.alias("day")).agg(F.sum("records").alias("records"))


def ingest_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: records of the whole run, and whether any file was read."""
    summary = files.summarize_ingest(files.count_rows_per_file(_dropped_by_day(spark, sf_dir)))
    return summary.select((F.col("files") > 0).cast("int").alias("has_files"), "records")


def decode_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Object keys with blanks, braces and quotes, encoded and decoded; some are broken."""
    key = F.concat_ws("/", F.lit("drop a+b"), "event_type", "props", "event_id")
    broken = F.when(F.col("event_id") % 2 == 0, F.lit("%zz-100%")).otherwise(F.lit(""))
    encoded = events(spark, sf_dir).select(
        "event_id", F.concat(F.url_encode(key), broken).alias("encoded")
    )
    return encoded.select("event_id", files.decode_key(F.col("encoded")).alias("object_key"))


def bronze_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The readings as JSON lines, read with the fixed schema."""
    path = scratch_path(spark, "json")
    write_json_lines(raw_readings(spark, sf_dir), path)
    return to_typed(files.good_records(files.read_json_lines(spark, path))).drop(TIME)


def bronze_read_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines in dated sub-folders."""
    path = scratch_path(spark, "nested")
    raw = readings_from_events(events(spark, sf_dir), ("ts",))
    days = raw.select(F.to_date("ts").alias("day"), F.hour("ts").alias("hour"), *RAW_COLUMNS)
    record = F.to_json(F.struct(*RAW_COLUMNS), {"ignoreNullFields": "false"})
    lines = days.select("day", "hour", record.alias("value"))
    lines.repartition("day").write.partitionBy("day", "hour").text(path)
    return to_typed(files.good_records(files.read_json_lines(spark, path))).drop(TIME)


def load_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One folder loaded into the raw layer twice holds each reading once."""
    source, target = scratch_path(spark, "lines"), scratch_path(spark, "bronze")
    write_json_lines(raw_readings(spark, sf_dir), source)
    for _ in range(2):
        load_bronze(spark, source, target)
    return to_typed(files.bronze_records(spark.read.parquet(target))).drop(TIME)


def _lines_with_broken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines in which every reading with an unreadable temperature is broken."""
    line = F.col("value")
    broken = line.contains('"Temperature":"bad"')
    return to_json_lines(raw_readings(spark, sf_dir)).select(
        F.when(broken, F.concat(F.lit("{"), line)).otherwise(line).alias("value")
    )


def _good_and_bad(stored: DataFrame) -> DataFrame:
    inside = r'"Light":"(\d+)"'
    good, bad = files.bronze_records(stored), files.quarantined_lines(stored)
    light = F.regexp_extract("line", inside, 1).cast("double").alias("light")
    return (
        to_typed(good)
        .drop(TIME)
        .withColumn("kind", F.lit("good"))
        .unionByName(bad.select(F.lit("bad").alias("kind"), light), allowMissingColumns=True)
    )


def bronze_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unreadable lines are set aside whole, the others kept."""
    source, target = scratch_path(spark, "lines"), scratch_path(spark, "bronze")
    _lines_with_broken(spark, sf_dir).write.text(source)
    files.write_bronze(files.read_json_lines(spark, source), target, "only")
    return _good_and_bad(spark.read.parquet(target))


def ndjson_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1: one JSON object per reading, parsed again; counts the explicit nulls."""
    lines = to_json_lines(raw_readings(spark, sf_dir))
    parsed = lines.select(
        F.from_json("value", RAW_SCHEMA).alias("r"),
        F.regexp_count("value", F.lit(":null")).alias("nulls"),
    )
    typed = to_typed(parsed.select("r.*", "nulls"), ("nulls",))
    return typed.drop(TIME)


def clean_column_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Awkward names cleaned, on columns and on text values."""
    awkward = events(spark, sf_dir).select(
        F.col("event_id").alias(" event id\n"),
        F.col("user_id").alias("user-id"),
        F.col("event_type").alias("event(type)"),
        F.col("value").alias("{val;ue=}"),
        clean_text(F.concat(F.lit("\t "), "props", F.lit(" (x-y);="))).alias("clean\ttext"),
    )
    return clean_names(awkward)


# --- silver -----------------------------------------------------------------------


def silver_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(clean_readings(raw_readings(spark, sf_dir, ("event_id",)), ("event_id",)))


def silver_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = to_typed(raw_readings(spark, sf_dir, ("event_id",)), ("event_id",))
    return rejected(typed).select("event_id", "temperature", "reject_reason")


def event_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = to_typed(raw_readings(spark, sf_dir, ("event_id",)), ("event_id",))
    return shown(typed.select("event_id", "time", TIME))


def tumbling_5min(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = clean_readings(raw_readings(spark, sf_dir))
    return shown(tumbling_averages(clean), WINDOW_AVERAGES)


def silver_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = readings(spark, sf_dir).silver.drop("user_id")
    return shown(silver, WINDOW_AVERAGES)


def silver_joined_left_closed(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = readings(spark, sf_dir, closed="left").silver.drop("user_id")
    return shown(silver, WINDOW_AVERAGES)


def rolling_5min(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = readings(spark, sf_dir).clean
    averages = tuple(rolling.rolling_name(metric) for metric in METRICS)
    return shown(
        rolling.rolling_averages(clean).select("event_id", TIME, *averages), averages
    )


def rolling_day_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = readings(spark, sf_dir).clean
    moving = rolling.rolling_averages(clean, seconds=24 * 3600, keys=("user_id",))
    averages = tuple(rolling.rolling_name(metric) for metric in METRICS)
    return shown(moving.select("event_id", "user_id", *averages), averages)


def sliding_5min(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = clean_readings(raw_readings(spark, sf_dir))
    averages = tuple(f"sliding_{short(metric)}" for metric in METRICS)
    return shown(rolling.sliding_averages(clean), averages)


def key_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings in time order per device, each with the time of the one before it."""
    clean = readings(spark, sf_dir).clean
    ordered = metric_ops.in_key_order(clean, ["user_id"])
    place = F.monotonically_increasing_id().alias("place")
    stored = materialize(ordered.select("user_id", TIME, place), "ordered")
    before = F.lag(TIME).over(Window.partitionBy("user_id").orderBy("place"))
    return shown(stored.select("user_id", TIME, before.alias("previous_time")))


# --- gold -------------------------------------------------------------------------


def global_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = baseline(readings(spark, sf_dir).repeated)
    return shown(stats, tuple(stats.columns))


def global_baseline_from_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same numbers without reading the joined rows."""
    stats = readings(spark, sf_dir).baseline
    return shown(stats, tuple(stats.columns))


def anomaly_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = readings(spark, sf_dir).flagged.select("event_id", *FLAGGED_COLUMNS)
    return shown(flagged, WINDOW_AVERAGES)


def anomaly_flags_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = flag_anomalies_by_key(readings(spark, sf_dir).repeated, ["user_id"])
    return flagged.select(
        "event_id", "user_id", "temp_anomaly", "humidity_anomaly", "overall_anomaly"
    )


def zscore_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = readings(spark, sf_dir)
    scored = zscores(source.repeated, source.baseline)
    return shown(scored.select("event_id", "z_temp", "z_humidity"), ("z_temp", "z_humidity"))


def device_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = rollups.device_stats(readings(spark, sf_dir).scored, digits=None)
    return shown(stats, ROLLUP_AVERAGES)


def device_stats_from_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = rollups.summarize_flagged(readings(spark, sf_dir).scored)
    return shown(rollups.device_stats_of(summary, digits=None), ROLLUP_AVERAGES)


def log_of_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(anomaly_log(readings(spark, sf_dir).scored))


def _rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.anomaly_rate(readings(spark, sf_dir).scored)


def anomaly_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(_rate(spark, sf_dir))


def anomaly_rate_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(rollups.fill_gaps(_rate(spark, sf_dir), *RATE_SPAN))


def alert_spikes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(metric_ops.alert_spikes(_rate(spark, sf_dir), ALERT_THRESHOLD))


def temp_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = clean_readings(raw_readings(spark, sf_dir))
    return shown(rollups.temperature_trend(clean), ("avg_temp",))


def corr_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    matrix = rollups.correlation_matrix(readings(spark, sf_dir).repeated)
    return shown(matrix, ("corr",), digits=6)


def first_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = rollups.device_stats(readings(spark, sf_dir).scored, digits=None, ordered=False)
    first = rollups.first_windows(stats, ["avg_temp", "avg_humidity", "total_anomalies"])
    return shown(first, ROLLUP_AVERAGES)


def first_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(rollups.first_windows(_rate(spark, sf_dir), ["anomaly_count"]))


def latest_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(rollups.latest_anomalies(anomaly_log(readings(spark, sf_dir).scored)))


def plot_feed_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = rollups.device_stats(readings(spark, sf_dir).scored, digits=None)
    return shown(rollups.hourly_plot_feed(stats), ROLLUP_AVERAGES)


def plot_feed_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(rollups.rate_plot_feed(_rate(spark, sf_dir)))


def metric_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = materialize(rollups.summarize_flagged(readings(spark, sf_dir).scored), "rollup")
    records = metric_ops.metric_records(
        rollups.device_stats_of(summary), rollups.anomaly_rate_of(summary), NOW
    )
    return shown(records.withColumn("dimensions", F.to_json("dimensions")))


def clamped_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = to_typed(raw_readings(spark, sf_dir, ("event_id",)), ("event_id",))
    clamped = clamp_timestamp(F.col(TIME), metric_ops.as_instant(NOW))
    return shown(typed.select("event_id", clamped.alias("clamped")))


def retain(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = readings(spark, sf_dir).clean
    return shown(metric_ops.retain(clean, RETAIN_DAYS, NOW).select("event_id", TIME))


def counts_per_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = readings(spark, sf_dir)
    return layer_counts(raw_readings(spark, sf_dir), source)


# --- quality ----------------------------------------------------------------------


def dq_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = rollups.device_stats(readings(spark, sf_dir).scored, ordered=False)
    nothing = stats.where(F.col("total_anomalies") < 0)
    return quality.run_checks(stats, "device_stats", [quality.not_empty()]).unionByName(
        quality.run_checks(nothing, "nothing", [quality.not_empty()])
    )


def dq_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = readings(spark, sf_dir).flagged
    less = flagged.drop("light", "overall_anomaly")
    return quality.run_checks(
        flagged, "flagged", [quality.has_columns(flagged, FLAGGED_COLUMNS)]
    ).unionByName(quality.run_checks(less, "less", [quality.has_columns(less, FLAGGED_COLUMNS)]))


def dq_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = readings(spark, sf_dir).scored
    doubled = scored.withColumn("temp_anomaly", F.col("temp_anomaly") * 2)
    return quality.run_checks(scored, "flagged", [quality.flags_are_binary()]).unionByName(
        quality.run_checks(doubled, "doubled", [quality.flags_are_binary()])
    )


def dq_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = readings(spark, sf_dir).scored
    return quality.run_checks(scored, "flagged", quality.within_limits())


def dq_unique_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Once on the rollup, and once on windows that do repeat."""
    summary = materialize(rollups.summarize_flagged(readings(spark, sf_dir).scored), "rollup")
    by_window = quality.unique_windows(rollups.device_stats_of(summary), "device_stats")
    by_hour = summary.select(F.window("window_start", "1 hour")["start"].alias("window_start"))
    return by_window.unionByName(quality.unique_windows(by_hour, "ten_minutes_as_hours"))


def dq_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Once on whole rows, and once on two columns that do repeat."""
    silver = readings(spark, sf_dir).silver.drop("event_id")
    whole = quality.no_duplicate_rows(silver, "silver")
    repeating = quality.no_duplicate_rows(silver.select("air_quality", "light"), "two_columns")
    return whole.unionByName(repeating)


def dq_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All checks on flagged readings and rollup, one that cannot run, one skipped."""
    source = readings(spark, sf_dir)
    flagged = source.flagged.drop(*IDENTITY)
    stats = materialize(rollups.device_stats(source.scored, ordered=False), "rollup")
    results = (
        check_flagged(flagged)
        .unionByName(check_rollup(stats))
        .unionByName(quality.run_checks(stats, "device_stats", [quality.flags_are_binary()]))
        .unionByName(quality.skipped(spark, "missing_table", ["row_count"]))
    )
    return quality.summarize_checks(results)


def profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.profile(readings(spark, sf_dir).clean)


#: The week that is put together from hourly sketches.
WEEK = ("2024-01-08", "2024-01-15")


def profile_from_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10: a week's profile from stored hourly sketches, held against the readings themselves."""
    clean = readings(spark, sf_dir).clean
    stored = materialize(sketches.sketch_windows(clean), "sketches")
    first, end = (F.lit(day).cast("timestamp_ntz") for day in WEEK)

    def in_week(time: str) -> Column:
        wall = utc_wall_clock(F.col(time))
        return (wall >= first) & (wall < end)

    names = [f"q{100 * q:g}" for q in sketches.QUANTILES]
    profile = materialize(sketches.profile_of(stored.where(in_week("window_start"))), "profile")
    values = F.array(*(F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in METRICS))
    rows = clean.where(in_week(TIME)).select(F.inline(values)).join(F.broadcast(profile), "metric")

    def near(name: str, q: float) -> Column:
        below = F.count_if(F.col("value") < F.col(name)) / F.count("value")
        upto = F.count_if(F.col("value") <= F.col(name)) / F.count("value")
        return ((below <= q + sketches.RANK_ERROR) & (upto >= q - sketches.RANK_ERROR)).cast("int").alias(f"{name}_near")

    exact = F.count_distinct("value")
    off = F.abs(F.max("distinct_values") - exact) <= F.ceil(exact * sketches.DISTINCT_ERROR)
    return rows.groupBy("metric").agg(
        F.max("non_null").alias("non_null"),
        F.max("min_value").alias("min_value"),
        F.max("max_value").alias("max_value"),
        off.cast("int").alias("distinct_near"),
        *(near(name, q) for name, q in zip(names, sketches.QUANTILES, strict=True)),
    )


def robust_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2: medians and median absolute deviations, overall (no user) and per user."""
    scratch = Scratch(spark, "robust")
    clean = materialize(readings(spark, sf_dir).clean, "clean")
    columns = ["user_id", "readings", "median_temp", "mad_temp", "median_humidity", "mad_humidity"]
    overall = quantiles.robust_baseline(clean, scratch).withColumn("user_id", F.lit(None).cast("bigint"))
    by_user = quantiles.robust_baseline(clean, scratch, ("user_id",))
    return overall.select(columns).unionByName(by_user.select(columns))


def spike_episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of spike windows with start, end, peak and length."""
    return shown(islands.spike_episodes(_rate(spark, sf_dir), ALERT_THRESHOLD))


def device_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """2.12: sessions per user, half an hour apart."""
    return shown(islands.device_sessions(readings(spark, sf_dir).clean, ["user_id"]), ROLLUP_AVERAGES)


def asof_purchase(spark: SparkSession, sf_dir: str) -> DataFrame:
    """2.5: each reading with the latest purchase of its user at that time or before."""
    bought = events(spark, sf_dir).where("event_type = 'purchase'")
    moment = F.timestamp_seconds(wall_clock_epoch(F.col("ts"))).alias(TIME)
    purchases = bought.select("user_id", moment, "value")
    clean = readings(spark, sf_dir).clean.select("event_id", "user_id", TIME)
    return shown(asof.asof_join(clean, purchases, ["user_id"], ["value"]).drop("user_id", TIME))


def grouped_rollups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """2.6: averages and anomalies by user, hour and day in one pass."""
    sets = (("user_id", "hour"), ("user_id", "day"), ("user_id",), ("hour",), ("day",), ())
    grouped = rollups.summarize_groups(readings(spark, sf_dir).scored, ("user_id",), sets)
    return shown(grouped, ROLLUP_AVERAGES)


# --- streaming --------------------------------------------------------------------


def _finish(query) -> None:
    query.awaitTermination()


def bronze_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder of JSON lines streamed into a table with its quarantine."""
    source, target, checkpoint = (
        scratch_path(spark, label) for label in ("feed", "bronze", "commits")
    )
    _lines_with_broken(spark, sf_dir).write.text(source)
    _finish(
        bronze_stream_ops.start_bronze(
            bronze_stream_ops.stream_json_lines(spark, source),
            checkpoint=checkpoint,
            path=target,
            trigger=bronze_stream_ops.ONCE,
        )
    )
    return _good_and_bad(spark.read.parquet(target))


def bronze_restarted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream that looks for files every two seconds, stopped and started again."""
    source, target, checkpoint = (
        scratch_path(spark, label) for label in ("feed", "bronze", "commits")
    )
    lines = _lines_with_broken(spark, sf_dir)
    for part in range(2):
        half = lines.where(F.pmod(F.xxhash64("value"), F.lit(2)) == part)
        half.write.mode("append").text(source)
        query = bronze_stream_ops.start_bronze(
            bronze_stream_ops.stream_json_lines(spark, source), checkpoint=checkpoint, path=target
        )
        query.processAllAvailable()
        query.stop()
    return _good_and_bad(spark.read.parquet(target))


PROGRESS_FILES = 160


def ingest_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: lines accepted and set aside by each of 160 micro-batches, written by a listener."""
    source, target, checkpoint, log = (
        scratch_path(spark, label) for label in ("feed", "bronze", "commits", "progress")
    )
    raw = raw_readings(spark, sf_dir, ("event_id",))
    value = F.to_json(F.struct(*RAW_COLUMNS), {"ignoreNullFields": "false"})
    broken = F.when(F.col("Temperature") == "bad", F.concat(F.lit("{"), value)).otherwise(value)
    part = F.pmod("event_id", F.lit(PROGRESS_FILES)).cast("int")
    lines = raw.select(part.alias("part"), broken.alias("value"))
    lines.repartition(8, "part").write.partitionBy("part").text(source)
    listener = IngestListener(spark, log, every=40)
    spark.streams.addListener(listener)
    try:
        query = bronze_stream_ops.start_bronze(
            observed(bronze_stream_ops.stream_json_lines(spark, source, max_files=1)),
            checkpoint=checkpoint,
            path=target,
            trigger=bronze_stream_ops.ONCE,
        )
        _finish(query)
        if not listener.wait(str(query.runId)):
            raise RuntimeError("the listener has not been told of the end of the stream")
    finally:
        spark.streams.removeListener(listener)
    return read_progress(spark, log).select("accepted", "quarantined", "files", "input_rows")


def _streamed(spark: SparkSession, sf_dir: str) -> gold_stream_ops.GoldFolders:
    """The readings in three micro-batches that are out of order, with one far-off time.

    Each batch holds every third second, so windows fill and edges repeat across batches.
    """
    stats = readings(spark, sf_dir).baseline
    folders = gold_stream_ops.GoldFolders.below(scratch_path(spark, "gold"))
    source, checkpoint = scratch_path(spark, "feed"), scratch_path(spark, "commits")
    raw = raw_readings(spark, sf_dir)
    stray = raw.where("Time is not null").limit(1).withColumn("Time", F.concat("Time", F.lit("000")))
    part = F.pmod(F.xxhash64(F.col("Time")), F.lit(3))
    for i in range(3):
        rows = raw.where(part == i)
        rows = rows.unionByName(stray) if i == 0 else rows
        write_json_lines(rows, source, mode="append")
        stream = bronze_stream_ops.stream_json_lines(spark, source)
        _finish(
            gold_stream_ops.start_gold(
                clean_readings(stream.drop(CORRUPT)),
                lambda: stats,
                folders,
                checkpoint=checkpoint,
                trigger=bronze_stream_ops.ONCE,
            )
        )
    return folders


#: Far-off times lie after this.
FAR_OFF = "2100-01-01"


def stream_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Window averages of a stream."""
    windows = gold_stream_ops.live_windows(spark, _streamed(spark, sf_dir))
    return shown(windows.where(F.col("window_start") < FAR_OFF), WINDOW_AVERAGES)


def stream_device_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly rollup of a stream."""
    stats = gold_stream_ops.live_device_stats(spark, _streamed(spark, sf_dir), digits=None)
    return shown(stats.where(F.col("window_start") < FAR_OFF), ROLLUP_AVERAGES)


def stream_anomaly_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anomalies per 10 minutes of a stream."""
    rate = gold_stream_ops.live_anomaly_rate(spark, _streamed(spark, sf_dir))
    return shown(rate.where(F.col("window_start") < FAR_OFF))


def stream_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagged readings of a stream, with their window averages."""
    flagged = gold_stream_ops.live_flagged(spark, _streamed(spark, sf_dir))
    near = flagged.where(F.col(TIME).isNull() | (F.col(TIME) < FAR_OFF))
    return shown(near, WINDOW_AVERAGES)


def stream_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The anomaly log of a stream."""
    log = gold_stream_ops.live_log(spark, _streamed(spark, sf_dir))
    return shown(log.where(F.col("detected_at").isNull() | (F.col("detected_at") < FAR_OFF)))


def stream_device_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """2.12: the same sessions from a stream whose batches are out of order.

    A last reading, far later than the others, closes all sessions.
    """
    source, target, checkpoint = (scratch_path(spark, label) for label in ("feed", "sessions", "commits"))
    raw = readings_from_events(events(spark, sf_dir), ("event_id", "user_id"))
    record = F.to_json(F.struct(*RAW_COLUMNS, "user_id"), {"ignoreNullFields": "false"}).alias("value")
    last = raw.where("Time is not null").limit(1).withColumn("Time", F.lit("1735689600"))
    batches = [raw.where(F.pmod("event_id", F.lit(3)) == i) for i in range(3)] + [last.withColumn("user_id", F.lit(-1))]
    schema = T.StructType([*RAW_SCHEMA, T.StructField("user_id", T.LongType())])
    for batch in batches:
        batch.select(record).write.mode("append").text(source)
        lines = bronze_stream_ops.stream_json_lines(spark, source, schema)
        clean = clean_readings(lines.drop(CORRUPT), ("user_id",)).withWatermark(TIME, "60 days")
        _finish(
            bronze_stream_ops.start_append(
                islands.session_averages(clean, ["user_id"]),
                checkpoint=checkpoint,
                path=target,
                trigger=bronze_stream_ops.ONCE,
            )
        )
    return shown(spark.read.parquet(target).where("user_id >= 0"), ROLLUP_AVERAGES)


def stream_repeated_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """2.9: drops of which all files come again under other names, in one batch and later."""
    root, target, checkpoint, ledger = (
        scratch_path(spark, label) for label in ("drops", "bronze", "commits", "ledger")
    )
    raw = raw_readings(spark, sf_dir, ("event_id",))
    for i, folder in enumerate(("a", "b", "a again", "b again")):
        part = raw.where(F.pmod("event_id", F.lit(2)) == i % 2).drop("event_id")
        part.write.option("header", True).csv(f"{root}/{folder}")
        if i in (1, 3):
            dropped = bronze_stream_ops.stream_files(spark, root, max_files=3)
            _finish(
                bronze_stream_ops.start_csv_bronze(
                    dropped, path=target, checkpoint=checkpoint, ledger=ledger, trigger=bronze_stream_ops.ONCE
                )
            )
    return to_typed(files.bronze_records(spark.read.parquet(target))).drop(TIME)


def _in_parts(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Raw readings by a third of the month each, a twentieth of them a part later; one stray time."""
    raw = readings_from_events(events(spark, sf_dir), ("event_id", "ts"))
    part = F.least(F.floor((F.dayofmonth("ts") - 1) / 10), F.lit(2)) + F.when(F.col("event_id") % 20 == 0, 1).otherwise(0)
    numbered = raw.withColumn("part", F.coalesce(part, F.lit(0)))
    parts = [numbered.where(F.col("part") == i).select(*RAW_COLUMNS) for i in range(4)]
    stray = raw.select(*RAW_COLUMNS).where("Time is not null").limit(1)
    return [parts[0].unionByName(stray.withColumn("Time", F.concat("Time", F.lit("000")))), *parts[1:]]


def stream_late_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows held as streaming state, and late readings put right by a batch step."""
    source, bronze, commits, root = (scratch_path(spark, label) for label in ("feed", "bronze", "commits", "rollup"))
    folders = rollup_ops.RollupFolders.below(root)
    once = bronze_stream_ops.ONCE
    for run, part in enumerate(_in_parts(spark, sf_dir)):
        write_json_lines(part, source, mode="append")
        lines = bronze_stream_ops.stream_json_lines(spark, source)
        _finish(bronze_stream_ops.start_bronze(lines, checkpoint=f"{commits}/bronze", path=bronze, trigger=once))
        clean = clean_readings(lines.drop(CORRUPT))
        _finish(rollup_ops.start_rollup(clean, folders, checkpoint=f"{commits}/rollup", trigger=once))
        stored = clean_readings(files.bronze_records(spark.read.parquet(bronze)))
        rollup_ops.heal(stored, folders, run)
    windows = rollup_ops.rolled_up(rollup_ops.all_windows(stored, folders), 300)
    return shown(windows.where(F.col("window_start") < FAR_OFF), WINDOW_AVERAGES)


# --- tables -----------------------------------------------------------------------


def _table(label: str) -> str:
    return f"verification_{label}_{uuid.uuid4().hex}"


def refreshed_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4: raw to gold tables twice, under two run ids; the log holds each anomaly once."""
    bronze, silver = _table("bronze"), _table("silver")
    tables = GoldTables(_table("hourly"), _table("rate"), _table("log"))
    raw_readings(spark, sf_dir).write.saveAsTable(bronze)
    refresh_silver(spark, bronze, silver, partition_by_date=True)
    for run in ("first", "second"):
        refresh_gold(spark, silver, tables, run)
    log = spark.read.table(tables.anomaly_log)
    rows = materialize(log.select("temp_value", "humidity_value", "detected_at", "details"), "log")
    for name in (bronze, silver, tables.device_stats, tables.anomaly_rate, tables.anomaly_log):
        spark.sql(f"DROP TABLE {name}")
    return shown(rows)


def _followed(spark: SparkSession, sf_dir: str) -> FollowingTables:
    """Tables that followed three loads: most days, one more day, and late readings of all days."""
    path = scratch_path(spark, "bronze")
    raw = raw_readings(spark, sf_dir, ("event_id", "ts"))
    load = F.when(F.col("event_id") % 50 == 0, "late").when(F.dayofmonth("ts") == 15, "day").otherwise("most")
    tables = FollowingTables.named(_table("following"))
    for name in ("most", "day", "late"):
        part = raw.where(load == name).select(*RAW_COLUMNS).withColumn(CORRUPT, F.lit(None).cast("string"))
        files.write_bronze(part, path, name)
        follow_loads(spark, spark.read.parquet(path), tables, run_id=name, digits=None)
    return tables


def _dropped_after(spark: SparkSession, tables: FollowingTables, name: str) -> DataFrame:
    rows = materialize(spark.read.table(name), "followed")
    for field in dataclasses.fields(tables):
        spark.sql(f"DROP TABLE {getattr(tables, field.name)}")
    return rows


def followed_device_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3: the hourly rollup after three loads, of which each refreshed its days only."""
    tables = _followed(spark, sf_dir)
    return shown(_dropped_after(spark, tables, tables.device_stats).drop("event_day"), ROLLUP_AVERAGES)


def followed_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4: the anomaly log after the same loads."""
    tables = _followed(spark, sf_dir)
    return shown(_dropped_after(spark, tables, tables.anomaly_log).drop("event_day", "run_id"))


def merged_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table written, replaced with other columns, and read back by name."""
    name = _table("merged")
    clean = readings(spark, sf_dir).clean
    overwrite_table(clean.select("event_id", "temperature"), name)
    overwrite_table(clean.select("event_id", "humidity"), name)
    rows = materialize(files.load_table(spark, name), "merged")
    spark.sql(f"DROP TABLE {name}")
    return rows


def expired_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The typed table after its old days were dropped."""
    bronze, silver, audit = _table("bronze"), _table("silver"), _table("audit")
    raw_readings(spark, sf_dir).write.saveAsTable(bronze)
    refresh_silver(spark, bronze, silver, partition_by_date=True)
    retention.expire_table(spark, silver, RETAIN_DAYS, NOW, audit, day_column="event_date")
    rows = materialize(spark.read.table(silver).drop("event_date"), "silver")
    dropped = materialize(spark.read.table(audit).select(F.col("day").alias("dropped_day")), "audit")
    for name in (bronze, silver, audit):
        spark.sql(f"DROP TABLE {name}")
    return shown(rows, WINDOW_AVERAGES).unionByName(dropped, allowMissingColumns=True)


def dq_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checks on a stored rollup; those on a missing table are skipped."""
    name = _table("hourly")
    overwrite_table(rollups.device_stats(readings(spark, sf_dir).scored, ordered=False), name)
    results = materialize(check_tables(spark, "no_such_table", name), "results")
    spark.sql(f"DROP TABLE {name}")
    return results.withColumn("target", F.when(F.col("target") == name, "hourly").otherwise(F.col("target")))


QUERIES: dict[str, Query] = {
    "device_stats": device_stats,
    "ingest_csv": ingest_csv,
    "csv_to_json_lines": csv_to_json_lines,
    "ingest_file_counts": ingest_file_counts,
    "ingest_summary": ingest_summary,
    "decode_keys": decode_keys,
    "bronze_read": bronze_read,
    "bronze_read_nested": bronze_read_nested,
    "load_twice": load_twice,
    "ingest_csv_mixed_headers": ingest_csv_mixed_headers,
    "csv_to_json_as_is": csv_to_json_as_is,
    "stream_csv_mixed_headers": stream_csv_mixed_headers,
    "ingest_progress": ingest_progress,
    "bronze_quarantine": bronze_quarantine,
    "ndjson_roundtrip": ndjson_roundtrip,
    "clean_names": clean_column_names,
    "silver_clean": silver_clean,
    "silver_rejects": silver_rejects,
    "event_time": event_time,
    "tumbling_5min": tumbling_5min,
    "silver_joined": silver_joined,
    "silver_joined_left_closed": silver_joined_left_closed,
    "rolling_5min": rolling_5min,
    "rolling_day_by_key": rolling_day_by_key,
    "sliding_5min": sliding_5min,
    "key_order": key_order,
    "global_baseline": global_baseline,
    "global_baseline_from_windows": global_baseline_from_windows,
    "anomaly_flags": anomaly_flags,
    "anomaly_flags_by_key": anomaly_flags_by_key,
    "zscores": zscore_values,
    "device_stats_from_summary": device_stats_from_summary,
    "anomaly_log": log_of_anomalies,
    "anomaly_rate": anomaly_rate,
    "anomaly_rate_filled": anomaly_rate_filled,
    "alert_spikes": alert_spikes,
    "temp_trend": temp_trend,
    "corr_matrix": corr_matrix,
    "first_hours": first_hours,
    "first_rates": first_rates,
    "latest_anomalies": latest_anomalies,
    "plot_feed_hourly": plot_feed_hourly,
    "plot_feed_rate": plot_feed_rate,
    "metric_records": metric_records,
    "clamp_timestamp": clamped_times,
    "retain": retain,
    "layer_counts": counts_per_layer,
    "dq_row_count": dq_row_count,
    "dq_schema": dq_schema,
    "dq_flags": dq_flags,
    "dq_ranges": dq_ranges,
    "dq_unique_window": dq_unique_window,
    "dq_duplicates": dq_duplicates,
    "dq_summary": dq_summary,
    "profile": profile,
    "profile_from_sketches": profile_from_sketches,
    "robust_baseline": robust_baseline,
    "spike_episodes": spike_episodes,
    "asof_purchase": asof_purchase,
    "device_sessions": device_sessions,
    "grouped_rollups": grouped_rollups,
    "bronze_stream": bronze_stream,
    "bronze_restarted": bronze_restarted,
    "refreshed_log": refreshed_log,
    "merged_table": merged_table,
    "dq_tables": dq_tables,
    "followed_device_stats": followed_device_stats,
    "followed_log": followed_log,
    "stream_late_windows": stream_late_windows,
    "stream_device_sessions": stream_device_sessions,
    "stream_repeated_drop": stream_repeated_drop,
    "expired_silver": expired_silver,
    "stream_log": stream_log,
    "stream_tumbling": stream_tumbling,
    "stream_device_stats": stream_device_stats,
    "stream_anomaly_rate": stream_anomaly_rate,
    "stream_gold": stream_gold,
}
