"""Window sums kept as native streaming state, and readings that come too late for it.

The state holds the windows that are still open: a watermark closes them, and closed ones
are appended once. What comes for a closed window is not counted by the state, but is in
the stored readings like all others. A batch step finds the windows in which stored
readings outnumber counted ones, notes them in a table and sums those windows anew. So
the state stays as small as the watermark allows, and results equal those of a batch.

Times ahead of the clock would close every window. They never reach the state, and are
summed by the batch step like late ones.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidegauge.functions import bucket_start, shift_seconds
from tidegauge.operators.parts import part_names, sums_of
from tidegauge.operators.windows import averages_of_sums, merged_sums, window_sums
from tidegauge.schema import AVERAGE_SECONDS, METRICS, TIME, window_average
from tidegauge.sinks.tables import write_run_path
from tidegauge.sources.workspace import Scratch
from tidegauge.streaming.bronze import EVERY_TWO_SECONDS, start_append

#: How long a window waits for readings, and how far a clock may be ahead.
DELAY = "10 minutes"
AHEAD_SECONDS = 3600


@dataclass(frozen=True)
class RollupFolders:
    """Windows that the stream closed, windows summed anew, and why."""

    closed: str
    healed: str
    late: str

    @classmethod
    def below(cls, root: str) -> RollupFolders:
        return cls(*(f"{root}/{name}" for name in ("closed", "healed", "late")))


def watermarked_sums(
    readings: DataFrame,
    seconds: int = AVERAGE_SECONDS,
    delay: str = DELAY,
    metrics: tuple[str, ...] = METRICS,
) -> DataFrame:
    """``window_sums`` of a stream, each window when the watermark has passed its end."""
    latest = shift_seconds(F.current_timestamp(), AHEAD_SECONDS)
    on_clock = readings.where(F.col(TIME) <= latest).withWatermark(TIME, delay)
    return (
        on_clock.groupBy(F.window(TIME, f"{seconds} seconds").alias("window"))
        .agg(F.count("*").alias("readings"), *sums_of(metrics))
        .select(F.col("window.start").alias("window_start"), "readings", *part_names(metrics))
    )


def start_rollup(
    readings: DataFrame,
    folders: RollupFolders,
    *,
    checkpoint: str,
    seconds: int = AVERAGE_SECONDS,
    delay: str = DELAY,
    trigger: Mapping[str, Any] = EVERY_TWO_SECONDS,
) -> StreamingQuery:
    """Start appending closed windows; each is written exactly once."""
    return start_append(
        watermarked_sums(readings, seconds, delay), checkpoint=checkpoint, path=folders.closed, trigger=trigger
    )


def counted_windows(spark: SparkSession, folders: RollupFolders) -> DataFrame:
    """Sums of the closed windows as they count now: of the last run that healed them."""
    closed = _stored(spark, folders.closed, _schema()).withColumn("run", F.lit(-1))
    healed = _stored(spark, folders.healed, f"{_schema()}, run int")
    latest = Window.partitionBy("window_start").orderBy(F.desc("run"))
    rows = closed.unionByName(healed).withColumn("place", F.row_number().over(latest))
    return rows.where("place = 1").drop("place", "run")


def _schema() -> str:
    columns = (f"{name} {'double' if name.startswith('sum') else 'bigint'}" for name in part_names(METRICS))
    return ", ".join(("window_start timestamp", "readings bigint", *columns))


def _stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows of a folder; none where nothing has been written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _closed_until(spark: SparkSession, folders: RollupFolders, seconds: int) -> Column:
    """The end of the last window that the stream closed, as a value in the plan; NULL if none is."""
    closed = _stored(spark, folders.closed, _schema())
    return closed.agg(shift_seconds(F.max("window_start"), seconds).alias("until")).scalar()


def _behind(window_start: Column, until: Column, seconds: int) -> Column:
    """Windows that the stream adds nothing to any more, and those ahead of the clock."""
    ahead = window_start > shift_seconds(F.current_timestamp(), AHEAD_SECONDS)
    return F.coalesce(shift_seconds(window_start, seconds) <= until, F.lit(False)) | ahead


def heal(
    stored: DataFrame,
    folders: RollupFolders,
    run: int,
    *,
    arrived: DataFrame | None = None,
    seconds: int = AVERAGE_SECONDS,
) -> DataFrame:
    """Sum closed windows anew that hold more readings than were counted.

    ``stored`` has all clean readings that have arrived, and ``arrived`` those since the
    last run, which bounds the windows that are looked at; without it all are. ``run``
    numbers the runs upwards, and the same number again replaces that run. Returns the
    late table's rows of this run: ``window_start, counted, stored, late``.
    """
    spark = stored.sparkSession
    scratch = Scratch(spark, "heal")
    try:
        counted = scratch.table(counted_windows(spark, folders), "counted")
        until = _closed_until(spark, folders, seconds)
        start = bucket_start(F.col(TIME), seconds)
        new = (stored if arrived is None else arrived).where(F.col(TIME).isNotNull())
        touched = scratch.table(
            new.select(start.alias("window_start")).distinct().where(_behind(F.col("window_start"), until, seconds)),
            "touched",
        )
        own = stored.where(F.col(TIME).isNotNull()).withColumn("window_start", start)
        there = own.join(touched, "window_start", "left_semi").groupBy("window_start").agg(F.count("*").alias("stored"))
        known = counted.select("window_start", F.col("readings").alias("counted"))
        late = scratch.table(
            there.join(known, "window_start", "left")
            .na.fill(0, ["counted"])
            .withColumn("late", F.col("stored") - F.col("counted"))
            .where("late <> 0")
            .select("window_start", "counted", "stored", "late"),
            "late",
        )
        again = own.join(late.select("window_start"), "window_start", "left_semi").drop("window_start")
        write_run_path(window_sums(again, seconds), folders.healed, str(run), "run")
        write_run_path(late, folders.late, str(run), "run")
    finally:
        scratch.close()
    return late_windows(spark, folders).where(F.col("run") == run).drop("run")


def late_windows(spark: SparkSession, folders: RollupFolders) -> DataFrame:
    """``window_start, counted, stored, late, run``: all windows that were summed anew."""
    schema = "window_start timestamp, counted bigint, stored bigint, late bigint, run int"
    return _stored(spark, folders.late, schema)


def all_windows(stored: DataFrame, folders: RollupFolders, seconds: int = AVERAGE_SECONDS) -> DataFrame:
    """Sums of all windows: closed and healed ones, and open ones from the stored readings.

    Of the stored readings only those after the last closed window are read, by time.
    """
    counted = counted_windows(stored.sparkSession, folders)
    until = _closed_until(stored.sparkSession, folders, seconds)
    start = bucket_start(F.col(TIME), seconds)
    still_open = stored.where(F.col(TIME).isNotNull() & ~_behind(start, until, seconds))
    return counted.unionByName(window_sums(still_open, seconds))


def rolled_up(parts: DataFrame, seconds: int, metrics: tuple[str, ...] = METRICS) -> DataFrame:
    """Averages of windows of ``seconds`` from sums of windows that divide them."""
    wider = parts.withColumn("window_start", bucket_start(F.col("window_start"), seconds))
    averages = averages_of_sums(merged_sums(wider, metrics), metrics)
    return averages.select(
        "window_start",
        shift_seconds(F.col("window_start"), seconds).alias("window_end"),
        *(window_average(metric) for metric in metrics),
        "readings",
    )
