"""Scoring a stream of clean readings, with results that equal those of the batch job.

Nothing waits for a watermark and nothing is dropped. Each micro-batch stores parts that
add up: sums per window, flagged readings, and sums per rollup window. The results are
put together when they are read, so a late reading still counts, the newest window is
there at once, and a reading with a stray time changes its own window only.

A reading exactly on a window edge also belongs to the window before it, once that has
readings. Such readings are kept apart, so that the second row follows when the earlier
window gets its first reading in a later batch.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidegauge.functions import bucket_start, on_bucket_edge, shift_seconds
from tidegauge.operators.anomalies import anomaly_log, flag_anomalies
from tidegauge.operators.keyed_join import attach_by_key
from tidegauge.operators.parts import merged
from tidegauge.operators.rollups import anomaly_rate_of, device_stats_of, summarize_flagged
from tidegauge.operators.windows import averages_of_sums, merged_sums, window_sums
from tidegauge.schema import (
    AVERAGE_SECONDS,
    CLEAN_COLUMNS,
    DECIMALS,
    FLAGGED_COLUMNS,
    METRICS,
    TIME,
    window_average,
)
from tidegauge.sinks.tables import write_run_path
from tidegauge.sources.workspace import Scratch, remove_path
from tidegauge.streaming.bronze import EVERY_TWO_SECONDS

BATCHES_PER_GENERATION = 100
MERGED = -1


@dataclass(frozen=True)
class GoldFolders:
    """Where the parts of each micro-batch go."""

    windows: str
    edges: str
    flagged: str
    rollup: str
    log: str

    @classmethod
    def below(cls, root: str) -> GoldFolders:
        return cls(*(f"{root}/{name}" for name in ("windows", "edges", "flagged", "rollup", "log")))


def merged_rollup(parts: DataFrame) -> DataFrame:
    """One row per rollup window from all its parts."""
    return parts.groupBy("window_start", "window_end").agg(
        *merged(METRICS), F.sum("anomaly_count").alias("anomaly_count")
    )


def batch_writer(
    load_stats: Callable[[], DataFrame], folders: GoldFolders, seconds: int = AVERAGE_SECONDS
) -> Callable[[DataFrame, int], None]:
    """A function that flags, logs and sums up one micro-batch.

    ``load_stats`` is called for each batch and gives the baseline stored last, so that
    a refresh of the baseline reaches a running stream. Every output of a batch replaces
    that of the same batch, so a replay after a failure doubles nothing.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        scratch = Scratch(batch.sparkSession, "micro-batch")
        try:
            own = scratch.table(batch.select(*CLEAN_COLUMNS), "own")
            parts = store_parts(window_sums(own, seconds), merged_sums, folders.windows, batch_id)
            known = parts.select("window_start", "batch_id")
            repeated = own.withColumn("window_start", bucket_start(F.col(TIME), seconds)).unionByName(
                _second_rows(own, known, folders.edges, batch_id, seconds, scratch)
            )
            flagged = scratch.table(flag_anomalies(repeated, load_stats()), "flagged")
            write_run_path(flagged, folders.flagged, str(batch_id), "batch_id")
            write_run_path(anomaly_log(flagged), folders.log, str(batch_id), "batch_id")
            store_parts(summarize_flagged(flagged), merged_rollup, folders.rollup, batch_id)
        finally:
            scratch.close()

    return write


def _second_rows(
    own: DataFrame, known: DataFrame, path: str, batch_id: int, seconds: int, scratch: Scratch
) -> DataFrame:
    """Readings on a window edge, for the window before, where that is known by now.

    These are the batch's own ones, and stored ones of earlier batches whose window
    before is new in this batch. ``known`` has the batches in which windows occur; a
    window is new if all of them are this one. Stored readings are read by day, of the
    days on which new windows end only.
    """
    windows = known.groupBy("window_start").agg(F.min("batch_id").alias("since"))
    before = shift_seconds(F.col(TIME), -seconds).alias("window_start")
    edges = own.where(on_bucket_edge(F.col(TIME), seconds)).select("*", before)
    (
        edges.withColumn("day", _day(F.col(TIME)))
        .withColumn("batch_id", F.lit(batch_id))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("day", "batch_id")
        .parquet(path)
    )
    fresh = scratch.table(windows.where(F.col("since") == batch_id).select("window_start"), "fresh")
    end = _day(shift_seconds(F.col("window_start"), seconds))
    days = [row[0] for row in fresh.select(end.alias("day")).distinct().collect()]
    schema = f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in edges.schema)}, day bigint, batch_id bigint"
    stored = own.sparkSession.read.schema(schema).parquet(path)
    earlier = stored.where(F.col("day").isin(days) & (F.col("batch_id") < batch_id)).drop("day", "batch_id")
    return edges.join(windows, "window_start", "left_semi").unionByName(
        earlier.join(fresh, "window_start", "left_semi")
    )


def _day(time: Column) -> Column:
    """Days since 1970, as a number, because dates of stray times have no calendar."""
    return F.floor(F.unix_micros(time) / F.lit(86_400_000_000))


def store_parts(
    sums: DataFrame, merge: Callable[[DataFrame], DataFrame], path: str, batch_id: int
) -> DataFrame:
    """Store the sums of a batch; returns those of all batches up to it, with ``batch_id``.

    Batches are kept in generations. The first batch of a generation also stores all
    sums before it, merged, so a batch never reads more than one generation of small
    files; the generation before the last is then removed. A row per window is all that
    is ever merged.
    """
    spark = sums.sparkSession
    schema = f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in sums.schema)}, batch_id bigint"

    def read(generation: int) -> DataFrame:
        stored = spark.read.schema(schema).parquet(f"{path}/generation={generation}")
        return stored.filter(F.col("batch_id") <= batch_id)

    def write(rows: DataFrame, part: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/generation={generation}/batch_id={part}")

    generation, place = divmod(batch_id, BATCHES_PER_GENERATION)
    if generation > 0 and place == 0:
        write(merge(read(generation - 1)), MERGED)
        remove_path(spark, f"{path}/generation={generation - 2}")
    write(sums, batch_id)
    return read(generation)


def read_parts(spark: SparkSession, path: str) -> DataFrame:
    """All sums that are stored: those of the newest generation."""
    stored = spark.read.parquet(path)
    newest = stored.agg(F.max("generation")).first()[0]
    return stored.where(F.col("generation") == newest).drop("generation", "batch_id")


def live_windows(spark: SparkSession, folders: GoldFolders, seconds: int = AVERAGE_SECONDS) -> DataFrame:
    """``tumbling_averages`` of all readings that have arrived."""
    averages = averages_of_sums(read_parts(spark, folders.windows))
    return averages.withColumn("window_end", shift_seconds(F.col("window_start"), seconds))


def live_flagged(spark: SparkSession, folders: GoldFolders) -> DataFrame:
    """All flagged readings with the averages that their windows have by now."""
    names = [window_average(metric) for metric in METRICS]
    windows = live_windows(spark, folders).select("window_start", "readings", *names)
    rows = spark.read.parquet(folders.flagged).drop("batch_id")
    return attach_by_key(rows, windows, ["window_start"], "readings").select(*FLAGGED_COLUMNS)


def live_device_stats(
    spark: SparkSession, folders: GoldFolders, digits: int | None = DECIMALS
) -> DataFrame:
    """``device_stats`` of all readings that have arrived."""
    return device_stats_of(read_parts(spark, folders.rollup), digits=digits)


def live_anomaly_rate(spark: SparkSession, folders: GoldFolders) -> DataFrame:
    """``anomaly_rate`` of all readings that have arrived."""
    return anomaly_rate_of(merged_rollup(read_parts(spark, folders.rollup)))


def live_log(spark: SparkSession, folders: GoldFolders) -> DataFrame:
    """The anomaly log of all readings that have arrived."""
    return spark.read.parquet(folders.log).drop("batch_id")


def start_gold(
    clean: DataFrame,
    load_stats: Callable[[], DataFrame],
    folders: GoldFolders,
    *,
    checkpoint: str,
    trigger: Mapping[str, Any] = EVERY_TWO_SECONDS,
    seconds: int = AVERAGE_SECONDS,
) -> StreamingQuery:
    """Start scoring a stream of clean readings; the caller waits or stops it."""
    return (
        clean.writeStream.foreachBatch(batch_writer(load_stats, folders, seconds))
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
