"""Raw ingestion as a stream: JSON lines in, an append-only table out."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidegauge.schema import CORRUPT, LOAD, QUARANTINED, RAW_SCHEMA
from tidegauge.sinks.tables import to_json_lines, write_run_path
from tidegauge.sources.files import json_schema, mark_quarantined, odd_csv_lines, read_csv_drop
from tidegauge.sources.workspace import Scratch

# Fixed value: how often new files are looked for.
EVERY_TWO_SECONDS: Mapping[str, Any] = {"processingTime": "2 seconds"}
ONCE: Mapping[str, Any] = {"availableNow": True}


def stream_json_lines(
    spark: SparkSession,
    path: str,
    schema: T.StructType = RAW_SCHEMA,
    max_files: int | None = None,
) -> DataFrame:
    """New JSON-lines files of a folder; unreadable lines in ``_corrupt_record``.

    ``max_files`` bounds one micro-batch, for a first start on a full folder.
    """
    reader = (
        spark.readStream.schema(json_schema(schema))
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("recursiveFileLookup", True)
    )
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path)


def stream_csv_drop(
    spark: SparkSession,
    path: str,
    schema: T.StructType = RAW_SCHEMA,
    *,
    multiline: bool = True,
    max_files: int | None = None,
) -> DataFrame:
    """New CSV files of a drop folder that all have one header, every column as text.

    Another header raises; :func:`start_csv_bronze` takes files of any headers.
    """
    reader = (
        spark.readStream.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("multiLine", multiline)
        .option("recursiveFileLookup", True)
    )
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.csv(path)


def stream_files(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """``path`` of each new file of a folder, which is not read."""
    reader = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length long, content binary")
        .option("recursiveFileLookup", True)
    )
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path).select("path")


LEDGER_SCHEMA = "digest string, length bigint, source_file string, batch_id int"


def new_contents(spark: SparkSession, paths: list[str], ledger: str, batch_id: int) -> list[str]:
    """Those of ``paths`` whose contents no file had in an earlier batch or has before it in this.

    Files are told apart by the digest and length of their bytes. ``ledger`` is a folder
    that names every file taken so far; the same batch again replaces its own part.
    """
    found = (
        spark.read.format("binaryFile")
        .load(paths)
        .select(F.sha2("content", 256).alias("digest"), "length", F.col("path").alias("source_file"))
        .groupBy("digest", "length")
        .agg(F.min("source_file").alias("source_file"))
    )
    scratch = Scratch(spark, "contents")
    try:
        own = scratch.table(found, "found")
        if batch_id > 0:
            earlier = spark.read.schema(LEDGER_SCHEMA).parquet(ledger).where(F.col("batch_id") < batch_id)
            own = scratch.table(own.join(earlier, ["digest", "length"], "left_anti"), "new")
        write_run_path(own, ledger, str(batch_id), "batch_id")
        return sorted(row.source_file for row in own.select("source_file").collect())
    finally:
        scratch.close()


def csv_batch_writer(
    path: str,
    schema: T.StructType = RAW_SCHEMA,
    *,
    multiline: bool = True,
    ledger: str | None = None,
) -> Callable[[DataFrame, int], None]:
    """A function that stores the CSV files of one micro-batch, whatever their headers.

    Files are grouped by header and each group is read by it, with the columns that the
    schema doesn't know in ``_extra``. The lines of files without a known column go to the
    quarantine. Every batch replaces its own partition, so a replay doubles nothing. With
    a ``ledger`` folder a file that is sent again under another name is left out too.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        paths = [row.path for row in batch.collect()]
        if ledger is not None and paths:
            paths = new_contents(spark, paths, ledger, batch_id)
        rows = read_csv_drop(spark, paths, schema, multiline=multiline, extras=True, source=True)
        good = rows.withColumn(QUARANTINED, F.lit(False))
        odd = odd_csv_lines(spark, paths, schema).withColumn(QUARANTINED, F.lit(True))
        (
            good.unionByName(odd, allowMissingColumns=True)
            .withColumn(LOAD, F.lit(str(batch_id)))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(LOAD, QUARANTINED)
            .parquet(path)
        )

    return write


def start_csv_bronze(
    files: DataFrame,
    *,
    path: str,
    checkpoint: str,
    schema: T.StructType = RAW_SCHEMA,
    multiline: bool = True,
    ledger: str | None = None,
    trigger: Mapping[str, Any] = EVERY_TWO_SECONDS,
) -> StreamingQuery:
    """Store the rows of CSV files of :func:`stream_files` as they come, each file once."""
    return (
        files.writeStream.foreachBatch(csv_batch_writer(path, schema, multiline=multiline, ledger=ledger))
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def start_append(
    stream: DataFrame,
    *,
    checkpoint: str,
    path: str | None = None,
    table: str | None = None,
    partition_by: tuple[str, ...] = (),
    trigger: Mapping[str, Any] = EVERY_TWO_SECONDS,
    fmt: str = "parquet",
) -> StreamingQuery:
    """Start appending a stream to a folder or table; the caller waits or stops it.

    With the same checkpoint a restart goes on where it stopped, and each input
    file is stored exactly once.
    """
    if (path is None) == (table is None):
        raise ValueError("give either a path or a table")
    writer = (
        stream.writeStream.format(fmt)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.start(path) if path is not None else writer.toTable(table)


def start_bronze(
    stream: DataFrame,
    *,
    checkpoint: str,
    path: str | None = None,
    table: str | None = None,
    trigger: Mapping[str, Any] = EVERY_TWO_SECONDS,
) -> StreamingQuery:
    """Store raw records and unreadable lines in one go, apart by partition.

    Each file is parsed once, and both kinds are committed by the same batch.
    """
    return start_append(
        mark_quarantined(stream),
        checkpoint=checkpoint,
        path=path,
        table=table,
        partition_by=(QUARANTINED,),
        trigger=trigger,
    )


def start_csv_to_json(
    stream: DataFrame,
    *,
    path: str,
    checkpoint: str,
    trigger: Mapping[str, Any] = EVERY_TWO_SECONDS,
) -> StreamingQuery:
    """Turn CSV drops into JSON lines as they come, each file once."""
    return start_append(
        to_json_lines(stream), checkpoint=checkpoint, path=path, trigger=trigger, fmt="text"
    )


def progress(query: StreamingQuery) -> list[tuple[int, int]]:
    """Batch number and input rows of the recent micro-batches."""
    return [(batch["batchId"], batch["numInputRows"]) for batch in query.recentProgress]
