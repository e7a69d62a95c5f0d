"""What a running ingestion has done, batch by batch, in a table.

Spark keeps the progress of the last hundred micro-batches in memory. Here a listener
writes a row for every batch, with counts that the batch itself observes while it is
written, so no extra scan is needed and nothing is forgotten.
"""

from __future__ import annotations

import datetime as dt
import threading

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from tidegauge.schema import CORRUPT, QUARANTINED
from tidegauge.sources.files import file_path

OBSERVED = "ingest"
PROGRESS_SCHEMA = (
    "query_id string, run_id string, batch_id long, started timestamp, seconds double,"
    " input_rows long, accepted long, quarantined long, files long, day string"
)


def observed(lines: DataFrame) -> DataFrame:
    """A stream of parsed lines that counts what passes through it.

    Readable and unreadable lines, and the files they are from; the latter as hashes, so
    a batch holds eight bytes for each of its files.
    """
    broken = F.col(QUARANTINED) if QUARANTINED in lines.columns else F.col(CORRUPT).isNotNull()
    return lines.observe(
        OBSERVED,
        F.count_if(~broken).alias("accepted"),
        F.count_if(broken).alias("quarantined"),
        F.size(F.collect_set(F.xxhash64(file_path()))).cast("long").alias("files"),
    )


class IngestListener(StreamingQueryListener):
    """Appends a row per micro-batch of observed streams to a Parquet folder.

    Add it with ``spark.streams.addListener``. Rows are written in groups of ``every``
    batches and when a query ends; with the default of 1 a crash loses none. A batch that
    is run again after a crash gives a second row, see :func:`read_progress`.
    """

    def __init__(self, spark: SparkSession, path: str, every: int = 1) -> None:
        self.spark, self.path, self.every = spark, path, every
        self._rows: list[tuple] = []
        self._ended: dict[str, threading.Event] = {}

    def onQueryStarted(self, event) -> None:
        self._end(str(event.runId))

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        counts = progress.observedMetrics.get(OBSERVED)
        if counts is None or progress.numInputRows == 0:
            return
        started = dt.datetime.fromisoformat(progress.timestamp.replace("Z", "+00:00"))
        self._rows.append(
            (
                str(progress.id),
                str(progress.runId),
                progress.batchId,
                started,
                progress.batchDuration / 1000,
                progress.numInputRows,
                counts["accepted"],
                counts["quarantined"],
                counts["files"],
                started.astimezone(dt.timezone.utc).strftime("%Y-%m-%d"),
            )
        )
        if len(self._rows) >= self.every:
            self._flush()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        try:
            self._flush()
        finally:
            self._end(str(event.runId)).set()

    def _end(self, run_id: str) -> threading.Event:
        return self._ended.setdefault(run_id, threading.Event())

    def _flush(self) -> None:
        rows, self._rows = self._rows, []
        if rows:
            frame = self.spark.createDataFrame(rows, PROGRESS_SCHEMA)
            frame.coalesce(1).write.mode("append").partitionBy("day").parquet(self.path)

    def wait(self, run_id: str, seconds: float = 60) -> bool:
        """Whether all rows of a run that has ended are written within so many seconds."""
        return self._end(run_id).wait(seconds)


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """One row per query and micro-batch: that of its last run."""
    rows = spark.read.schema(PROGRESS_SCHEMA).parquet(path)
    latest = Window.partitionBy("query_id", "batch_id").orderBy(F.desc("started"), "run_id")
    return rows.withColumn("place", F.row_number().over(latest)).where("place = 1").drop("place")


def summarize_progress(progress: DataFrame) -> DataFrame:
    """Batches, files and lines per query so far."""
    return progress.groupBy("query_id").agg(
        F.count("*").alias("batches"),
        *(F.sum(name).alias(name) for name in ("files", "accepted", "quarantined")),
        F.max("started").alias("last_started"),
    )
