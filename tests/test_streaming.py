import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.helpers import clean, column, epoch, values
from tidegauge.operators.anomalies import anomaly_log, flag_anomalies
from tidegauge.operators.cleaning import clean_readings
from tidegauge.operators.rollups import anomaly_rate, device_stats
from tidegauge.operators.windows import (
    attach_window_averages,
    averages_of_sums,
    merged_sums,
    tumbling_averages,
    window_sums,
)
from tidegauge.schema import CORRUPT, RAW_COLUMNS
from tidegauge.sources.files import bronze_records, quarantined_lines
from tidegauge.sources.workspace import shared_folder
from tidegauge.streaming import bronze, gold, progress


def line(time, temperature="1"):
    return json.dumps(dict(zip(RAW_COLUMNS, (str(time), str(temperature), "1", "1", "1", "1"))))


class Feed:
    """A drop folder and the places a stream writes to."""

    def __init__(self, root):
        self.source = root / "source"
        self.source.mkdir()
        self.target = str(root / "target")
        self.checkpoint = str(root / "checkpoint")
        self.files = 0

    def drop(self, *lines):
        self.files += 1
        (self.source / f"{self.files}.json").write_text("\n".join(lines) + "\n")

    def readings(self, spark):
        return clean_readings(bronze.stream_json_lines(spark, str(self.source)).drop(CORRUPT))

    def append(self, stream):
        query = bronze.start_append(
            stream, checkpoint=self.checkpoint, path=self.target, trigger=bronze.ONCE
        )
        query.awaitTermination()
        return query


@pytest.fixture
def feed(tmp_path):
    return Feed(tmp_path)


def store(spark, feed):
    query = bronze.start_bronze(
        bronze.stream_json_lines(spark, str(feed.source)),
        checkpoint=feed.checkpoint,
        path=feed.target,
        trigger=bronze.ONCE,
    )
    query.awaitTermination()
    return query


def test_bronze_is_stored_once_over_restarts(spark, feed):
    feed.drop(line(0), "{broken", line(300))
    query = store(spark, feed)
    assert bronze.progress(query) == [(0, 3)]
    feed.drop(line(600))
    store(spark, feed)
    store(spark, feed)
    stored = spark.read.parquet(feed.target)
    assert column(bronze_records(stored), "Time") == ["0", "300", "600"]
    assert column(quarantined_lines(stored), "line") == ["{broken"]


def test_bronze_table(spark, feed):
    feed.drop(line(0), "{broken")
    query = bronze.start_bronze(
        bronze.stream_json_lines(spark, str(feed.source)),
        checkpoint=feed.checkpoint,
        table="bronze_stream_test",
        trigger=bronze.ONCE,
    )
    query.awaitTermination()
    stored = spark.read.table("bronze_stream_test")
    assert bronze_records(stored).count() == quarantined_lines(stored).count() == 1
    spark.sql("DROP TABLE bronze_stream_test")
    with pytest.raises(ValueError):
        bronze.start_append(stored, checkpoint="x")


def test_default_trigger_runs_until_stopped(spark, feed):
    feed.drop(line(0))
    query = bronze.start_bronze(
        bronze.stream_json_lines(spark, str(feed.source)), checkpoint=feed.checkpoint, path=feed.target
    )
    try:
        query.processAllAvailable()
        assert query.isActive
        assert spark.read.parquet(feed.target).count() == 1
    finally:
        query.stop()


def test_csv_drop_as_a_stream(spark, feed):
    (feed.source / "a.csv").write_text(",".join(RAW_COLUMNS) + "\n0,1,2,3,4,5\n1,2\n")
    feed.append(bronze.stream_csv_drop(spark, str(feed.source)))
    assert values(spark.read.parquet(feed.target), "Time", "Loudness") == [("0", "5"), ("1", None)]


def test_csv_drop_becomes_json_lines(spark, feed):
    (feed.source / "a.csv").write_text(",".join(RAW_COLUMNS) + "\n0,1,2,3,4,5\n1,2\n")
    query = bronze.start_csv_to_json(
        bronze.stream_csv_drop(spark, str(feed.source)),
        path=feed.target,
        checkpoint=feed.checkpoint,
        trigger=bronze.ONCE,
    )
    query.awaitTermination()
    lines = column(spark.read.text(feed.target), "value")
    assert json.loads(lines[0]) == dict(zip(RAW_COLUMNS, "012345"))
    assert json.loads(lines[1])["Loudness"] is None


def test_closed_windows_with_a_watermark(spark, feed):
    """The operators themselves take streams; a watermark then holds back and drops."""
    for lines in ((line(0), line(300), "{broken"), (line(5000),), (line(9000),)):
        feed.drop(*lines)
        feed.append(tumbling_averages(feed.readings(spark).withWatermark("event_time", "10 minutes")))
    stored = spark.read.parquet(feed.target)
    assert column(stored.select(epoch("window_start")), "window_start") == [0, 300, 4800]


STATS = "mean_temp double, std_temp double, mean_humidity double, std_humidity double"


def stats_row(spark):
    return spark.createDataFrame([(3.0, 4.0, 1.0, 0.5)], STATS)


def gold_run(spark, feed, stats, root):
    folders = gold.GoldFolders.below(str(root / "gold"))
    query = gold.start_gold(
        feed.readings(spark), lambda: stats, folders, checkpoint=feed.checkpoint, trigger=bronze.ONCE
    )
    query.awaitTermination()
    return folders


def batch_rows(spark, rows):
    whole = clean(spark, rows)
    return attach_window_averages(whole, tumbling_averages(whole))


def same_as_batch(spark, folders, rows, stats):
    """All live results equal those of the batch operators over the same readings."""
    flagged = flag_anomalies(batch_rows(spark, rows), stats)
    assert values(gold.live_flagged(spark, folders)) == values(flagged)
    assert values(gold.live_device_stats(spark, folders)) == values(device_stats(flagged))
    assert values(gold.live_anomaly_rate(spark, folders)) == values(anomaly_rate(flagged))
    assert values(gold.live_log(spark, folders)) == values(anomaly_log(flagged))
    windows = tumbling_averages(clean(spark, rows))
    assert values(gold.live_windows(spark, folders).select(windows.columns)) == values(windows)


def test_gold_batches(spark, feed, tmp_path):
    first = [(0, 1.0), (100, 2.0), (300, 3.0)]
    second = [(301, 90.0), (600, 5.0)]
    for rows in (first, second):
        feed.drop(*(line(time, temperature) for time, temperature in rows))
        folders = gold_run(spark, feed, stats_row(spark), tmp_path)
    same_as_batch(spark, folders, first + second, stats_row(spark))
    assert gold.live_flagged(spark, folders).count() == 7
    assert values(spark.read.parquet(folders.log), "temp_value", "batch_id") == [(90.0, 1)]


def test_batches_out_of_order_and_a_stray_time(spark, feed, tmp_path):
    """The window before an edge comes later; one far-off time changes its own window only."""
    batches = [[(300, 90.0), (900, 2.0), (1623781100000, 3.0)], [(10, 1.0), (600, 91.0)], [(5, 4.0), (9000, 92.0), (20000, 5.0)]]
    for rows in batches:
        feed.drop(*(line(time, temperature) for time, temperature in rows))
        folders = gold_run(spark, feed, stats_row(spark), tmp_path)
    near = [row for rows in batches for row in rows if row[0] < 10**6]
    flagged = flag_anomalies(batch_rows(spark, near), stats_row(spark))
    live = gold.live_flagged(spark, folders).where("event_time < '2100-01-01'")
    assert values(live) == values(flagged)
    assert live.where("event_time = timestamp_seconds(300)").count() == 2
    windows = gold.live_windows(spark, folders)
    assert windows.count() == 7 and windows.where("window_start > '2100-01-01'").count() == 1


def test_sums_survive_a_change_of_generation(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(gold, "BATCHES_PER_GENERATION", 2)
    path = str(tmp_path / "windows")
    batches = [[(0, 1.0)], [(10, 2.0)], [(20, 3.0), (300, 4.0)], [], [(30, 6.0)], [(301, 8.0)]]
    for batch_id, rows in enumerate(batches):
        for _ in range(2):
            parts = gold.store_parts(window_sums(clean(spark, rows)), merged_sums, path, batch_id)
        whole = clean(spark, [row for batch in batches[: batch_id + 1] for row in batch])
        expected = tumbling_averages(whole).select("window_start", "readings", "avg_temp_5min")
        for found in (parts, gold.read_parts(spark, path)):
            assert values(averages_of_sums(found).select(expected.columns)) == values(expected)
    assert parts.count() < 5
    assert sorted(p.name for p in (tmp_path / "windows").iterdir()) == ["generation=1", "generation=2"]


def test_a_replayed_batch_doubles_nothing(spark, tmp_path):
    folders = gold.GoldFolders.below(str(tmp_path))
    write = gold.batch_writer(lambda: stats_row(spark), folders)
    rows = [[(0, 1.0), (300, 90.0), (None, 91.0)], [(310, 92.0)], [(None, 93.0)]]
    for batch_id, times in ((0, 1), (1, 2), (2, 1), (2, 1)):
        for _ in range(times):
            write(clean(spark, rows[batch_id]), batch_id)
    same_as_batch(spark, folders, [row for batch in rows for row in batch], stats_row(spark))
    assert column(gold.live_log(spark, folders), "temp_value") == [90.0, 90.0, 91.0, 92.0, 93.0]


def test_batches_leave_no_scratch_folders(spark, tmp_path):
    def left():
        return [p for p in Path(shared_folder(spark)).iterdir() if p.name.startswith("micro-batch")]

    write = gold.batch_writer(lambda: stats_row(spark), gold.GoldFolders.below(str(tmp_path)))
    for batch_id in range(3):
        write(clean(spark, [(batch_id * 300, 1.0)]), batch_id)
    assert left() == []


HEADER = ",".join(RAW_COLUMNS)


def store_csv(spark, feed, max_files=None):
    query = bronze.start_csv_bronze(
        bronze.stream_files(spark, str(feed.source), max_files),
        path=feed.target,
        checkpoint=feed.checkpoint,
        trigger=bronze.ONCE,
    )
    query.awaitTermination()


def test_csv_files_of_any_header_in_one_stream(spark, feed):
    """Across batches and restarts; files without a known column are set aside whole."""
    (feed.source / "a.csv").write_text(HEADER + "\n0,1,1,1,1,1\n")
    (feed.source / "b c.csv").write_text("Light,Battery,Time\n5,low,1\n")
    (feed.source / "odd.csv").write_text("x,y\n1,2\n")
    store_csv(spark, feed, max_files=1)
    (feed.source / "d.csv").write_text("Time\n2\n3,more\n")
    store_csv(spark, feed)
    store_csv(spark, feed)
    stored = spark.read.parquet(feed.target)
    good = bronze_records(stored)
    assert values(good, "Time", "Light", "_extra") == [
        ("0", "1", None), ("1", "5", '{"Battery":"low"}'), ("2", None, None), ("3", None, None)
    ]
    assert values(quarantined_lines(stored)) == [("1,2",), ("x,y",)]
    assert values(stored.where("Time = '3'"), "_corrupt_record") == [("3,more",)]


def test_a_csv_batch_that_runs_again_doubles_nothing(spark, feed):
    (feed.source / "a.csv").write_text(HEADER + "\n0,1,1,1,1,1\n")
    batch = spark.createDataFrame([(str(feed.source / "a.csv"),)], "path string")
    write = bronze.csv_batch_writer(feed.target)
    for _ in range(2):
        write(batch, 7)
    assert column(bronze_records(spark.read.parquet(feed.target)), "Time") == ["0"]


@pytest.fixture
def listener(spark, tmp_path):
    listener = progress.IngestListener(spark, str(tmp_path / "progress"), every=2)
    spark.streams.addListener(listener)
    yield listener
    spark.streams.removeListener(listener)


def test_progress_of_every_batch_is_kept(spark, feed, listener):
    """Rows of all runs of a stream; a stream that observes nothing adds none."""
    for lines in (("{broken", line(0)), (line(1), line(2)), ("{", "{")):
        feed.drop(*lines)
    for _ in range(2):
        query = bronze.start_bronze(
            progress.observed(bronze.stream_json_lines(spark, str(feed.source), max_files=1)),
            checkpoint=feed.checkpoint,
            path=feed.target,
            trigger=bronze.ONCE,
        )
        query.awaitTermination()
        assert listener.wait(str(query.runId))
        feed.drop(line(9))
    other = bronze.start_append(
        feed.readings(spark), checkpoint=feed.checkpoint + "2", path=feed.target + "2", trigger=bronze.ONCE
    )
    other.awaitTermination()
    assert listener.wait(str(other.runId))
    rows = progress.read_progress(spark, listener.path)
    assert values(rows, "batch_id", "input_rows", "files") == [(0, 2, 1), (1, 2, 1), (2, 2, 1), (3, 1, 1)]
    total = progress.summarize_progress(rows).first()
    assert (total.batches, total.files, total.accepted, total.quarantined) == (4, 4, 4, 3)
    again = rows.withColumn("started", F.col("started") + F.expr("INTERVAL 1 HOUR")).withColumn("accepted", F.lit(5).cast("long"))
    again.coalesce(1).write.mode("append").partitionBy("day").parquet(listener.path)
    assert column(progress.read_progress(spark, listener.path), "accepted") == [5, 5, 5, 5]
