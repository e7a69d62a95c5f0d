"""Old days of tables and folders, and files that are sent again."""

import datetime as dt
from pathlib import Path
from urllib.parse import unquote, urlparse

import pytest
from pyspark.sql import functions as F

from tests.helpers import column, values
from tidegauge.schema import RAW_COLUMNS
from tidegauge.sinks import retention
from tidegauge.sources.files import bronze_records, quarantined_lines
from tidegauge.streaming import bronze

NOW = dt.datetime(2024, 3, 1, 12, tzinfo=dt.timezone.utc)
DAYS = ["2024-02-01", "2024-02-22", "2024-02-23", "2024-02-29", "none"]


@pytest.fixture
def table(spark):
    rows = spark.createDataFrame([(day, i) for i, day in enumerate(DAYS)], "event_day string, x int")
    rows.withColumn("load_id", F.lit("a'b/c=1")).write.partitionBy("event_day", "load_id").saveAsTable("expiring", format="parquet")
    yield "expiring"
    for name in ("expiring", "expired_audit"):
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def stored_files(spark, name):
    return {path: Path(unquote(urlparse(path).path)).stat().st_mtime_ns for path in spark.read.table(name).inputFiles()}


def test_old_days_of_a_table(spark, table):
    before = stored_files(spark, table)
    assert retention.expire_table(spark, table, 7, NOW, "expired_audit") == DAYS[:2]
    assert column(spark.read.table(table), "event_day") == DAYS[2:]
    after = stored_files(spark, table)
    assert after.items() <= before.items() and len(after) == 3
    assert all(not Path(unquote(urlparse(path).path)).exists() for path in before.keys() - after.keys())
    for _ in range(2):
        assert retention.expire_table(spark, table, 7, NOW, "expired_audit") == []
    audit = spark.read.table("expired_audit")
    assert values(audit, "target", "day", "first_kept") == [(table, day, "2024-02-23") for day in DAYS[:2]]


def test_days_that_are_kept():
    days = ["2024-02-30", "2024-2-1", "+12345-01-01", "none", "2024-02-28", "2024-02-29"]
    assert retention.expired_days(days, 1, NOW) == (["2024-02-28"], "2024-02-29")
    behind = dt.datetime(2024, 3, 1, 1, tzinfo=dt.timezone(dt.timedelta(hours=5)))
    assert retention.expired_days(days, 0, behind) == (["2024-02-28"], "2024-02-29")
    assert retention.expired_days(["2024-02-29"], 0, NOW.replace(tzinfo=None)) == (["2024-02-29"], "2024-03-01")
    with pytest.raises(ValueError):
        retention.expired_days(days, -1, NOW)


def test_old_days_of_a_folder(spark, tmp_path):
    path = str(tmp_path / "log")
    rows = spark.createDataFrame([(day, i) for i, day in enumerate(DAYS)], "day string, x int")
    rows.write.partitionBy("day").parquet(path)
    assert retention.expire_folder(spark, path, 7, NOW) == DAYS[:2]
    assert column(spark.read.parquet(path), "x") == [2, 3, 4]


HEADER = ",".join(RAW_COLUMNS)


def store(spark, tmp_path, **options):
    query = bronze.start_csv_bronze(
        bronze.stream_files(spark, str(tmp_path / "drop"), **options),
        path=str(tmp_path / "bronze"),
        checkpoint=str(tmp_path / "commits"),
        ledger=str(tmp_path / "ledger"),
        trigger=bronze.ONCE,
    )
    query.awaitTermination()
    return spark.read.parquet(str(tmp_path / "bronze"))


def test_a_file_that_is_sent_again_counts_once(spark, tmp_path):
    """In one batch, in a later one, and after a restart; odd files as well."""
    drop = tmp_path / "drop"
    drop.mkdir()
    body = HEADER + "\n0,1,1,1,1,1\n"
    for name in ("a.csv", "b.csv"):
        (drop / name).write_text(body)
    (drop / "odd.csv").write_text("x\n1\n")
    store(spark, tmp_path)
    (drop / "c.csv").write_text(body)
    (drop / "odd again.csv").write_text("x\n1\n")
    (drop / "other.csv").write_text(body + "5,1,1,1,1,1\n")
    stored = store(spark, tmp_path, max_files=1)
    assert column(bronze_records(stored), "Time") == ["0", "0", "5"]
    assert column(quarantined_lines(stored), "line") == ["1", "x"]


def test_a_batch_that_runs_again_takes_the_same_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("1")
    path, ledger = str(tmp_path / "a.csv"), str(tmp_path / "ledger")
    for _ in range(2):
        assert [p.rsplit("/", 1)[1] for p in bronze.new_contents(spark, [path], ledger, 0)] == ["a.csv"]
    assert bronze.new_contents(spark, [path], ledger, 1) == []
