"""Tables that follow loads, against a full rebuild over the same readings."""

from pathlib import Path
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

from tests.helpers import OTHERS, column, values
from tidegauge.plans import incremental
from tidegauge.plans.layers import GoldTables, refresh_gold, refresh_silver
from tidegauge.schema import CORRUPT, RAW_COLUMNS, SILVER_COLUMNS
from tidegauge.sources import files

DAY = 86_400


class Layers:
    """A raw layer that loads are added to, and the tables that follow it."""

    def __init__(self, spark, path):
        self.spark, self.path = spark, path
        self.tables = incremental.FollowingTables.named("following_test")
        self.full = GoldTables("full_hourly", "full_rate", "full_log", flagged="full_flagged", baseline="full_baseline")
        self.runs = 0

    def load(self, name, rows):
        schema = ", ".join(f"{column} string" for column in (*RAW_COLUMNS, CORRUPT))
        data = [(None if time is None else str(time), str(value), *OTHERS, None) for time, value in rows]
        files.write_bronze(self.spark.createDataFrame(data, schema), self.path, name)

    def follow(self):
        self.runs += 1
        return incremental.follow_loads(self.spark, self.spark.read.parquet(self.path), self.tables, f"run{self.runs}")

    def rebuild(self):
        files.bronze_records(self.spark.read.parquet(self.path)).write.mode("overwrite").saveAsTable("full_bronze")
        refresh_silver(self.spark, "full_bronze", "full_silver")
        refresh_gold(self.spark, "full_silver", self.full, "full")

    def check(self):
        """All tables equal those of a full rebuild."""
        self.rebuild()
        read = self.spark.read.table
        assert values(read(self.tables.silver), *SILVER_COLUMNS) == values(read("full_silver"), *SILVER_COLUMNS)
        columns = [name for name in read("full_flagged").columns]
        assert values(read(self.tables.flagged), *columns) == values(read("full_flagged"), *columns)
        for ours, full in (("device_stats", "full_hourly"), ("anomaly_rate", "full_rate")):
            columns = read(full).columns
            assert values(read(getattr(self.tables, ours)), *columns) == values(read(full), *columns)
        columns = ["temp_value", "humidity_value", "detected_at", "event_day"]
        assert values(read(self.tables.anomaly_log), *columns) == values(read("full_log"), *columns)
        one, other = read(self.tables.baseline).first(), read("full_baseline").first()
        assert [one[name] for name in other.asDict()] == pytest.approx([*other])

    def files(self, table):
        """The data files of a table and when they were written."""
        found = self.spark.read.table(table).inputFiles()
        return {name: Path(urlparse(name).path).stat().st_mtime_ns for name in found}


@pytest.fixture
def layers(spark, tmp_path):
    layers = Layers(spark, str(tmp_path / "bronze"))
    yield layers
    for table in (*vars(layers.tables).values(), "full_bronze", "full_silver", *filter(None, vars(layers.full).values())):
        spark.sql(f"DROP TABLE IF EXISTS {table}")


def steady(day, value=10.0):
    """Readings through a day, on window edges and off them, with a little spread."""
    return [(day * DAY + s, value + s % 7) for s in (0, 100, 300, 3600, 40_000, 86_100, 86_399)]


def test_only_the_days_of_a_load_change(spark, layers):
    layers.load("first", [row for day in range(4) for row in steady(day)] + [(None, 11.0)])
    assert len(layers.follow()) == 6  # the last window of day 3 ends on day 4
    before = {table: layers.files(table) for table in (layers.tables.silver, layers.tables.flagged, layers.tables.device_stats)}
    layers.load("second", steady(6))
    changed = layers.follow()
    assert changed == ["1970-01-07", "1970-01-08"]
    for table, old in before.items():
        new = layers.files(table)
        assert {name: time for name, time in new.items() if name in old} == old
        assert all("event_day=1970-01-07" in name for name in new.keys() - old.keys())
    layers.check()
    assert layers.follow() == []
    assert column(spark.read.table(layers.tables.ledger), "load_id") == ["first", "second"]


def test_a_window_that_ends_at_midnight_reaches_the_next_day(spark, layers):
    layers.load("first", [(DAY, 10.0), (DAY + 10, 11.0), (3 * DAY, 12.0)])
    layers.follow()
    assert spark.read.table(layers.tables.silver).count() == 3
    layers.load("second", [(DAY - 1, 50.0)])
    assert layers.follow() == ["1970-01-01", "1970-01-02"]
    edge = spark.read.table(layers.tables.silver).where(F.col("event_time") == F.timestamp_seconds(F.lit(DAY)))
    assert column(edge, "avg_temp_5min") == [10.5, 50.0]
    layers.check()


def test_a_moved_baseline_flags_other_days_anew(spark, layers):
    """A value that is off by little counts as an anomaly until larger ones come."""
    quiet = [(day * DAY + s, 10.0 + s % 3) for day in range(3) for s in range(0, 30_000, 900)]
    layers.load("first", [*quiet, (DAY + 77, 20.0)])
    layers.follow()
    assert column(spark.read.table(layers.tables.anomaly_log), "temp_value") == [20.0]
    layers.load("second", [(9 * DAY + 9, 500.0)])
    assert layers.follow() == ["1970-01-02", "1970-01-10"]
    assert column(spark.read.table(layers.tables.anomaly_log), "temp_value") == [500.0]
    layers.check()


def test_a_nan_flags_all_days_anew(spark, layers):
    layers.load("first", [*steady(0), *steady(2), (DAY, 9999.0)])
    layers.follow()
    layers.load("second", [(5 * DAY, "NaN")])
    assert layers.follow() == ["1970-01-01", "1970-01-02", "1970-01-03", "1970-01-06"]
    assert spark.read.table(layers.tables.anomaly_log).count() == 0


def test_a_refresh_that_fails_is_run_again(spark, layers, monkeypatch):
    layers.load("first", steady(0))
    layers.follow()
    layers.load("second", [*steady(0, 30.0), *steady(1)])

    def fail(*args):
        raise RuntimeError("lost")

    for name in ("_flag_days", "write_run"):
        with monkeypatch.context() as patch:
            patch.setattr(incremental, name, fail)
            with pytest.raises(RuntimeError, match="lost"):
                layers.follow()
    layers.follow()
    layers.check()
    assert layers.follow() == []


def test_late_readings_and_missing_times(spark, layers):
    layers.load("a", [(None, 1.0), (0, 2.0), (299, 3.0), (-1, 4.0), (253402300800000, 5.0)])
    layers.follow()
    layers.load("b", [(None, 2.0), (150, 9.0), (300, 9.0)])
    layers.load("empty", [(7, -1.0)])
    layers.follow()
    layers.check()
