"""Windows held as streaming state and healed windows, against the batch operator."""

import json

import pytest
from pyspark.sql import functions as F

from tests.helpers import epoch, values
from tidegauge.operators.cleaning import clean_readings
from tidegauge.operators.windows import tumbling_averages
from tidegauge.schema import CORRUPT, METRICS, RAW_COLUMNS, window_average
from tidegauge.sources.files import bronze_records
from tidegauge.streaming import bronze, rollup

AVERAGES = [window_average(metric) for metric in METRICS]


class Live:
    """A feed, its raw layer and its rollup."""

    def __init__(self, spark, root):
        self.spark, self.root, self.files = spark, root, 0
        (root / "source").mkdir()
        self.folders = rollup.RollupFolders.below(str(root / "rollup"))

    def run(self, rows):
        """One more file of ``time, temperature``; returns the stream's state rows."""
        self.files += 1
        lines = (json.dumps(dict(zip(RAW_COLUMNS, (str(t), str(x), "1", "1", "1", "1")))) for t, x in rows)
        (self.root / "source" / f"{self.files}.json").write_text("\n".join(lines) + "\n")
        stream = bronze.stream_json_lines(self.spark, str(self.root / "source"))
        store = bronze.start_bronze(
            stream, checkpoint=str(self.root / "c1"), path=str(self.root / "bronze"), trigger=bronze.ONCE
        )
        store.awaitTermination()
        query = rollup.start_rollup(
            clean_readings(stream.drop(CORRUPT)), self.folders, checkpoint=str(self.root / "c2"), trigger=bronze.ONCE
        )
        query.awaitTermination()
        return [batch["stateOperators"][0]["numRowsTotal"] for batch in query.recentProgress]

    def stored(self):
        return clean_readings(bronze_records(self.spark.read.parquet(str(self.root / "bronze"))))

    def check(self):
        expected = tumbling_averages(self.stored())
        columns = ["window_start", "window_end", *AVERAGES, "readings"]
        found = rollup.rolled_up(rollup.all_windows(self.stored(), self.folders), 300)
        assert values(found, *columns) == values(expected, *columns)


@pytest.fixture
def live(spark, tmp_path):
    return Live(spark, tmp_path)


def late_rows(frame):
    return values(frame.select(epoch("window_start"), "counted", "stored", "late"))


def test_late_readings_are_healed(live):
    live.run([(0, 1.0), (299, 2.0), (300, 3.0), (4000, 4.0)])
    live.run([(5000, 5.0)])
    assert late_rows(rollup.heal(live.stored(), live.folders, 0)) == []
    live.check()
    # one for a closed window, one for a window that never was in the state
    live.run([(10, 9.0), (900, 8.0), (9000, 7.0)])
    assert late_rows(rollup.heal(live.stored(), live.folders, 1)) == [(0, 2, 3, 1), (900, 0, 1, 1)]
    live.check()
    live.run([(11, 6.0), (20_000, 1.0)])
    for _ in range(2):  # the same run again replaces itself
        assert late_rows(rollup.heal(live.stored(), live.folders, 2)) == [(0, 3, 4, 1)]
    live.check()
    assert late_rows(rollup.heal(live.stored(), live.folders, 3)) == []
    live.check()


def test_only_windows_of_new_readings_are_looked_at(live):
    live.run([(0, 1.0), (5000, 2.0)])
    live.run([(9000, 2.0)])
    live.run([(1, 3.0), (5001, 4.0), (9001, 1.0)])
    arrived = live.stored().where(F.col("temperature") == 3.0)
    assert late_rows(rollup.heal(live.stored(), live.folders, 0, arrived=arrived)) == [(0, 1, 2, 1)]
    rollup.heal(live.stored(), live.folders, 1)
    live.check()


def test_a_stray_time_does_not_close_windows_or_fill_the_state(live):
    """One reading far ahead of the clock, then many windows: the state holds the open ones."""
    live.run([(0, 1.0), (99_999_999_999, 2.0)])
    most = 0
    for i in range(1, 9):
        most = max(most, *live.run([(3600 * i + s, float(s)) for s in range(0, 3600, 300)]))
    # twelve windows of an hour, and those that wait for ten minutes
    assert most <= 12 + 4
    late = late_rows(rollup.heal(live.stored(), live.folders, 0))
    assert late == [(99_999_999_900, 0, 1, 1)]
    live.check()


def test_wider_windows(live):
    live.run([(0, 1.0), (700, 4.0), (3599, 4.0), (3600, 9.0), (9000, 1.0)])
    live.run([(20_000, 2.0)])
    parts = rollup.all_windows(live.stored(), live.folders)
    expected = tumbling_averages(live.stored(), 3600)
    columns = ["window_start", "window_end", *AVERAGES, "readings"]
    assert values(rollup.rolled_up(parts, 3600), *columns) == values(expected, *columns)


def test_before_anything_is_closed(live):
    live.run([(0, 1.0), (300, 2.0)])
    assert late_rows(rollup.heal(live.stored(), live.folders, 0)) == []
    live.check()
