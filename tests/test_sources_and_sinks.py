import gzip
import json
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.helpers import column, raw, values
from tidegauge.plans.ingest import convert_drop, load_bronze
from tidegauge.schema import RAW_COLUMNS, RAW_SCHEMA
from tidegauge.sinks import tables
from tidegauge.sources import files
from tidegauge.sources.event_readings import readings_from_events
from tidegauge.sources.workspace import Scratch, ending_scratch, materialize, shared_folder

HEADER = ",".join(RAW_COLUMNS) + "\n"


def write(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text)
    return str(folder)


def test_raw_schema():
    assert RAW_SCHEMA.names == list(RAW_COLUMNS)
    assert {field.dataType for field in RAW_SCHEMA} == {T.StringType()}


def test_csv_drop(spark, tmp_path):
    body = '0,1.50,2,3,4,5\n1,a\n\n2,1,2,3,4,5,extra\n3,"x\ny",2,3,4,5\n'
    path = write(tmp_path / "csv", "a.csv", HEADER + body)
    rows = values(files.read_csv_drop(spark, path), "Time", "Temperature", "Loudness")
    assert rows == [("0", "1.50", "5"), ("1", "a", None), ("2", "1", "5"), ("3", "x\ny", "5")]


def test_csv_columns_are_found_by_name(spark, tmp_path):
    folder = tmp_path / "csv"
    write(folder, "a.csv", HEADER + "0,1,2,3,4,5\n")
    write(folder, "b c.csv", "Temperature,Time,Battery,Humidity,Air_Quality,Light\n1,2,full,3,4,5\n")
    write(folder, "odd.csv", "x,y\n1,2\n")
    write(folder, "twice.csv", "Time,Time\n1,2\n")
    path = write(folder, "empty.csv", "")
    rows = values(files.read_csv_drop(spark, path, extras=True), "Time", "Temperature", "Loudness", "_extra")
    assert rows == [("0", "1", "5", None), ("2", "1", None, '{"Battery":"full"}')]
    assert [name.rsplit("/", 1)[1] for name in files.odd_csv_files(spark, path)] == ["odd.csv", "twice.csv"]
    assert files.read_csv_drop(spark, path).columns == list(RAW_COLUMNS)


def test_no_field_of_a_csv_row_is_lost(spark, tmp_path):
    path = write(tmp_path / "csv", "a.csv", HEADER + "0,1,2,3,4,5\n1,2\n2,1,2,3,4,5,more\n")
    rows = files.read_csv_drop(spark, path, extras=True)
    assert values(rows, "Time", "_corrupt_record") == [("0", None), ("1", "1,2"), ("2", "2,1,2,3,4,5,more")]


def test_drop_without_a_readable_file(spark, tmp_path):
    path = write(tmp_path / "csv", "a.csv", "x,y\n1,2\n")
    assert files.read_csv_drop(spark, path).collect() == []


def test_json_lines_in_nested_folders(spark, tmp_path):
    write(tmp_path / "json" / "2025" / "08", "a.json", '{"Time":"1"}\n')
    path = str(tmp_path / "json")
    assert column(files.read_json_lines(spark, path), "Time") == ["1"]
    assert load_bronze(spark, path, str(tmp_path / "bronze")) == 1
    assert load_bronze(spark, path, str(tmp_path / "bronze")) == 1
    assert files.bronze_records(spark.read.parquet(str(tmp_path / "bronze"))).count() == 1


def test_rows_per_file(spark, tmp_path):
    folder = tmp_path / "csv"
    write(folder, "a b.csv", HEADER + "0,1,1,1,1,1\n" * 12)
    path = write(folder, "c.csv", HEADER + "0,1,1,1,1,1\n" * 3)
    counts = files.count_rows_per_file(files.read_csv_drop(spark, path))
    names = counts.select(files.decode_key(F.regexp_extract("source_file", "[^/]+$", 0)).alias("f"), "records")
    assert values(names) == [("a b.csv", 12), ("c.csv", 3)]
    assert values(files.summarize_ingest(counts)) == [(2, 15)]


def test_convert_drop(spark, tmp_path):
    folder = tmp_path / "csv"
    write(folder, "a.csv", HEADER + "0,1,1,1,1,1\n" * 2)
    path = write(folder, "b.csv", HEADER + "1,1,1,1,1\n")
    target = str(tmp_path / "json")
    assert convert_drop(spark, path, target) == 3
    good = files.good_records(files.read_json_lines(spark, target))
    assert values(good, "Time", "Loudness") == [("0", "1"), ("0", "1"), ("1", None)]


def test_every_column_of_a_drop_is_converted(spark, tmp_path):
    """Extra columns, files without a known one, names that repeat, rows with more fields."""
    folder = tmp_path / "csv"
    write(folder, "a.csv", HEADER.strip() + ",Battery,my key\n0,1,1,1,1,1,low,\n")
    write(folder, "b.csv", "Battery,Volt\nhigh,3\n")
    write(folder, "c.csv", "Time,Time\n1,2\n")
    write(folder, "empty.csv", "\n \n")
    path = write(folder, "d.csv", "\ufeffTime,Light\n5,6,more\n7\n")
    target = str(tmp_path / "json")
    assert convert_drop(spark, path, target) == 5
    lines = [json.loads(row.value) for row in spark.read.text(target).collect()]
    assert sorted(map(str, lines)) == sorted(
        map(
            str,
            [
                {**dict.fromkeys(RAW_COLUMNS, "1"), "Time": "0", "Battery": "low", "my key": None},
                {"Battery": "high", "Volt": "3"},
                {"Time": "2"},
                {"Time": "5", "Light": "6", "_corrupt_record": "5,6,more"},
                {"Time": "7", "Light": None, "_corrupt_record": "7"},
            ],
        )
    )


def test_headers_come_from_the_beginning_of_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "HEAD_BYTES", 8)
    folder = tmp_path / "csv"
    write(folder / "x=1", "long.csv", "\n\n" + HEADER + "0,1,2,3,4,5\n")
    write(folder, "no line break.csv", "Time,é")
    (folder / "packed.csv.gz").write_bytes(gzip.compress((HEADER + "1,1,1,1,1,1\n").encode()))
    headers = files.csv_headers(spark, str(folder))
    names = {header: sorted(name.rsplit("/", 1)[1] for name in paths) for header, paths in headers.items()}
    assert names == {HEADER.strip(): ["long.csv", "packed.csv.gz"], "Time,é": ["no line break.csv"]}
    assert column(files.read_csv_drop(spark, str(folder)), "Time") == ["0", "1"]


def test_lines_of_odd_files(spark, tmp_path):
    folder = tmp_path / "csv"
    write(folder, "a.csv", HEADER + "0,1,1,1,1,1\n")
    path = write(folder, "odd.csv", "x\n1\n")
    lines = files.odd_csv_lines(spark, path)
    assert column(lines, "_corrupt_record") == ["1", "x"]
    assert {name.rsplit("/", 1)[1] for name in column(lines, "source_file")} == {"odd.csv"}
    write(tmp_path / "fine", "a.csv", HEADER)
    assert files.odd_csv_lines(spark, str(tmp_path / "fine")).collect() == []


def test_decode_key(spark):
    frame = spark.createDataFrame([("a+b%2Fc%20d",), ("%zz",), ("100%",), ("%41%4",)], "k string")
    assert column(frame.select(files.decode_key(F.col("k")).alias("k")), "k") == ["%zz", "100%", "A%4", "a b/c d"]


JSON_LINES = "\n".join(
    [
        '{"Time":"0","Temperature":"1.5","Humidity":"2"}',
        "{bad json",
        '{"Time":"1","Temperature":23.10,"humidity":"9","extra":1}',
        '{"Time":"2","Temperature":{"a":1}}',
    ]
)


def test_json_lines(spark, tmp_path):
    path = write(tmp_path / "json", "a.json", JSON_LINES)
    good = files.good_records(files.read_json_lines(spark, path))
    assert values(good, "Time", "Temperature", "Humidity") == [
        ("0", "1.5", "2"),
        ("1", "23.10", None),
        ("2", '{"a":1}', None),
    ]


def test_bronze_keeps_bad_lines_apart(spark, tmp_path):
    path = write(tmp_path / "json", "a.json", JSON_LINES)
    target = str(tmp_path / "bronze")
    files.write_bronze(files.read_json_lines(spark, path), target, "one")
    stored = spark.read.parquet(target)
    assert column(files.bronze_records(stored), "Time") == ["0", "1", "2"]
    assert column(files.quarantined_lines(stored), "line") == ["{bad json"]
    assert files.bronze_records(stored).columns == list(RAW_COLUMNS)


def test_load_table(spark):
    assert files.load_table_if_present(spark, "no_such_table") is None
    with pytest.raises(AnalysisException):
        files.load_table(spark, "no_such_table").collect()


def test_json_lines_keep_nulls(spark, tmp_path):
    frame = raw(spark, [("0", "1"), (None, None)])
    lines = column(tables.to_json_lines(frame), "value")
    assert '"Time":null,"Temperature":null' in lines[0] + lines[1]
    path = str(tmp_path / "out")
    tables.write_json_lines(frame, path)
    assert values(files.good_records(files.read_json_lines(spark, path))) == values(frame)


def test_every_event_becomes_a_reading(spark, small):
    events = spark.read.parquet(f"{small}/events.parquet")
    assert readings_from_events(events).count() == events.count()


def test_overwrite_merges_columns(spark):
    tables.overwrite_table(spark.createDataFrame([(1, "x")], "a int, b string"), "merged")
    tables.overwrite_table(spark.createDataFrame([(2, 0.5)], "a int, c double"), "merged")
    stored = spark.read.table("merged")
    assert stored.columns == ["a", "b", "c"]
    assert values(stored) == [(2, None, 0.5)]
    with pytest.raises(ValueError, match="type"):
        tables.overwrite_table(spark.createDataFrame([("x",)], "a string"), "merged")
    spark.sql("DROP TABLE merged")


def test_write_run_replaces_only_its_run(spark):
    one = spark.createDataFrame([(1,), (2,)], "v int")
    for run, frame in (("a", one), ("b", one), ("a", one.filter("v = 1"))):
        tables.write_run(frame, "runs", run)
    with pytest.raises(ValueError, match="columns"):
        tables.write_run(one.withColumn("w", F.lit(1)), "runs", "c")
    assert values(spark.read.table("runs"), "run_id", "v") == [("a", 1), ("b", 1), ("b", 2)]
    spark.sql("DROP TABLE runs")


def test_counted_counts_while_writing(spark, tmp_path):
    frame, seen = tables.counted(spark.range(7).toDF("v"), "seven")
    frame.write.parquet(str(tmp_path / "out"))
    assert seen.get["rows"] == 7


def test_materialize_uses_the_shared_folder(spark):
    frame = materialize(spark.range(3).toDF("v"), "test")
    assert column(frame, "v") == [0, 1, 2]
    assert shared_folder(spark) in frame.inputFiles()[0]
    assert "Range" not in frame._jdf.queryExecution().executedPlan().toString()


def test_days_of_a_log_are_replaced(spark):
    def rows(*pairs):
        return spark.createDataFrame(pairs, "v int, event_day string")

    tables.write_days(rows((1, "a"), (2, "b"), (3, "none")), "day_log", ["a", "b", "none"])
    tables.write_days(rows((1, "a"), (4, "c")), "day_log", ["a", "c", "none"])
    assert values(spark.read.table("day_log"), "event_day", "v") == [("a", 1), ("b", 2), ("c", 4)]
    with pytest.raises(ValueError, match="columns"):
        tables.write_days(rows((1, "a")).withColumn("w", F.lit(1)), "day_log", ["a"])
    spark.sql("DROP TABLE day_log")


def test_scratch_made_inside_ends(spark):
    outer = Scratch(spark, "outer")
    outer.table(spark.range(1).toDF("v"), "a")
    with ending_scratch():
        folder = Scratch(spark, "inner").folder
        materialize(spark.range(1).toDF("v"), "made")
    assert Path(outer.folder).exists() and not Path(folder).exists()
    outer.close()


def test_scratch_tables_end(spark):
    scratch = Scratch(spark, "ending")
    frame = scratch.table(spark.range(3).toDF("v"), "a")
    assert frame.count() == 3 and Path(scratch.folder, "a").exists()
    scratch.drop("a")
    assert not Path(scratch.folder, "a").exists()
    scratch.table(spark.range(3).toDF("v"), "b")
    scratch.close()
    assert not Path(scratch.folder).exists()
