"""Getting drops of files into the raw layer as a batch."""

from __future__ import annotations

import hashlib

from pyspark.sql import SparkSession

from tidegauge.sinks.tables import counted
from tidegauge.sources.files import read_csv_as_json, read_json_lines, write_bronze


def convert_drop(spark: SparkSession, csv_path: str, json_path: str) -> int:
    """CSV drop folder to JSON lines; returns the number of records.

    Each row becomes one object with all columns of its file's header, whatever they are,
    so no file and no column is left out.
    """
    rows, seen = counted(read_csv_as_json(spark, csv_path), "convert_drop")
    rows.write.text(json_path)
    return seen.get["rows"]


def load_bronze(spark: SparkSession, json_path: str, bronze_path: str, load_id: str | None = None) -> int:
    """Add a folder of JSON lines to the raw layer; returns the number of lines.

    Loading the same folder, or with the same ``load_id``, again replaces its rows.
    """
    lines, seen = counted(read_json_lines(spark, json_path), "load_bronze")
    name = load_id or hashlib.sha256(json_path.rstrip("/").encode()).hexdigest()[:16]
    write_bronze(lines, bronze_path, name)
    return seen.get["rows"]
