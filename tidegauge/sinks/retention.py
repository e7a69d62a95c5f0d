"""Dropping stored days that are older than a limit, with a record of what went."""

from __future__ import annotations

import datetime as dt
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession

from tidegauge.sinks.tables import write_run
from tidegauge.sources.workspace import remove_path

AUDIT_SCHEMA = "target string, day string, first_kept string"


def expired_days(days: list[str], keep_days: int, now: dt.datetime) -> tuple[list[str], str]:
    """Those of ``days`` before the first day that is kept, and that day.

    ``now`` without a zone is UTC. A day on which some reading is young enough is kept,
    and so is what is no date, such as the day of readings without a time.
    """
    if keep_days < 0:
        raise ValueError(f"keep_days must not be negative, not {keep_days}")
    now = now.replace(tzinfo=dt.timezone.utc) if now.tzinfo is None else now.astimezone(dt.timezone.utc)
    first = (now - dt.timedelta(days=keep_days)).date().isoformat()
    dates = [day for day in days if _is_date(day)]
    return sorted(day for day in dates if day < first), first


def _is_date(day: str) -> bool:
    try:
        return dt.date.fromisoformat(day).isoformat() == day
    except ValueError:
        return False


def expire_table(
    spark: SparkSession,
    name: str,
    keep_days: int,
    now: dt.datetime,
    audit: str | None = None,
    day_column: str = "event_day",
) -> list[str]:
    """Drop the partitions of old days of a table; returns the days.

    Only the catalog is asked which days there are, so nothing is read, and the files of
    other days stay as they are. ``audit`` names a table that gets a row per dropped day;
    it is written first, so every day that is gone is in it, and a run that fails is run
    again. Other partition columns next to the day are dropped along.
    """
    partitions = [_partition(row[0]) for row in spark.sql(f"SHOW PARTITIONS {name}").collect()]
    days, first = expired_days(sorted({spec[day_column] for spec in partitions}), keep_days, now)
    _note(spark, audit, name, days, first)
    for spec in partitions:
        if spec[day_column] in days:
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({_literals(spec)})")
    return days


def _partition(text: str) -> dict[str, str]:
    """The columns and values of a partition as it is listed."""
    parts = (part.split("=", 1) for part in text.split("/"))
    return {column: unquote(value) for column, value in parts}


def _literals(spec: dict[str, str]) -> str:
    escaped = {column: value.replace("\\", "\\\\").replace("'", "\\'") for column, value in spec.items()}
    return ", ".join(f"`{column}` = '{value}'" for column, value in escaped.items())


def expire_folder(
    spark: SparkSession,
    path: str,
    keep_days: int,
    now: dt.datetime,
    audit: str | None = None,
    day_column: str = "day",
) -> list[str]:
    """The same for a folder that is partitioned by day at its top."""
    days, first = expired_days(_folder_days(spark, path, day_column), keep_days, now)
    _note(spark, audit, path, days, first)
    for day in days:
        remove_path(spark, f"{path}/{day_column}={day}")
    return days


def _folder_days(spark: SparkSession, path: str, day_column: str) -> list[str]:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [status.getPath().getName() for status in system.listStatus(where) if status.isDirectory()]
    prefix = f"{day_column}="
    return [name.removeprefix(prefix) for name in names if name.startswith(prefix)]


def _note(spark: SparkSession, audit: str | None, target: str, days: list[str], first: str) -> None:
    if audit is not None and days:
        rows: DataFrame = spark.createDataFrame([(target, day, first) for day in days], AUDIT_SCHEMA)
        write_run(rows, audit, f"{target.rsplit('/', 1)[-1]} {first}")
