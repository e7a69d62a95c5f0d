"""Table and file sinks that can be run again without doubling rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def to_json_lines(df: DataFrame) -> DataFrame:
    """One JSON object per row in a ``value`` column; missing values stay as null."""
    record = F.struct(*(F.col(name) for name in df.columns))
    return df.select(F.to_json(record, {"ignoreNullFields": "false"}).alias("value"))


def write_json_lines(df: DataFrame, path: str, mode: str = "error") -> None:
    to_json_lines(df).write.mode(mode).text(path)


def merge_columns(df: DataFrame, existing: DataFrame) -> DataFrame:
    """Give ``df`` the columns of ``existing`` first, then its own new ones."""
    types = {field.name: field.dataType for field in existing.schema.fields}
    own = {field.name: field.dataType for field in df.schema.fields}
    changed = sorted(name for name in own if name in types and types[name] != own[name])
    if changed:
        raise ValueError(f"columns change their type: {changed}")
    kept = [
        F.col(name) if name in own else F.lit(None).cast(data_type).alias(name)
        for name, data_type in types.items()
    ]
    return df.select(*kept, *(name for name in df.columns if name not in types))


def overwrite_table(
    df: DataFrame,
    name: str,
    *,
    partition_by: tuple[str, ...] = (),
    merge_schema: bool = True,
    fmt: str = "parquet",
) -> None:
    """Replace a table; columns it had before survive as NULL."""
    spark = df.sparkSession
    if merge_schema and spark.catalog.tableExists(name):
        df = merge_columns(df, spark.read.table(name))
    df.write.mode("overwrite").partitionBy(*partition_by).saveAsTable(name, format=fmt)


def write_days(df: DataFrame, name: str, days: list[str], day_column: str = "event_day") -> None:
    """Put the rows of whole days into a log table in place of what it had for them.

    ``days`` are all days that were computed anew, also those without a row now; rows of
    other days stay. So a run over all of history logs nothing twice.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(name):
        df.write.partitionBy(day_column).saveAsTable(name, format="parquet")
        return
    columns = spark.read.table(name).columns
    if set(columns) != set(df.columns):
        raise ValueError(f"{name} has columns {columns}, not {df.columns}")
    there = {row[0] for row in df.select(day_column).distinct().collect()}
    stored = {row[0] for row in spark.read.table(name).select(day_column).distinct().collect()}
    mode = "spark.sql.sources.partitionOverwriteMode"  # an insert takes no option for it
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        df.select(*columns).write.mode("overwrite").insertInto(name)
    finally:
        spark.conf.set(mode, before)
    for day in sorted(stored & set(days) - there):
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({day_column} = '{day}')")


def write_run(df: DataFrame, name: str, run_id: str, run_column: str = "run_id") -> None:
    """Add one run's rows to a log table; the same run again replaces its rows."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(name):
        rows = df.withColumn(run_column, F.lit(run_id))
        rows.write.partitionBy(run_column).saveAsTable(name, format="parquet")
        return
    columns = [column for column in spark.read.table(name).columns if column != run_column]
    if set(columns) != set(df.columns):
        raise ValueError(f"{name} has columns {columns}, not {df.columns}")
    spark.sql(
        f"INSERT OVERWRITE TABLE {name} PARTITION ({run_column} = {{run_id}})"
        " SELECT * FROM {rows}",
        run_id=run_id,
        rows=df.select(*columns),
    )


def write_run_path(df: DataFrame, path: str, run_id: str, run_column: str = "run_id") -> None:
    """The same for a folder: only the partition of this run is replaced."""
    (
        df.withColumn(run_column, F.lit(run_id))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(run_column)
        .parquet(path)
    )


def counted(df: DataFrame, label: str) -> tuple[DataFrame, Observation]:
    """Count rows while they are written, which saves the extra count job."""
    observation = Observation(label)
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation
