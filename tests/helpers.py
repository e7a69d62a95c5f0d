"""Small frames for tests."""

import tracemalloc
from types import SimpleNamespace

from pyspark.sql import functions as F

from tidegauge.schema import METRICS, RAW_SCHEMA

OTHERS = ("1", "1", "1", "1")


def raw(spark, rows):
    """Raw readings from (time, temperature) pairs, the other metrics 1."""
    return spark.createDataFrame(
        [(time, temperature, *OTHERS) for time, temperature in rows], RAW_SCHEMA
    )


def clean(spark, rows):
    """Clean readings from (epoch seconds, temperature) pairs, the other metrics 1."""
    frame = spark.createDataFrame(rows, "s bigint, temperature double")
    return frame.select(
        F.col("s").cast("string").alias("time"),
        "temperature",
        *(F.lit(1.0).alias(metric) for metric in METRICS[1:]),
        F.timestamp_seconds("s").alias("event_time"),
    )


def values(df, *columns):
    """Rows as sorted tuples, NULL last."""
    rows = [tuple(row) for row in (df.select(*columns) if columns else df).collect()]
    return sorted(rows, key=lambda row: tuple((value is None, value) for value in row))


def column(df, name):
    return [row[0] for row in values(df, name)]


def epoch(name):
    return F.unix_seconds(name).alias(name)


def peak_mb(use):
    """The most memory that Python and numpy hold at once while ``use`` runs."""
    tracemalloc.start()
    try:
        use()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def arrow_step(spark, step):
    """What ``step`` runs on the Arrow batches of the frame that it is given."""
    frame = SimpleNamespace(sparkSession=spark, mapInArrow=lambda run, schema: run)
    frame.select = lambda *columns: frame
    return step(frame)


def plan(df):
    """The formatted physical plan."""
    execution = df._jdf.queryExecution()
    return df.sparkSession._jvm.PythonSQLUtils.explainString(execution, "formatted")
