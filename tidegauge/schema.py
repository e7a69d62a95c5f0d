"""Column names, schemas and default settings shared by all layers."""

from __future__ import annotations

from pyspark.sql import types as T

# Names and settings that results must agree with.
RAW_COLUMNS = ("Time", "Temperature", "Humidity", "Air_Quality", "Light", "Loudness")
METRICS = ("temperature", "humidity", "air_quality", "light", "loudness")
SHORT_NAMES = {"temperature": "temp"}
SCORED_METRICS = ("temperature", "humidity")
SIGMAS = 3.0
FALLBACK_STD = 0.0001
AVERAGE_SECONDS = 5 * 60
ROLLUP_SECONDS = 60 * 60
RATE_SECONDS = 10 * 60
DECIMALS = 4
REPORT_ROWS = 20
ANOMALY_DETAILS = "Anomaly detected"
METRIC_NAMESPACE = "IoT/GoldLayer"
METRIC_TOTAL = "TotalAnomalies"
METRIC_RATE = "AnomalyRate_10min"
METRIC_UNIT = "Count"
METRIC_MAX_AGE_DAYS = 14
SENSOR_LIMITS = {"temperature": (-50.0, 100.0), "humidity": (0.0, 100.0)}

TIME = "event_time"
CORRUPT = "_corrupt_record"
QUARANTINED = "quarantined"
LOAD = "load_id"
EXTRA = "_extra"


def short(metric: str) -> str:
    """Name of a metric inside derived columns (``avg_temp``, ``temp_anomaly``)."""
    return SHORT_NAMES.get(metric, metric)


def window_average(metric: str) -> str:
    return f"avg_{short(metric)}_5min"


def rollup_average(metric: str) -> str:
    return f"avg_{short(metric)}"


def flag(metric: str) -> str:
    return f"{short(metric)}_anomaly"


OVERALL_FLAG = "overall_anomaly"

RAW_SCHEMA = T.StructType([T.StructField(name, T.StringType(), True) for name in RAW_COLUMNS])

CLEAN_COLUMNS = ("time", *METRICS, TIME)
SILVER_COLUMNS = (*CLEAN_COLUMNS, *(window_average(m) for m in METRICS))
FLAGGED_COLUMNS = (*SILVER_COLUMNS, *(flag(m) for m in SCORED_METRICS), OVERALL_FLAG)
ROLLUP_COLUMNS = (
    "window_start",
    "window_end",
    *(rollup_average(m) for m in METRICS),
    "total_anomalies",
)

DIMENSIONS_TYPE = T.ArrayType(
    T.StructType(
        [T.StructField("name", T.StringType()), T.StructField("value", T.StringType())]
    )
)
