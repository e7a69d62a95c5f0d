"""The registered queries as plain SQL for DuckDB, written apart from the operators.

The interval join is stated as the interval condition itself, the moving average
as a range frame, and the baseline as the direct aggregate over the joined rows.
"""

from __future__ import annotations

METRICS = ("temperature", "humidity", "air_quality", "light", "loudness")
SHORT = {"temperature": "temp"}


def _s(metric: str) -> str:
    return SHORT.get(metric, metric)


def _each(template: str, metrics: tuple[str, ...] = METRICS) -> str:
    return ", ".join(template.format(m=metric, s=_s(metric)) for metric in metrics)


def _round(expression: str, digits: int = 4) -> str:
    return f"CAST(round(CAST({expression} AS DECIMAL(28,8)), {digits}) AS DOUBLE)"


_RAW = """
raw AS (
  SELECT event_id, user_id, ts, event_type,
    CASE WHEN event_id % 103 <> 0
         THEN CAST(CAST(floor(epoch(ts)) AS BIGINT) AS VARCHAR) END AS time,
    CASE WHEN event_id % 101 = 0 THEN NULL
         WHEN event_id % 97 = 0 THEN '-1'
         WHEN event_id % 89 = 0 THEN 'bad'
         ELSE CAST(value AS VARCHAR) END AS temperature_text,
    CAST(pow(CAST(json_extract_string(props, '$.k') AS DOUBLE), 6) / 1e10 AS VARCHAR)
      AS humidity_text,
    CAST(user_id AS VARCHAR) AS air_quality_text,
    CAST(event_id % 1000 AS VARCHAR) AS light_text,
    CAST(sqrt(value) AS VARCHAR) AS loudness_text
  FROM events)"""

_TYPED = f"""
typed AS (
  SELECT event_id, user_id, ts, time, {_each("TRY_CAST({m}_text AS DOUBLE) AS {m}")},
    make_timestamp(TRY_CAST(time AS BIGINT) * 1000000) AS event_time
  FROM raw)"""

_VALID = " AND ".join(f"{metric} IS NOT NULL AND {metric} >= 0" for metric in METRICS)
_CLEAN = f"""
clean AS (SELECT * EXCLUDE (ts) FROM typed WHERE {_VALID})"""

_WIN = f"""
win AS (
  SELECT time_bucket(INTERVAL '5 minutes', event_time) AS window_start,
    time_bucket(INTERVAL '5 minutes', event_time) + INTERVAL '5 minutes' AS window_end,
    {_each("avg({m}) AS avg_{s}_5min")}, count(*) AS readings
  FROM clean WHERE event_time IS NOT NULL GROUP BY ALL)"""


def _joined(closing: str) -> str:
    return f"""
joined AS (
  SELECT clean.*, {_each("avg_{s}_5min")}
  FROM clean LEFT JOIN win
    ON event_time >= window_start AND event_time {closing} window_end)"""


_STATS = """
stats AS (
  SELECT coalesce(avg(temperature), 0) AS mean_temp,
    coalesce(nullif(stddev_samp(temperature), 0), 0.0001) AS std_temp,
    coalesce(avg(humidity), 0) AS mean_humidity,
    coalesce(nullif(stddev_samp(humidity), 0), 0.0001) AS std_humidity
  FROM joined)"""

_FLAGGED = """
marked AS (
  SELECT joined.*,
    CAST(CASE WHEN abs(temperature - (SELECT mean_temp FROM stats))
              > 3 * (SELECT std_temp FROM stats) THEN 1 ELSE 0 END AS INTEGER) AS temp_anomaly,
    CAST(CASE WHEN abs(humidity - (SELECT mean_humidity FROM stats))
              > 3 * (SELECT std_humidity FROM stats) THEN 1 ELSE 0 END AS INTEGER)
      AS humidity_anomaly
  FROM joined),
flagged AS (
  SELECT *, CAST(CASE WHEN temp_anomaly = 1 OR humidity_anomaly = 1 THEN 1 ELSE 0 END
                 AS INTEGER) AS overall_anomaly
  FROM marked)"""

_HOURLY = f"""
hourly AS (
  SELECT time_bucket(INTERVAL '1 hour', event_time) AS window_start,
    time_bucket(INTERVAL '1 hour', event_time) + INTERVAL '1 hour' AS window_end,
    {", ".join(f"{_round(f'avg({m})')} AS avg_{_s(m)}" for m in METRICS)},
    CAST(sum(overall_anomaly) AS BIGINT) AS total_anomalies
  FROM flagged WHERE event_time IS NOT NULL GROUP BY ALL)"""

_RATE = """
rate AS (
  SELECT time_bucket(INTERVAL '10 minutes', event_time) AS window_start,
    time_bucket(INTERVAL '10 minutes', event_time) + INTERVAL '10 minutes' AS window_end,
    count(*) AS anomaly_count
  FROM flagged WHERE overall_anomaly = 1 AND event_time IS NOT NULL GROUP BY ALL)"""

_LOG = """
log AS (
  SELECT round(temperature, 4) AS temp_value, round(humidity, 4) AS humidity_value,
    event_time AS detected_at, 'Anomaly detected' AS details
  FROM flagged WHERE overall_anomaly = 1)"""

_TO_CLEAN = (_RAW, _TYPED, _CLEAN)
_TO_JOINED = (*_TO_CLEAN, _WIN, _joined("<="))
_TO_FLAGGED = (*_TO_JOINED, _STATS, _FLAGGED)
_TO_GOLD = (*_TO_FLAGGED, _HOURLY, _RATE, _LOG)


def _sql(steps: tuple[str, ...], select: str) -> str:
    return "WITH " + ",".join(steps) + "\n" + select


_MIXED = (
    f"time, {_each('{m}', METRICS[:-1])},"
    " CASE WHEN event_id % 3 <> 2 THEN loudness END AS loudness,"
    " CASE WHEN event_id % 3 = 1 THEN 'b,' || event_id END AS battery"
)
_MEDIANS = f"""
overall AS (SELECT {_each("quantile_disc({m}, 0.5) AS median_{s}", METRICS[:2])} FROM clean),
by_user AS (SELECT user_id, {_each("quantile_disc({m}, 0.5) AS median_{s}", METRICS[:2])} FROM clean GROUP BY user_id)"""
_ROBUST = "count(*) AS readings, " + _each(
    "min(median_{s}) AS median_{s}, quantile_disc(abs({m} - median_{s}), 0.5) AS mad_{s}", METRICS[:2]
)
_SESSIONS = """
begun AS (
  SELECT *, CASE WHEN event_time - lag(event_time) OVER w < INTERVAL '30 minutes' THEN 0 ELSE 1 END AS new
  FROM clean WHERE event_time IS NOT NULL WINDOW w AS (PARTITION BY user_id ORDER BY event_time)),
sessions AS (
  SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY event_time) AS session FROM begun)"""
_SESSION_ROWS = (
    "SELECT user_id, min(event_time) AS session_start, max(event_time) + INTERVAL '30 minutes' AS session_end,"
    f" count(*) AS readings, {', '.join(f'{_round(f'avg({m})')} AS avg_{_s(m)}' for m in METRICS)}"
    " FROM sessions GROUP BY user_id, session"
)
_HOURS_AND_DAYS = """
dated AS (
  SELECT *, date_trunc('hour', event_time) AS hour, CAST(date_trunc('day', event_time) AS TIMESTAMP) AS day
  FROM flagged)"""
_TYPED_VALUES = f"SELECT time, {_each('{m}')} FROM typed"
_AVERAGES_5MIN = ", ".join(f"{_round(f'avg_{_s(m)}_5min')} AS avg_{_s(m)}_5min" for m in METRICS)
_SILVER = f"""
  SELECT event_id, time, {_each("{m}")}, event_time, {_AVERAGES_5MIN}"""
_BASELINE = (
    f"SELECT {_round('mean_temp')} AS mean_temp, {_round('std_temp')} AS std_temp,"
    f" {_round('mean_humidity')} AS mean_humidity, {_round('std_humidity')} AS std_humidity"
    " FROM stats"
)
_IF_GOOD = "CASE WHEN raw.temperature_text <> 'bad' OR raw.temperature_text IS NULL THEN typed.{m} END AS {m}"
_GOOD_AND_BAD = (
    "SELECT CASE WHEN raw.temperature_text = 'bad' THEN 'bad' ELSE 'good' END AS kind, "
    + ", ".join(_IF_GOOD.format(m=m) for m in ("time", *METRICS) if m != "light")
    + ", typed.light FROM raw JOIN typed USING (event_id)"
)
_BROKEN = "CASE WHEN event_id % 2 = 0 THEN '%zz-100%' ELSE '' END"
_HOURLY_ROWS = "SELECT * FROM hourly"
_REASONS = ", ".join(
    f"CASE WHEN {m} IS NULL THEN '{m} missing' WHEN {m} < 0 THEN '{m} below 0' END"
    for m in METRICS
)


def _rolling(interval: str, partition: str = "", metric: str = "{m}") -> str:
    frame = (
        f"({partition} ORDER BY event_time"
        f" RANGE BETWEEN INTERVAL '{interval}' PRECEDING AND CURRENT ROW)"
    )
    average = _round(f"avg({metric}) OVER {frame}")
    return f"CASE WHEN event_time IS NOT NULL THEN {average} END"


def _dq(check: str, target: str, bad: str, source: str) -> str:
    return (
        f"SELECT '{check}' AS \"check\", '{target}' AS target, bad_rows,"
        " CASE WHEN bad_rows = 0 THEN 'passed' ELSE 'failed' END AS status"
        f" FROM (SELECT CAST({bad} AS BIGINT) AS bad_rows FROM {source})"
    )


_DQ_RANGES = (
    ("temperature_range", "count(*) FILTER (temperature < -50 OR temperature > 100)"),
    ("humidity_range", "count(*) FILTER (humidity < 0 OR humidity > 100)"),
)
_DQ_FLAGS = (
    "count(*) FILTER (temp_anomaly NOT IN (0, 1) OR humidity_anomaly NOT IN (0, 1)"
    " OR overall_anomaly NOT IN (0, 1))"
)
_EMPTY = "CASE WHEN count(*) = 0 THEN 1 ELSE 0 END"


def _repeats(key: str, source: str) -> str:
    return f"(SELECT {key} FROM {source} GROUP BY ALL HAVING count(*) > 1)"


def _copies(columns: str, source: str) -> str:
    return f"(SELECT count(*) - 1 AS n FROM {source} GROUP BY {columns})"


_WHOLE_SILVER = (
    f"user_id, time, {_each('{m}')}, event_time, {_each('avg_{s}_5min')}"
)
_WHOLE_FLAGGED = (
    f"time, {_each('{m}')}, event_time, {_each('avg_{s}_5min')},"
    " temp_anomaly, humidity_anomaly, overall_anomaly"
)
_UNION = "\nUNION ALL\n"
_ALL_CHECKS = _UNION.join(
    (
        _dq("row_count", "flagged", _EMPTY, "flagged"),
        _dq("schema_columns", "flagged", "0", "stats"),
        _dq("anomaly_flags", "flagged", _DQ_FLAGS, "flagged"),
        *(_dq(check, "flagged", bad, "flagged") for check, bad in _DQ_RANGES),
        _dq("duplicate_rows", "flagged", "sum(n)", _copies(_WHOLE_FLAGGED, "flagged")),
        _dq("row_count", "device_stats", _EMPTY, "hourly"),
        _dq("schema_columns", "device_stats", "0", "stats"),
        _dq("duplicate_rows", "device_stats", "sum(n)", _copies("hourly", "hourly")),
        "SELECT 'anomaly_flags', 'device_stats', NULL, 'error'",
        _dq("unique_window", "device_stats", "count(*)", _repeats("window_start", "hourly")),
        "SELECT 'row_count', 'missing_table', NULL, 'skipped'",
    )
)

_PAIRS = tuple((x, y) for x in METRICS for y in METRICS)


def _correlation(x: str, y: str) -> str:
    value = f"corr({x}, {y})"
    clean = f"CASE WHEN isnan({value}) THEN NULL ELSE {value} END"
    return f"SELECT '{x}' AS metric_x, '{y}' AS metric_y, {_round(clean, 6)} AS corr FROM joined"


_CLAMP = (
    "CASE WHEN {t} < TIMESTAMP '2024-01-22' - INTERVAL 14 DAYS"
    " THEN TIMESTAMP '2024-01-22' - INTERVAL 14 DAYS + INTERVAL 1 SECOND"
    " WHEN {t} <= TIMESTAMP '2024-01-22' THEN {t}"
    " ELSE TIMESTAMP '2024-01-22' END"
)


def _metric(name: str, value: str, source: str) -> str:
    return (
        f"SELECT 'IoT/GoldLayer' AS namespace, '{name}' AS metric_name, '[]' AS dimensions,"
        f" {_CLAMP.format(t='window_start')} AS \"timestamp\", CAST({value} AS DOUBLE) AS value,"
        f" 'Count' AS unit FROM {source}"
    )


_FIRST_20 = " ORDER BY window_start LIMIT 20"

ORACLE: dict[str, str] = {
    "device_stats": _sql(_TO_GOLD, _HOURLY_ROWS),
    "device_stats_from_summary": _sql(_TO_GOLD, _HOURLY_ROWS),
    "ingest_csv": _sql((_RAW, _TYPED), _TYPED_VALUES),
    "ingest_file_counts": (
        "SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS records FROM events GROUP BY ALL"
    ),
    "ingest_summary": "SELECT CAST(1 AS INTEGER) AS has_files, count(*) AS records FROM events",
    "decode_keys": (
        "SELECT event_id, concat_ws('/', 'drop a+b', event_type, props, event_id)"
        f" || {_BROKEN} AS object_key FROM events"
    ),
    "csv_to_json_lines": _sql((_RAW, _TYPED), _TYPED_VALUES),
    "bronze_read": _sql((_RAW, _TYPED), _TYPED_VALUES),
    "bronze_read_nested": _sql((_RAW, _TYPED), _TYPED_VALUES),
    "load_twice": _sql((_RAW, _TYPED), _TYPED_VALUES),
    "ingest_csv_mixed_headers": _sql((_RAW, _TYPED), f"SELECT {_MIXED} FROM typed"),
    "csv_to_json_as_is": _sql(
        (_RAW, _TYPED),
        f"SELECT {_MIXED}, CAST(NULL AS VARCHAR) AS x FROM typed"
        f" UNION ALL SELECT NULL, {_each('NULL')}, NULL, CAST(range AS VARCHAR) FROM range(3)",
    ),
    "stream_csv_mixed_headers": _sql(
        (_RAW, _TYPED),
        f"SELECT {_MIXED}, CAST(NULL AS VARCHAR) AS odd_line FROM typed"
        f" UNION ALL SELECT NULL, {_each('NULL')}, NULL, line"
        " FROM (SELECT CAST(range AS VARCHAR) AS line FROM range(3)"
        # one header line in each of the odd folder's files, which hold a row each
        " UNION ALL SELECT 'x' FROM range(3))",
    ),
    "ingest_progress": _sql(
        (_RAW,),
        "SELECT count(*) FILTER (temperature_text IS DISTINCT FROM 'bad') AS accepted,"
        " count(*) FILTER (temperature_text = 'bad') AS quarantined,"
        " CAST(1 AS BIGINT) AS files, count(*) AS input_rows FROM raw GROUP BY event_id % 160",
    ),
    "bronze_quarantine": _sql((_RAW, _TYPED), _GOOD_AND_BAD),
    "bronze_stream": _sql((_RAW, _TYPED), _GOOD_AND_BAD),
    "bronze_restarted": _sql((_RAW, _TYPED), _GOOD_AND_BAD),
    "ndjson_roundtrip": _sql(
        (_RAW, _TYPED),
        "SELECT CAST(CASE WHEN raw.time IS NULL THEN 1 ELSE 0 END"
        " + CASE WHEN temperature_text IS NULL THEN 1 ELSE 0 END AS INTEGER) AS nulls,"
        f" typed.time, {_each('{m}')} FROM raw JOIN typed USING (event_id)",
    ),
    "clean_names": (
        "SELECT event_id, user_id, event_type AS eventtype, value,"
        " translate(regexp_replace(props || ' (x-y);=', '[(){};=\\n\\t]', '', 'g'), ' -', '__')"
        " AS cleantext FROM events"
    ),
    "silver_clean": _sql(
        _TO_CLEAN, f"SELECT event_id, time, {_each('{m}')}, event_time FROM clean"
    ),
    "silver_rejects": _sql(
        (_RAW, _TYPED),
        f"SELECT event_id, temperature, concat_ws(', ', {_REASONS}) AS reject_reason"
        f" FROM typed WHERE NOT coalesce({_VALID}, FALSE)",
    ),
    "event_time": _sql((_RAW, _TYPED), "SELECT event_id, time, event_time FROM typed"),
    "tumbling_5min": _sql(
        (*_TO_CLEAN, _WIN), f"SELECT window_start, window_end, {_AVERAGES_5MIN}, readings FROM win"
    ),
    "silver_joined": _sql(_TO_JOINED, f"{_SILVER} FROM joined"),
    "silver_joined_left_closed": _sql(
        (*_TO_CLEAN, _WIN, _joined("<")), f"{_SILVER} FROM joined"
    ),
    "rolling_5min": _sql(
        _TO_CLEAN,
        "SELECT event_id, event_time, "
        + _each(_rolling("300 seconds") + " AS rolling_{s}")
        + " FROM clean",
    ),
    "rolling_day_by_key": _sql(
        _TO_CLEAN,
        "SELECT event_id, user_id, "
        + _each(_rolling("86400 seconds", "PARTITION BY user_id") + " AS rolling_{s}")
        + " FROM clean",
    ),
    "sliding_5min": _sql(
        _TO_CLEAN,
        "SELECT window_start, window_start + INTERVAL '5 minutes' AS window_end,"
        " count(*) AS readings, "
        + ", ".join(f"{_round(f'avg({m})')} AS sliding_{_s(m)}" for m in METRICS)
        + " FROM (SELECT *, time_bucket(INTERVAL '1 minute', event_time)"
        " - to_minutes(CAST(back AS INTEGER)) AS window_start"
        " FROM clean, range(5) AS steps(back) WHERE event_time IS NOT NULL) GROUP BY window_start",
    ),
    "key_order": _sql(
        _TO_CLEAN,
        "SELECT user_id, event_time, lag(event_time) OVER"
        " (PARTITION BY user_id ORDER BY event_time NULLS FIRST) AS previous_time FROM clean",
    ),
    "global_baseline": _sql((*_TO_JOINED, _STATS), _BASELINE),
    "global_baseline_from_windows": _sql((*_TO_JOINED, _STATS), _BASELINE),
    "anomaly_flags": _sql(
        _TO_FLAGGED,
        f"{_SILVER}, temp_anomaly, humidity_anomaly, overall_anomaly FROM flagged",
    ),
    "anomaly_flags_by_key": _sql(
        _TO_JOINED,
        "SELECT event_id, user_id, temp_anomaly, humidity_anomaly,"
        " greatest(temp_anomaly, humidity_anomaly) AS overall_anomaly FROM"
        " (SELECT event_id, user_id,"
        + ", ".join(
            f" CAST(CASE WHEN abs({m} - avg({m}) OVER device) >"
            f" 3 * coalesce(nullif(stddev_samp({m}) OVER device, 0), 0.0001)"
            f" THEN 1 ELSE 0 END AS INTEGER) AS {_s(m)}_anomaly"
            for m in ("temperature", "humidity")
        )
        + " FROM joined WINDOW device AS (PARTITION BY user_id))",
    ),
    "zscores": _sql(
        (*_TO_JOINED, _STATS),
        "SELECT event_id,"
        f" {_round('(temperature - mean_temp) / std_temp')} AS z_temp,"
        f" {_round('(humidity - mean_humidity) / std_humidity')} AS z_humidity"
        " FROM joined, stats",
    ),
    "anomaly_log": _sql(_TO_GOLD, "SELECT * FROM log"),
    "refreshed_log": _sql(_TO_GOLD, "SELECT * FROM log"),
    "stream_log": _sql(_TO_GOLD, "SELECT * FROM log"),
    "stream_gold": _sql(
        _TO_FLAGGED,
        _SILVER.replace("event_id, ", "") + ", temp_anomaly, humidity_anomaly, overall_anomaly FROM flagged",
    ),
    "merged_table": _sql(
        _TO_CLEAN, "SELECT event_id, CAST(NULL AS DOUBLE) AS temperature, humidity FROM clean"
    ),
    "dq_tables": _sql(
        _TO_GOLD,
        _UNION.join(
            (
                "SELECT unnest(['row_count', 'schema_columns', 'anomaly_flags', 'temperature_range',"
                " 'humidity_range', 'duplicate_rows']) AS \"check\", 'no_such_table' AS target,"
                " CAST(NULL AS BIGINT) AS bad_rows, 'skipped' AS status",
                _dq("row_count", "hourly", _EMPTY, "hourly"),
                _dq("schema_columns", "hourly", "0", "stats"),
                _dq("unique_window", "hourly", "count(*)", _repeats("window_start", "hourly")),
                _dq("duplicate_rows", "hourly", "sum(n)", _copies("hourly", "hourly")),
            )
        ),
    ),
    "anomaly_rate": _sql(_TO_GOLD, "SELECT * FROM rate"),
    "anomaly_rate_filled": _sql(
        _TO_GOLD,
        "SELECT spine.window_start, spine.window_start + INTERVAL '10 minutes' AS window_end,"
        " coalesce(anomaly_count, 0) AS anomaly_count FROM"
        " (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-02-01',"
        " INTERVAL '10 minutes')) AS window_start) AS spine"
        " LEFT JOIN rate USING (window_start)",
    ),
    "alert_spikes": _sql(
        _TO_GOLD,
        "SELECT *, anomaly_count || ' anomalies in one window' AS message FROM rate"
        " WHERE anomaly_count >= 2",
    ),
    "temp_trend": _sql(
        _TO_JOINED,
        f"SELECT event_time, {_round('avg(temperature)')} AS avg_temp FROM joined"
        " GROUP BY event_time",
    ),
    "corr_matrix": _sql(_TO_JOINED, _UNION.join(_correlation(x, y) for x, y in _PAIRS)),
    "first_hours": _sql(
        _TO_GOLD,
        "SELECT window_start, window_end, avg_temp, avg_humidity, total_anomalies FROM hourly"
        + _FIRST_20,
    ),
    "first_rates": _sql(_TO_GOLD, "SELECT * FROM rate" + _FIRST_20),
    "latest_anomalies": _sql(
        _TO_GOLD,
        "SELECT * FROM log ORDER BY detected_at DESC NULLS LAST, temp_value, humidity_value"
        " LIMIT 20",
    ),
    "plot_feed_hourly": _sql(
        _TO_GOLD, "SELECT window_start, avg_temp, avg_humidity, total_anomalies FROM hourly"
    ),
    "plot_feed_rate": _sql(_TO_GOLD, "SELECT window_start, anomaly_count FROM rate"),
    "metric_records": _sql(
        _TO_GOLD,
        _metric("TotalAnomalies", "total_anomalies", "hourly")
        + _UNION
        + _metric("AnomalyRate_10min", "anomaly_count", "rate"),
    ),
    "clamp_timestamp": _sql(
        (_RAW, _TYPED), f"SELECT event_id, {_CLAMP.format(t='event_time')} AS clamped FROM typed"
    ),
    "retain": _sql(
        _TO_CLEAN,
        "SELECT event_id, event_time FROM clean"
        " WHERE event_time >= TIMESTAMP '2024-01-22' - INTERVAL 7 DAYS",
    ),
    "layer_counts": _sql(
        _TO_JOINED,
        "SELECT 'bronze' AS layer, count(*) AS rows FROM raw"
        " UNION ALL SELECT 'valid', count(*) FROM clean"
        " UNION ALL SELECT 'silver', count(*) FROM joined",
    ),
    "dq_row_count": _sql(
        _TO_GOLD,
        _dq("row_count", "device_stats", _EMPTY, "hourly")
        + _UNION
        + _dq("row_count", "nothing", _EMPTY, "hourly WHERE total_anomalies < 0"),
    ),
    "dq_schema": _sql(
        _TO_FLAGGED,
        _dq("schema_columns", "flagged", "0", "stats")
        + _UNION
        + _dq("schema_columns", "less", "2", "stats"),
    ),
    "dq_flags": _sql(
        _TO_FLAGGED,
        _dq("anomaly_flags", "flagged", _DQ_FLAGS, "flagged")
        + _UNION
        + _dq("anomaly_flags", "doubled", "count(*) FILTER (temp_anomaly = 1)", "flagged"),
    ),
    "dq_ranges": _sql(
        _TO_FLAGGED,
        _UNION.join(_dq(check, "flagged", bad, "flagged") for check, bad in _DQ_RANGES),
    ),
    "dq_unique_window": _sql(
        _TO_GOLD,
        _dq("unique_window", "device_stats", "count(*)", _repeats("window_start", "hourly"))
        + _UNION
        + _dq(
            "unique_window",
            "ten_minutes_as_hours",
            "count(*)",
            "(SELECT hour FROM (SELECT DISTINCT"
            " time_bucket(INTERVAL '10 minutes', event_time) AS start,"
            " time_bucket(INTERVAL '1 hour', event_time) AS hour"
            " FROM flagged WHERE event_time IS NOT NULL) GROUP BY hour HAVING count(*) > 1)",
        ),
    ),
    "dq_duplicates": _sql(
        _TO_JOINED,
        _dq("duplicate_rows", "silver", "sum(n)", _copies(_WHOLE_SILVER, "joined"))
        + _UNION
        + _dq("duplicate_rows", "two_columns", "sum(n)", _copies("air_quality, light", "joined")),
    ),
    "dq_summary": _sql(
        _TO_GOLD,
        "SELECT count(*) AS run, count(*) FILTER (status = 'passed') AS passed,"
        " count(*) FILTER (status = 'failed') AS failed,"
        " count(*) FILTER (status = 'error') AS errors,"
        f" count(*) FILTER (status = 'skipped') AS skipped FROM ({_ALL_CHECKS})",
    ),
    "profile": _sql(
        _TO_CLEAN,
        _UNION.join(
            f"SELECT '{m}' AS metric, count({m}) AS non_null, min({m}) AS min_value,"
            f" max({m}) AS max_value, count(DISTINCT {m}) AS distinct_values FROM clean"
            for m in METRICS
        ),
    ),
    "stream_tumbling": _sql(
        (*_TO_CLEAN, _WIN),
        f"SELECT window_start, window_end, {_AVERAGES_5MIN}, readings FROM win",
    ),
    "stream_device_stats": _sql(_TO_GOLD, _HOURLY_ROWS),
    "stream_anomaly_rate": _sql(_TO_GOLD, "SELECT * FROM rate"),
    "stream_late_windows": _sql(
        (*_TO_CLEAN, _WIN),
        f"SELECT window_start, window_end, {_AVERAGES_5MIN}, readings FROM win",
    ),
    "profile_from_sketches": _sql(
        _TO_CLEAN,
        _UNION.join(
            f"SELECT '{m}' AS metric, count({m}) AS non_null, min({m}) AS min_value, max({m}) AS max_value,"
            " 1 AS distinct_near, 1 AS q50_near, 1 AS q95_near, 1 AS q99_near FROM clean"
            " WHERE event_time >= TIMESTAMP '2024-01-08' AND event_time < TIMESTAMP '2024-01-15'"
            for m in METRICS
        ),
    ),
    "robust_baseline": _sql(
        (*_TO_CLEAN, _MEDIANS),
        f"SELECT user_id, {_ROBUST} FROM clean JOIN by_user USING (user_id) GROUP BY user_id"
        f" UNION ALL SELECT NULL, {_ROBUST} FROM clean, overall",
    ),
    "spike_episodes": _sql(
        _TO_GOLD,
        "SELECT min(window_start) AS episode_start, max(window_end) AS episode_end, count(*) AS windows,"
        " CAST(sum(anomaly_count) AS BIGINT) AS anomalies, max(anomaly_count) AS peak,"
        " first(window_start ORDER BY anomaly_count DESC, window_start) AS peak_start FROM ("
        "SELECT *, window_start - INTERVAL '10 minutes' * row_number() OVER (ORDER BY window_start) AS run"
        " FROM rate WHERE anomaly_count >= 2) GROUP BY run",
    ),
    "device_sessions": _sql((*_TO_CLEAN, _SESSIONS), _SESSION_ROWS),
    "stream_device_sessions": _sql((*_TO_CLEAN, _SESSIONS), _SESSION_ROWS),
    "asof_purchase": _sql(
        (
            *_TO_CLEAN,
            "purchases AS (SELECT user_id, date_trunc('second', ts) AS matched_time, max(value) AS value"
            " FROM events WHERE event_type = 'purchase' GROUP BY ALL)",
        ),
        "SELECT event_id, matched_time, value FROM clean ASOF LEFT JOIN purchases"
        " ON clean.user_id = purchases.user_id AND event_time >= matched_time",
    ),
    "grouped_rollups": _sql(
        (*_TO_FLAGGED, _HOURS_AND_DAYS),
        "SELECT user_id, hour, day, concat_ws(',', CASE WHEN grouping(user_id) = 0 THEN 'user_id' END,"
        " CASE WHEN grouping(hour) = 0 THEN 'hour' END, CASE WHEN grouping(day) = 0 THEN 'day' END) AS grouping,"
        f" count(*) AS readings, {', '.join(f'{_round(f'avg({m})')} AS avg_{_s(m)}' for m in METRICS)},"
        " CAST(sum(overall_anomaly) AS BIGINT) AS total_anomalies FROM dated"
        " GROUP BY GROUPING SETS ((user_id, hour), (user_id, day), (user_id), (hour), (day), ())",
    ),
    "stream_repeated_drop": _sql((_RAW, _TYPED), _TYPED_VALUES),
    "expired_silver": _sql(
        _TO_JOINED,
        f"SELECT time, {_each('{m}')}, event_time, {_AVERAGES_5MIN}, NULL AS dropped_day FROM joined"
        " WHERE event_time IS NULL OR event_time >= TIMESTAMP '2024-01-15'"
        f" UNION ALL SELECT NULL, {_each('NULL')}, NULL, {_each('NULL')}, day"
        " FROM (SELECT DISTINCT strftime(event_time, '%Y-%m-%d') AS day FROM joined"
        " WHERE event_time < TIMESTAMP '2024-01-15')",
    ),
    "followed_device_stats": _sql(_TO_GOLD, _HOURLY_ROWS),
    "followed_log": _sql(_TO_GOLD, "SELECT * FROM log"),
}
