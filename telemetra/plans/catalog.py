"""Every operator as a query over the given tables, with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from telemetra.functions import fixed_values as fixed
from telemetra.operators import alerts, features, quality, quantiles, replay, reports, rollups, scoring
from telemetra.plans import jobs
from telemetra.sources import csv_tree, messages, store
from telemetra.sources.adapters import (
    EVENTS_SQL,
    LINEITEM_SQL,
    events_as_readings,
    lineitem_as_readings,
    newest_time,
)
from telemetra.operators.ordered import with_position
from telemetra.sources.staging import new_folder, stage_in_order
from telemetra.streaming import queries as live
from telemetra.streaming.history import ROCKS_DB, STATE_STORE
from telemetra.streaming.sinks import aggregate_sink, alert_sink, raw_sink, splitting_sink, store_sink

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

WITH_READINGS = f"WITH readings AS ({EVENTS_SQL})"
TIES = ("event_id",)
IN_TIME = ("event_time", "event_id")
WEEK = 7 * 1440
AS_OF = "(SELECT max(event_time) FROM readings)"
IN_WEEK = f"event_time >= {AS_OF} - INTERVAL 10080 MINUTES"


def exact_mean(value: str = "value") -> str:
    return f"CAST(SUM(CAST({value} AS DECIMAL(18,4))) AS DOUBLE) / COUNT({value})"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; its SQL continues after the readings view."""

    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = f"{WITH_READINGS}{sql}"
        return function

    return register


# --- aggregates ------------------------------------------------------------

TOTALS_SQL = f"""
SELECT building_id, sensor_type, {exact_mean()} AS avg_value, max(value) AS max_value, count(*) AS message_count
FROM readings GROUP BY building_id, sensor_type"""


@query("A1_running_totals", TOTALS_SQL)
def a1(spark, sf_dir):
    return reports.running_totals(events_as_readings(spark, sf_dir), exact=True)


@query(
    "A2_sensor_kpis",
    f"""
SELECT sensor_type, {exact_mean()} AS avg_value, max(value) AS max_value, min(value) AS min_value,
       count(*) AS reading_count
FROM readings WHERE {IN_WEEK} GROUP BY sensor_type""",
)
def a2(spark, sf_dir):
    readings = events_as_readings(spark, sf_dir)
    return reports.sensor_kpis(readings, WEEK, newest_time(readings), exact=True)


@query(
    "A2_sensor_kpis_newest_100",
    f""", aged AS (
  SELECT *, row_number() OVER (PARTITION BY sensor_type ORDER BY event_time DESC, event_id DESC) AS age
  FROM readings WHERE {IN_WEEK})
SELECT sensor_type, {exact_mean()} AS avg_value, max(value) AS max_value, min(value) AS min_value,
       count(*) AS reading_count
FROM aged WHERE age <= 100 GROUP BY sensor_type""",
)
def a2_newest(spark, sf_dir):
    readings = events_as_readings(spark, sf_dir)
    return reports.sensor_kpis(
        readings, WEEK, newest_time(readings), newest=fixed.LATEST_ROWS, order=TIES, exact=True
    )


@query(
    "A3_series_stats",
    f"""
SELECT sensor_type, max_by(value, event_time) AS last_value, max(value) AS max_value, min(value) AS min_value,
       {exact_mean()} AS mean_value
FROM readings GROUP BY sensor_type""",
)
def a3(spark, sf_dir):
    return reports.series_stats(events_as_readings(spark, sf_dir), by=["sensor_type"], order=TIES, exact=True)


BY_LOCATION_SQL = f"""
SELECT room_id AS location, {exact_mean()} AS avg_value, count(*) AS reading_count
FROM readings WHERE sensor_type = 'co2' AND {IN_WEEK} GROUP BY room_id"""


@query("A4_by_location", BY_LOCATION_SQL)
def a4(spark, sf_dir):
    readings = events_as_readings(spark, sf_dir)
    return reports.by_location(readings, "co2", WEEK, newest_time(readings), exact=True)


@query(
    "A5_store_totals",
    "\nSELECT count(*) AS reading_count, count(DISTINCT sensor_type) AS sensor_types FROM readings",
)
def a5(spark, sf_dir):
    return reports.store_totals(events_as_readings(spark, sf_dir))


QUANTILES_SQL = """
SELECT sensor_type, round(quantile_cont(value, 0.01), 6) AS q01, round(quantile_cont(value, 0.99), 6) AS q99
FROM readings GROUP BY sensor_type"""


def quantile_columns(found: DataFrame) -> DataFrame:
    return found.select(
        "sensor_type",
        F.round(F.col("quantiles")[0], 6).alias("q01"),
        F.round(F.col("quantiles")[1], 6).alias("q99"),
    )


@query("A6_quantiles", QUANTILES_SQL)
def a6(spark, sf_dir):
    readings = events_as_readings(spark, sf_dir)
    return quantile_columns(quantiles.exact_quantiles(readings, ["sensor_type"], fixed.OUTLIER_QUANTILES))


@query("A6_quantiles_bracketed", QUANTILES_SQL)
def a6_bracketed(spark, sf_dir):
    readings = events_as_readings(spark, sf_dir)
    found = quantiles.exact_quantiles(
        readings, ["sensor_type"], fixed.OUTLIER_QUANTILES, strategy="bracketed", accuracy=200
    )
    return quantile_columns(found)


@query("A6_quantiles_of_store", QUANTILES_SQL)
def a6_of_store(spark, sf_dir):
    """From the sketches kept with a store of several batches."""
    path = merged_store(spark, events_as_readings(spark, sf_dir))
    return quantile_columns(rollups.stored_quantiles(spark, path, fixed.OUTLIER_QUANTILES))


FLAGGED_SQL = """, bounds AS (
  SELECT sensor_type, quantile_cont(value, 0.01) AS low, quantile_cont(value, 0.99) AS high
  FROM readings GROUP BY sensor_type),
flagged AS (
  SELECT readings.*, NOT (value BETWEEN low AND high) AS is_outlier FROM readings JOIN bounds USING (sensor_type))"""


@query(
    "A7_outlier_stats",
    f"""{FLAGGED_SQL}
SELECT sensor_type, min(value) AS min_value, max(value) AS max_value, {exact_mean()} AS mean_value,
       round(stddev_samp(value), 6) AS std_value, CAST(count(*) FILTER (is_outlier) AS BIGINT) AS outliers
FROM flagged GROUP BY sensor_type""",
)
def a7(spark, sf_dir):
    flagged = quality.flag_outliers(events_as_readings(spark, sf_dir))
    return quality.outlier_stats(flagged, exact=True).withColumn("std_value", F.round("std_value", 6))


@query(
    "A8_processing_summary",
    """
SELECT count(*) AS row_count, count(DISTINCT room_id) AS rooms, count(DISTINCT sensor_type) AS sensors,
       min(event_time) AS first_time, max(event_time) AS last_time FROM readings""",
)
def a8(spark, sf_dir):
    return reports.processing_summary(events_as_readings(spark, sf_dir))


@query(
    "A9_processing_summary_by_sensor",
    f"""
SELECT sensor_type, count(*) AS row_count, round({exact_mean()}, 2) AS mean_value, count(DISTINCT room_id) AS rooms
FROM readings GROUP BY sensor_type""",
)
def a9(spark, sf_dir):
    return reports.processing_summary_by_sensor(events_as_readings(spark, sf_dir), exact=True)


PROFILE_SQL = f""", cells AS (
  SELECT sensor_type, 'value' AS column_name, value FROM readings
  UNION ALL SELECT sensor_type, 'event_id', CAST(event_id AS DOUBLE) FROM readings)
SELECT sensor_type, column_name, CAST(count(*) - count(value) AS BIGINT) AS missing_count, count(value) AS value_count,
       {exact_mean()} AS mean_value, round(stddev_samp(value), 6) AS std_value, min(value) AS min_value,
       round(quantile_cont(value, 0.25), 6) AS q25, round(quantile_cont(value, 0.5), 6) AS q50,
       round(quantile_cont(value, 0.75), 6) AS q75, max(value) AS max_value
FROM cells GROUP BY sensor_type, column_name"""


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


@query("A10_profile", PROFILE_SQL)
def a10(spark, sf_dir):
    described = quality.profile(events_as_readings(spark, sf_dir), exact=True)
    return rounded(described, "std_value", "q25", "q50", "q75")


@query(
    "A10_missing_values",
    """
SELECT 'event_id' AS column_name, 'bigint' AS data_type, count(*) AS row_count,
       count(*) - count(event_id) AS missing_count FROM readings
UNION ALL SELECT 'event_time', 'timestamp_ntz', count(*), count(*) - count(event_time) FROM readings
UNION ALL SELECT 'building_id', 'string', count(*), count(*) - count(building_id) FROM readings
UNION ALL SELECT 'room_id', 'string', count(*), count(*) - count(room_id) FROM readings
UNION ALL SELECT 'sensor_type', 'string', count(*), count(*) - count(sensor_type) FROM readings
UNION ALL SELECT 'value', 'double', count(*), count(*) - count(value) FROM readings""",
)
def a10_missing(spark, sf_dir):
    return quality.missing_values(events_as_readings(spark, sf_dir))


HISTOGRAM_SQL = f""", ranges AS (
  SELECT sensor_type, min(value) AS low, max(value) AS high, {exact_mean()} AS mean_value,
    count(*) FILTER (WHERE isinf(value)) AS infinite_count
  FROM readings GROUP BY sensor_type),
bins AS (
  SELECT *, low + (bin - 1) * ((high - low) / 30) AS bin_start, low + bin * ((high - low) / 30) AS bin_end
  FROM (SELECT *, CAST(unnest(range(1, 31)) AS INTEGER) AS bin FROM ranges) AS numbered)
SELECT bins.sensor_type, bin, bin_start, bin_end, any_value(mean_value) AS mean_value, any_value(infinite_count) AS infinite_count, count(value) AS value_count
FROM bins LEFT JOIN readings ON readings.sensor_type = bins.sensor_type
     AND (value >= bin_start OR bin = 1) AND (value < bin_end OR bin = 30)
GROUP BY bins.sensor_type, bin, bin_start, bin_end"""


@query("A11_histogram", HISTOGRAM_SQL)
def a11(spark, sf_dir):
    return quality.histogram(events_as_readings(spark, sf_dir), exact=True)


# --- filters, alerts, projections ------------------------------------------


@query(
    "F1_stream_alerts",
    f""", all_readings AS (
  SELECT event_time, building_id, room_id, sensor_type, value FROM readings UNION ALL {LINEITEM_SQL})
SELECT event_time, building_id, room_id, sensor_type, value FROM all_readings
WHERE sensor_type = 'temperature' AND value > 25 OR sensor_type = 'electricity' AND value > 5000""",
)
def f1(spark, sf_dir):
    both = features.union_readings(
        events_as_readings(spark, sf_dir).drop("event_id"), lineitem_as_readings(spark, sf_dir)
    )
    return alerts.filter_alerts(both)


@query("F2_recent", "\nSELECT * FROM readings WHERE sensor_type = 'humidity' AND event_time >= "
       f"{AS_OF} - INTERVAL 1440 MINUTES")
def f2(spark, sf_dir):
    readings = events_as_readings(spark, sf_dir)
    return features.recent(readings, "humidity", 1440, newest_time(readings))


RANGE_ALERTS_SQL = f"""
SELECT * FROM readings WHERE {IN_WEEK}
  AND (sensor_type = 'temperature' AND (value < 16 OR value > 28) OR sensor_type = 'co2' AND value > 1200
       OR sensor_type = 'humidity' AND (value < 30 OR value > 70))"""


@query("F3_range_alerts", RANGE_ALERTS_SQL)
def f3(spark, sf_dir):
    readings = events_as_readings(spark, sf_dir)
    return alerts.range_alerts(readings, newest_time(readings), WEEK)


@query(
    "F4_tag_high_readings",
    """, limits AS (
  SELECT *, CASE sensor_type WHEN 'co2' THEN 1200.0 WHEN 'humidity' THEN 80.0 WHEN 'temperature' THEN 28.0
                             WHEN 'light' THEN 800.0 END AS high FROM readings)
SELECT event_id, sensor_type, value, CASE WHEN value > high THEN true END AS alert,
       CASE WHEN value > high THEN 'high_' || sensor_type END AS alert_type,
       CASE WHEN value > high THEN value END AS alert_value,
       CAST(CASE WHEN value > high THEN high END AS DOUBLE) AS alert_threshold FROM limits""",
)
def f4(spark, sf_dir):
    tagged = alerts.tag_high_readings(events_as_readings(spark, sf_dir))
    return tagged.select(
        "event_id", "sensor_type", "value", "alert", "alert_type", "alert_value", "alert_threshold"
    )


@query(
    "F5_severity_band",
    """
SELECT event_id, sensor_type, value, CASE sensor_type
  WHEN 'temperature' THEN CASE WHEN value > 28 THEN 'alert' WHEN value > 25 THEN 'warning' ELSE 'normal' END
  WHEN 'co2' THEN CASE WHEN value > 1200 THEN 'alert' WHEN value > 1000 THEN 'warning' ELSE 'normal' END
  WHEN 'humidity' THEN CASE WHEN value > 80 THEN 'alert' WHEN value > 70 THEN 'warning' ELSE 'normal' END
  END AS severity FROM readings""",
)
def f5(spark, sf_dir):
    return alerts.severity_band(events_as_readings(spark, sf_dir)).select(
        "event_id", "sensor_type", "value", "severity"
    )


UNIT_SQL = """CASE sensor_type WHEN 'co2' THEN 'ppm' WHEN 'humidity' THEN '%' WHEN 'temperature' THEN 'celsius'
            WHEN 'occupancy' THEN 'binary' WHEN 'light' THEN 'lux' ELSE 'unknown' END"""


@query("P7_units", f"""
SELECT event_id, sensor_type, {UNIT_SQL} AS unit FROM readings""")
def p7(spark, sf_dir):
    return features.with_unit(events_as_readings(spark, sf_dir)).select("event_id", "sensor_type", "unit")


@query(
    "P7_display_units",
    """
SELECT event_id, sensor_type, CASE sensor_type WHEN 'temperature' THEN '°C' WHEN 'humidity' THEN '%'
  WHEN 'co2' THEN 'ppm' WHEN 'light' THEN 'lux' WHEN 'occupancy' THEN 'pers' ELSE '' END AS unit FROM readings""",
)
def p7_display(spark, sf_dir):
    return features.with_unit(events_as_readings(spark, sf_dir), display=True).select(
        "event_id", "sensor_type", "unit"
    )


TIME_FEATURES_SQL = """CAST(hour(event_time) AS INTEGER) AS hour,
       CAST(isodow(event_time) - 1 AS INTEGER) AS day_of_week,
       CAST(CASE WHEN isodow(event_time) >= 6 THEN 1 ELSE 0 END AS INTEGER) AS is_weekend,
       CAST(month(event_time) AS INTEGER) AS month, CAST(day(event_time) AS INTEGER) AS day"""


@query("P8_time_features", f"\nSELECT event_id, {TIME_FEATURES_SQL} FROM readings")
def p8(spark, sf_dir):
    return features.with_time_features(events_as_readings(spark, sf_dir)).select(
        "event_id", "hour", "day_of_week", "is_weekend", "month", "day"
    )


DISPLAY_SQL = """strftime(event_time, '%H:%M:%S') AS "Heure", value AS "Valeur", room_id AS "Pièce",
       building_id AS "Bâtiment\""""


@query("P9_display_readings", f"\nSELECT {DISPLAY_SQL} FROM readings")
def p9(spark, sf_dir):
    return reports.display_readings(events_as_readings(spark, sf_dir))


@query("P10_location_column", "\nSELECT event_id, room_id AS location FROM readings")
def p10(spark, sf_dir):
    readings = events_as_readings(spark, sf_dir)
    return readings.select("event_id", reports.location_column(readings).alias("location"))


@query("P14_shapes", "\nSELECT room_id, sensor_type, count(*) AS row_count FROM readings GROUP BY room_id, sensor_type")
def p14_shapes(spark, sf_dir):
    return reports.shapes(events_as_readings(spark, sf_dir))


@query(
    "P14_first_rows",
    """, placed AS (
  SELECT *, row_number() OVER (PARTITION BY room_id, sensor_type ORDER BY event_time, event_id) AS place FROM readings)
SELECT * EXCLUDE (place) FROM placed WHERE place <= 2""",
)
def p14_first_rows(spark, sf_dir):
    return reports.first_rows(events_as_readings(spark, sf_dir), order=IN_TIME)


@query(
    "U1_union_readings",
    f"""
SELECT * FROM readings
UNION ALL SELECT NULL, event_time, building_id, room_id, sensor_type, value FROM ({LINEITEM_SQL}) AS electricity""",
)
def u1(spark, sf_dir):
    return features.union_readings(events_as_readings(spark, sf_dir), lineitem_as_readings(spark, sf_dir))


# --- top rows --------------------------------------------------------------

SERIES_SQL = f"""
SELECT * FROM readings WHERE sensor_type = 'temperature' AND {IN_WEEK} ORDER BY event_time, event_id LIMIT 1000"""


@query("L1_time_series", SERIES_SQL)
def l1(spark, sf_dir):
    readings = events_as_readings(spark, sf_dir)
    return reports.time_series(readings, "temperature", WEEK, newest_time(readings), order=TIES)


@query(
    "L2_latest_readings",
    "\nSELECT * FROM readings WHERE sensor_type = 'light' ORDER BY event_time DESC, event_id DESC LIMIT 100",
)
def l2(spark, sf_dir):
    return reports.latest_readings(events_as_readings(spark, sf_dir), "light", order=TIES)


@query(
    "L3_latest_range_alerts",
    f"{RANGE_ALERTS_SQL} AND sensor_type = 'co2' ORDER BY event_time DESC, event_id DESC LIMIT 5",
)
def l3(spark, sf_dir):
    readings = events_as_readings(spark, sf_dir)
    return alerts.range_alerts(
        readings, newest_time(readings), WEEK, sensor="co2", order=TIES, newest=fixed.ALERT_ROWS
    )


# --- cleaning --------------------------------------------------------------

DEDUP_SQL = """, numbered AS (
  SELECT *, date_trunc('hour', event_time) AS event_hour, row_number() OVER (
    PARTITION BY date_trunc('hour', event_time), room_id, sensor_type ORDER BY event_id) AS copy FROM readings),
clean AS (SELECT * EXCLUDE (copy) FROM numbered WHERE copy = 1)"""
DEDUP_KEYS = ("event_hour", "room_id", "sensor_type")


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = events_as_readings(spark, sf_dir)
    return readings.withColumn("event_hour", F.date_trunc("hour", "event_time").cast("timestamp_ntz"))


@query("D1_dedup_readings", f"{DEDUP_SQL}\nSELECT * FROM clean")
def d1(spark, sf_dir):
    return quality.dedup_readings(hourly(spark, sf_dir), DEDUP_KEYS, TIES)


@query("D2_flag_outliers", f"{FLAGGED_SQL}\nSELECT event_id, sensor_type, value, is_outlier FROM flagged")
def d2(spark, sf_dir):
    flagged = quality.flag_outliers(events_as_readings(spark, sf_dir))
    return flagged.select("event_id", "sensor_type", "value", "is_outlier")


@query("D2_flag_outliers_bracketed", f"{FLAGGED_SQL}\nSELECT event_id, sensor_type, value, is_outlier FROM flagged")
def d2_bracketed(spark, sf_dir):
    flagged = quality.flag_outliers(events_as_readings(spark, sf_dir), strategy="bracketed")
    return flagged.select("event_id", "sensor_type", "value", "is_outlier")


# --- ordered rows ----------------------------------------------------------


def scores_sql(order: str, by: str = "sensor_type") -> str:
    return f""", history AS (
  SELECT *, count(value) OVER before AS n, avg(value) OVER before AS mean, stddev_pop(value) OVER before AS deviation,
         count(value) OVER last5 AS n5, count(value) OVER last10 AS n10,
         CAST(SUM(CAST(value AS DECIMAL(18,4))) OVER last5 AS DOUBLE) AS sum5,
         lag(value, 1) OVER arrival AS v1, lag(value, 3) OVER arrival AS v3, lag(value, 4) OVER arrival AS v4
  FROM readings WHERE sensor_type IN ('temperature', 'co2', 'humidity')
  WINDOW arrival AS (PARTITION BY {by} ORDER BY {order}),
         before AS (PARTITION BY {by} ORDER BY {order} ROWS BETWEEN 50 PRECEDING AND 1 PRECEDING),
         last5 AS (PARTITION BY {by} ORDER BY {order} ROWS BETWEEN 4 PRECEDING AND CURRENT ROW),
         last10 AS (PARTITION BY {by} ORDER BY {order} ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)),
scores AS (
  SELECT event_id,
         CASE WHEN n >= 10 AND deviation > 0 AND abs(value - mean) / deviation > 2.5 THEN true END AS ml_anomaly,
         CASE WHEN n5 = 5 THEN round(sum5 / 5, 2) END AS simple,
         CASE WHEN n10 = 10 THEN round(value + (2 * (value - v4) + (v1 - v3)) / 10, 6)
              WHEN n5 = 5 THEN round(value, 6) END AS trend FROM history)"""


def scored_sql(columns: str, order: str = "event_time, event_id", by: str = "sensor_type") -> str:
    return f"{scores_sql(order, by)}\nSELECT {columns} FROM readings LEFT JOIN scores USING (event_id)"


ANOMALY_SQL = "ml_anomaly, CAST(CASE WHEN ml_anomaly THEN 0.95 END AS DOUBLE) AS ml_confidence"
W1_SQL = scored_sql(f"event_id, sensor_type, value, {ANOMALY_SQL}")
W1_COLUMNS = ("event_id", "sensor_type", "value", "ml_anomaly", "ml_confidence")


@query("W1_detect_anomalies", W1_SQL)
def w1(spark, sf_dir):
    return scoring.detect_anomalies(events_as_readings(spark, sf_dir), order=IN_TIME).select(*W1_COLUMNS)


@query("W1_detect_anomalies_chunked", W1_SQL)
def w1_chunked(spark, sf_dir):
    scored = scoring.detect_anomalies(
        events_as_readings(spark, sf_dir), order=IN_TIME, strategy="chunked", chunk_rows=1000
    )
    return scored.select(*W1_COLUMNS)


@query(
    "W1_detect_anomalies_by_room",
    scored_sql(f"event_id, sensor_type, value, {ANOMALY_SQL}", by="building_id, room_id, sensor_type"),
)
def w1_by_room(spark, sf_dir):
    scored = scoring.detect_anomalies(
        events_as_readings(spark, sf_dir), by=("building_id", "room_id", "sensor_type"), order=IN_TIME
    )
    return scored.select(*W1_COLUMNS)


@query("W2_predict_next", scored_sql("event_id, sensor_type, value, simple AS ml_prediction"))
def w2(spark, sf_dir):
    predicted = scoring.predict_next(events_as_readings(spark, sf_dir), order=IN_TIME)
    return predicted.select("event_id", "sensor_type", "value", "ml_prediction")


@query("W3_predict_trend", scored_sql("event_id, sensor_type, value, trend AS ml_prediction"))
def w3(spark, sf_dir):
    predicted = scoring.predict_next(events_as_readings(spark, sf_dir), "trend", order=IN_TIME, decimals=6)
    return predicted.select("event_id", "sensor_type", "value", "ml_prediction")


def rolling_sql(table: str) -> str:
    columns = ",\n".join(
        f"CASE WHEN sensor_type = '{s}' THEN total / n END AS {s}_rolling_mean" for s in fixed.ROLLING_SENSORS
    )
    return f""", framed AS (
  SELECT *, CAST(SUM(CAST(value AS DECIMAL(18,4))) OVER last10 AS DOUBLE) AS total, count(value) OVER last10 AS n
  FROM {table} WINDOW last10 AS (PARTITION BY room_id, sensor_type ORDER BY event_time, event_id
                                 ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)),
rolled AS (SELECT * EXCLUDE (total, n), {columns} FROM framed)"""


@query("W4_rolling_means", f"{rolling_sql('readings')}\nSELECT * FROM rolled")
def w4(spark, sf_dir):
    return features.with_rolling_means(events_as_readings(spark, sf_dir), order=IN_TIME, exact=True)


@query("W4_rolling_means_chunked", f"{rolling_sql('readings')}\nSELECT * FROM rolled")
def w4_chunked(spark, sf_dir):
    return features.with_rolling_means(
        events_as_readings(spark, sf_dir), order=IN_TIME, exact=True, strategy="chunked", chunk_rows=1000
    )


SCHEDULE_SQL = """, gaps AS (
  SELECT *, (lead(epoch_us(event_time)) OVER (ORDER BY event_time, event_id) - epoch_us(event_time))
            / CAST(1000000 AS DOUBLE) AS gap_seconds,
         (epoch_us(event_time) - (SELECT min(epoch_us(event_time)) FROM readings))
            / CAST(1000000 AS DOUBLE) / CAST(50 AS DOUBLE) AS release_seconds
  FROM readings),
schedule AS (
  SELECT *, CASE WHEN gap_seconds > 0
                 THEN greatest(gap_seconds / CAST(50 AS DOUBLE) - CAST(0.001 AS DOUBLE), CAST(0 AS DOUBLE))
                 ELSE CAST(0 AS DOUBLE) END AS wait_seconds FROM gaps)"""


@query(
    "W5_replay_schedule",
    f"{SCHEDULE_SQL}\nSELECT event_id, gap_seconds, wait_seconds, release_seconds FROM schedule",
)
def w5(spark, sf_dir):
    timed = replay.replay_schedule(events_as_readings(spark, sf_dir), order=TIES, chunk_rows=1000)
    return timed.select("event_id", "gap_seconds", "wait_seconds", "release_seconds")


# --- messages, files, stores -----------------------------------------------

SENT_AT = "2026-01-02 03:04:05"
MESSAGE_COLUMNS = ("event_time", "building_id", "room_id", "sensor_type", "value", "unit", "source")


def as_naive(df: DataFrame, *times: str) -> DataFrame:
    return df.withColumns({t: F.col(t).cast("timestamp_ntz") for t in times})


@query(
    "P2_parse_readings",
    f"""
SELECT CASE WHEN epoch_us(event_time) % 1000000 = 0 THEN strftime(event_time, '%Y-%m-%dT%H:%M:%S')
            ELSE strftime(event_time, '%Y-%m-%dT%H:%M:%S.%f') END AS "timestamp",
       '2026-01-02T03:04:05' AS kafka_timestamp, building_id, room_id, sensor_type, value, {UNIT_SQL} AS unit,
       'historical_dataset' AS source, event_time, false AS is_malformed FROM readings""",
)
def p2(spark, sf_dir):
    sent = messages.to_messages(events_as_readings(spark, sf_dir), sent_at=SENT_AT)
    parsed = messages.parse_readings(sent.withColumn("timestamp", F.lit(SENT_AT).cast("timestamp")))
    return as_naive(parsed.drop("kafka_time"), "event_time")


@query(
    "S3_to_messages",
    f"""
SELECT event_id, CASE WHEN epoch_us(event_time) % 1000000 = 0 THEN strftime(event_time, '%Y-%m-%dT%H:%M:%S')
                      ELSE strftime(event_time, '%Y-%m-%dT%H:%M:%S.%f') END AS "timestamp",
       '2026-01-02T03:04:05' AS kafka_timestamp, building_id, room_id, sensor_type, value, {UNIT_SQL} AS unit,
       'historical_dataset' AS source, CAST(floor(epoch(event_time)) AS BIGINT) AS original_timestamp
FROM readings""",
)
def s3(spark, sf_dir):
    sent = messages.to_messages(events_as_readings(spark, sf_dir), sent_at=SENT_AT, keep=["event_id"])
    fields = (
        "timestamp STRING, kafka_timestamp STRING, building_id STRING, room_id STRING, sensor_type STRING, "
        "value DOUBLE, unit STRING, source STRING, original_timestamp LONG"
    )
    return sent.select("event_id", F.from_json("value", fields).alias("sent")).select("event_id", "sent.*")


CSV_SQL = """
SELECT floor(epoch(event_time)) + 0.25::DOUBLE * (event_id % 4) AS timestamp_unix, value, room_id, sensor_type, 'SDH_Building' AS building_id,
       date_trunc('second', event_time) + INTERVAL 250 MILLISECONDS * (event_id % 4) AS event_time FROM readings"""


def sensor_tree(spark: SparkSession, sf_dir: str) -> str:
    """All readings as sensor files below building, room and sensor; seconds as whole numbers, with ``.0`` or a fraction."""
    readings = events_as_readings(spark, sf_dir)
    base = new_folder(spark, "tree")
    file_name = F.when(F.col("sensor_type") == "occupancy", "pir").otherwise(F.col("sensor_type"))
    (
        readings.select(
            F.concat(
                F.unix_seconds(F.col("event_time").cast("timestamp")).cast("string"),
                F.element_at(F.array(*[F.lit(x) for x in ("", ".25", ".50", ".75")]), (F.col("event_id") % 4 + 1).cast("int")),
                F.when(F.col("event_id") % 8 == 0, ".0").otherwise(""),
            ).alias("timestamp_unix"),
            "value",
            F.col("building_id").alias("building"),
            F.col("room_id").alias("room"),
            file_name.alias("sensor"),
        )
        .write.option("header", True)
        .partitionBy("building", "room", "sensor")
        .csv(base)
    )
    return base


TREE_LAYOUT = {
    "files": "building=*/room=*/sensor=*/*.csv",
    "room_and_sensor": r"room=([^/]+)/sensor=([^/]+)/",
}


@query("S2_sensor_csv", CSV_SQL)
def s2(spark, sf_dir):
    loaded = csv_tree.read_sensor_csv(spark, sensor_tree(spark, sf_dir), **TREE_LAYOUT)
    return as_naive(loaded, "event_time").drop("source_file", "source_row")


@query(
    "L9_rooms_of_sensor_csv",
    CSV_SQL.replace("'SDH_Building' AS building_id", "building_id") + " WHERE room_id IN ('R1', 'R4', 'R7')",
)
def l9(spark, sf_dir):
    loaded = csv_tree.read_sensor_csv(
        spark,
        sensor_tree(spark, sf_dir),
        rooms=["R1", "R4", "R7"],
        building_pattern=r"/building=([^/]+)/",
        **TREE_LAYOUT,
    )
    return as_naive(loaded, "event_time").drop("source_file", "source_row")


def processed_files(spark: SparkSession, sf_dir: str) -> str:
    folder = new_folder(spark, "processed")
    readings = features.with_time_features(events_as_readings(spark, sf_dir))
    store.save_processed(readings, folder)
    return folder


PROCESSED_SCHEMA = (
    "event_id LONG, timestamp TIMESTAMP, building_id STRING, room_id STRING, sensor_type STRING, value DOUBLE, "
    "hour INT, day_of_week INT, is_weekend INT, month INT, day INT"
)
PROCESSED_SQL = f"""event_id, event_time AS "timestamp", building_id, room_id, sensor_type,
       value, {TIME_FEATURES_SQL}"""


@query("S7_processed_csv", f"\nSELECT {PROCESSED_SQL} FROM readings")
def s7(spark, sf_dir):
    folder = processed_files(spark, sf_dir)
    stored = spark.read.schema(PROCESSED_SCHEMA).option("header", True).csv(f"{folder}/all")
    return as_naive(stored, "timestamp")


@query("S8_processed_csv_by_sensor", f"\nSELECT {PROCESSED_SQL}, sensor_type AS sensor FROM readings")
def s8(spark, sf_dir):
    folder = processed_files(spark, sf_dir)
    stored = spark.read.schema(f"{PROCESSED_SCHEMA}, sensor STRING").option("header", True).csv(f"{folder}/by_sensor")
    return as_naive(stored, "timestamp")


@query("S9_export_csv", f"\nSELECT {DISPLAY_SQL} FROM readings")
def s9(spark, sf_dir):
    folder = new_folder(spark, "export")
    shown = reports.display_readings(events_as_readings(spark, sf_dir))
    store.export_csv(shown, folder)
    return spark.read.schema(shown.schema).option("header", True).csv(folder)


@query("S10_read_store", f"\nSELECT * FROM readings WHERE sensor_type = 'co2' AND {IN_WEEK}")
def s10(spark, sf_dir):
    readings = events_as_readings(spark, sf_dir)
    folder = new_folder(spark, "store")
    store.write_batch(readings, folder, 0)
    start = F.lit(newest_time(readings)) - F.expr("INTERVAL 7 DAYS")
    found = store.read_store(spark, folder, "co2", since=start)
    return found.select(*readings.columns)


def merged_store(spark, readings: DataFrame) -> str:
    """A store of three batches, the first two of them merged."""
    folder = new_folder(spark, "store")
    for number in range(3):
        store.write_batch(readings.where(F.pmod("event_id", F.lit(3)) == number), folder, number)
    store.compact(spark, folder, keep=1)
    return folder


@query("S10_read_merged_store", f"\nSELECT * FROM readings WHERE sensor_type = 'co2' AND {IN_WEEK}")
def s10_merged(spark, sf_dir):
    readings = events_as_readings(spark, sf_dir)
    start = F.lit(newest_time(readings)) - F.expr("INTERVAL 7 DAYS")
    found = store.read_store(spark, merged_store(spark, readings), "co2", since=start)
    return found.select(*readings.columns)


@query(
    "L2_latest_of_store",
    "\nSELECT * FROM readings WHERE sensor_type = 'light' ORDER BY event_time DESC, event_id DESC LIMIT 100",
)
def l2_of_store(spark, sf_dir):
    readings = events_as_readings(spark, sf_dir)
    stored = store.read_store(spark, merged_store(spark, readings))
    return reports.latest_readings(stored, "light", order=TIES).select(*readings.columns)


def halves(readings: DataFrame) -> list[DataFrame]:
    """All readings as two batches, one after the other in time."""
    begin, end = readings.agg(F.min("event_time"), F.max("event_time")).first()
    middle = F.lit(begin + (end - begin) / 2).cast("timestamp_ntz")
    return [readings.where(F.col("event_time") < middle), readings.where(F.col("event_time") >= middle)]


@query(
    "S4_raw_sink",
    scored_sql(
        "event_id, event_time, sensor_type, value, ml_anomaly, "
        "CAST(CASE WHEN ml_anomaly THEN 0.95 END AS DOUBLE) AS ml_confidence, simple AS ml_prediction"
    ),
)
def s4(spark, sf_dir):
    path = new_folder(spark, "raw")
    sink = raw_sink(path, new_folder(spark, "history"), order=IN_TIME)
    for number, batch in enumerate(halves(events_as_readings(spark, sf_dir))):
        sink(batch, number)
    return store.read_store(spark, path).select(
        "event_id", "event_time", "sensor_type", "value", "ml_anomaly", "ml_confidence", "ml_prediction"
    )


@query(
    "S5_alert_sink",
    "\nSELECT event_id, event_time, sensor_type, value FROM readings WHERE sensor_type = 'temperature' AND value > 25",
)
def s5(spark, sf_dir):
    path = new_folder(spark, "alerts")
    sink = alert_sink(path)
    for number, batch in enumerate(halves(events_as_readings(spark, sf_dir))):
        sink(alerts.filter_alerts(batch), number)
    return store.read_store(spark, path).select("event_id", "event_time", "sensor_type", "value")


@query(
    "S11_empty_batches",
    """, middle AS (SELECT min(event_time) + (max(event_time) - min(event_time)) / 2 AS m FROM readings)
SELECT event_id, value, CASE WHEN event_time < m THEN 0 ELSE 2 END AS batch FROM readings, middle
WHERE sensor_type = 'temperature' AND value > 25""",
)
def s11(spark, sf_dir):
    """An empty batch between two others leaves nothing in the store."""
    path = new_folder(spark, "alerts")
    sink = alert_sink(path)
    early, late = halves(events_as_readings(spark, sf_dir))
    for number, batch in enumerate([early, early.limit(0), late]):
        sink(alerts.filter_alerts(batch), number)
    return store.read_store(spark, path).select("event_id", "value", F.col("spark_batch_id").cast("int").alias("batch"))


UPSERT_SQL = f""", first AS (SELECT * FROM readings WHERE event_id % 2 = 0 OR building_id = 'B2'),
second AS (SELECT * FROM readings WHERE event_id % 2 = 1 AND building_id <> 'B2'),
versions AS (
  SELECT building_id, sensor_type, {exact_mean()} AS avg_value, max(value) AS max_value, count(*) AS message_count,
         CAST(1 AS BIGINT) AS spark_batch_id FROM first GROUP BY building_id, sensor_type
  UNION ALL
  SELECT building_id, sensor_type, {exact_mean()}, max(value), count(*), CAST(2 AS BIGINT)
  FROM second GROUP BY building_id, sensor_type)
SELECT building_id, sensor_type, max_by(avg_value, spark_batch_id) AS avg_value,
       max_by(max_value, spark_batch_id) AS max_value, max_by(message_count, spark_batch_id) AS message_count,
       max(spark_batch_id) AS spark_batch_id, TIMESTAMP '{SENT_AT}' AS last_update FROM versions GROUP BY building_id, sensor_type"""


@query("S6_upsert_latest", UPSERT_SQL)
def s6(spark, sf_dir):
    # two batches that together are all readings; the second brings no key of building B2
    readings = events_as_readings(spark, sf_dir)
    early = (F.col("event_id") % 2 == 0) | (F.col("building_id") == "B2")
    path = new_folder(spark, "aggregates")
    sink = aggregate_sink(path, as_of=SENT_AT)
    for number, part in enumerate([readings.where(early), readings.where(~early)], start=1):
        sink(reports.running_totals(part, exact=True), number)
    return as_naive(store.KeyedTable(spark, path).read(), "last_update")


# --- streams ---------------------------------------------------------------

AVAILABLE_NOW = {"availableNow": True}


def replayed(spark: SparkSession, sf_dir: str, run: Callable[[DataFrame], list]) -> None:
    """Send all readings through JSON files in two halves of time, running the queries after each."""
    folder = new_folder(spark, "messages")
    for half in halves(events_as_readings(spark, sf_dir)):
        messages.to_messages(half, sent_at=SENT_AT).write.mode("append").text(folder)
        for running in run(messages.read_readings_stream(spark, folder=folder)):
            running.awaitTermination()


def parsed(run: Callable[[DataFrame], list]) -> Callable[[DataFrame], list]:
    return lambda incoming: run(messages.parse_readings(incoming))


STORED_SQL = f"event_time, building_id, room_id, sensor_type, value, {UNIT_SQL} AS unit, 'historical_dataset' AS source"
ARRIVAL = "event_time, building_id, room_id, value"


@query(
    "T1_raw_stream",
    scored_sql(f"{STORED_SQL}, {ANOMALY_SQL}, simple AS ml_prediction", order=ARRIVAL),
)
def t1(spark, sf_dir):
    path, progress = new_folder(spark, "raw"), new_folder(spark, "progress")
    replayed(spark, sf_dir, parsed(lambda df: [live.start_raw_stream(df, path, progress, AVAILABLE_NOW)]))
    stored = store.read_store(spark, path)
    return as_naive(
        stored.select(*MESSAGE_COLUMNS, "ml_anomaly", "ml_confidence", "ml_prediction"), "event_time"
    )


@query("T2_alert_stream", f"\nSELECT {STORED_SQL} FROM readings WHERE sensor_type = 'temperature' AND value > 25")
def t2(spark, sf_dir):
    path, progress = new_folder(spark, "alerts"), new_folder(spark, "progress")
    replayed(spark, sf_dir, parsed(lambda df: [live.start_alert_stream(df, path, progress, AVAILABLE_NOW)]))
    return as_naive(store.read_store(spark, path).select(*MESSAGE_COLUMNS), "event_time")


@query("T3_aggregate_stream", TOTALS_SQL)
def t3(spark, sf_dir):
    path, progress = new_folder(spark, "aggregates"), new_folder(spark, "progress")
    run = parsed(lambda df: [live.start_aggregate_stream(df, path, progress, AVAILABLE_NOW, exact=True)])
    replayed(spark, sf_dir, run)
    return store.KeyedTable(spark, path).read().drop("spark_batch_id", "last_update")


@query(
    "T4_history_stream",
    scored_sql(
        f"event_time, building_id, room_id, sensor_type, value, {ANOMALY_SQL}, simple AS ml_prediction",
        order=ARRIVAL,
        by="building_id, room_id, sensor_type",
    ),
)
def t4(spark, sf_dir):
    path, progress = new_folder(spark, "scores"), new_folder(spark, "progress")
    order = ("event_time", "value")
    run = parsed(lambda df: [live.start_stateful_raw_stream(df, path, progress, AVAILABLE_NOW, order=order)])
    replayed(spark, sf_dir, run)
    columns = ("event_time", "building_id", "room_id", "sensor_type", "value")
    scores = ("ml_anomaly", "ml_confidence", "ml_prediction")
    return as_naive(store.read_store(spark, path).select(*columns, *scores), "event_time")


# --- jobs ------------------------------------------------------------------


@query(
    "C1_preprocess",
    f"""{DEDUP_SQL}, bounds AS (
  SELECT sensor_type, quantile_cont(value, 0.01) AS low, quantile_cont(value, 0.99) AS high
  FROM clean GROUP BY sensor_type),
flagged AS (
  SELECT clean.*, NOT (value BETWEEN low AND high) AS is_outlier, {TIME_FEATURES_SQL}
  FROM clean JOIN bounds USING (sensor_type)){rolling_sql("flagged")}
SELECT * FROM rolled""",
)
def c1(spark, sf_dir):
    return jobs.process(hourly(spark, sf_dir), DEDUP_KEYS, TIES, exact=True)


PIPELINE_SQL = f"""{scores_sql(ARRIVAL)}, averages AS (
  SELECT building_id, sensor_type, avg(value) AS average, count(*) AS n, max(value) AS highest
  FROM readings GROUP BY building_id, sensor_type)
SELECT 'aggregates' AS part, sensor_type, building_id, CAST(sum(n) AS BIGINT) AS message_count, max(highest) AS max_value,
       CAST(NULL AS BIGINT) AS anomalies, CAST(NULL AS DOUBLE) AS prediction_total, round(max(average), 6) AS avg_value
FROM averages GROUP BY sensor_type, building_id
UNION ALL SELECT 'raw', sensor_type, building_id, count(*), max(value), count(ml_anomaly),
       CAST(sum(CAST(simple AS DECIMAL(18,2))) AS DOUBLE), NULL
FROM readings LEFT JOIN scores USING (event_id) GROUP BY sensor_type, building_id
UNION ALL SELECT 'alerts', sensor_type, building_id, count(*), max(value), NULL, NULL, NULL FROM readings
WHERE sensor_type = 'temperature' AND value > 25 GROUP BY sensor_type, building_id"""


def pipeline_stores(spark: SparkSession, sf_dir: str, read_once: bool) -> DataFrame:
    folder, progress = new_folder(spark, "live"), new_folder(spark, "progress")
    replayed(
        spark, sf_dir, lambda incoming: jobs.live(incoming, folder, progress, AVAILABLE_NOW, read_once=read_once)
    )
    keys = ["sensor_type", "building_id"]
    counted = [F.count("*").alias("message_count"), F.max("value").alias("max_value")]
    scored = [
        F.count("ml_anomaly").alias("anomalies"),
        F.sum(F.col("ml_prediction").cast("decimal(18,2)")).cast("double").alias("prediction_total"),
    ]
    parts = {
        "raw": store.read_store(spark, f"{folder}/raw").groupBy(*keys).agg(*counted, *scored),
        "alerts": store.read_store(spark, f"{folder}/alerts").groupBy(*keys).agg(*counted),
        "aggregates": store.KeyedTable(spark, f"{folder}/aggregates")
        .read()
        .select(*keys, "message_count", "max_value", F.round("avg_value", 6).alias("avg_value")),
    }
    return features.union_readings(*[df.select(F.lit(name).alias("part"), "*") for name, df in parts.items()])


@query("C2_live_pipeline", PIPELINE_SQL)
def c2(spark, sf_dir):
    return pipeline_stores(spark, sf_dir, read_once=False)


@query("C2_live_pipeline_read_once", PIPELINE_SQL)
def c2_read_once(spark, sf_dir):
    return pipeline_stores(spark, sf_dir, read_once=True)


@query(
    "C3_operations_summary",
    f""", series AS (
  SELECT * FROM readings WHERE sensor_type = 'temperature' AND {IN_WEEK} ORDER BY event_time, event_id LIMIT 1000)
SELECT max_by(value, event_time) AS last_value, max(value) AS max_value, min(value) AS min_value,
       {exact_mean()} AS mean_value FROM series""",
)
def c3(spark, sf_dir):
    readings = events_as_readings(spark, sf_dir)
    summary = jobs.operations_summary(
        readings, "temperature", WEEK, newest_time(readings), order=TIES, exact=True
    )
    return summary["series_stats"]


def sql_of(name: str) -> str:
    return SQL[name].removeprefix(WITH_READINGS)


SUMMARY_SQL = {
    "totals": sql_of("A5_store_totals"),
    "kpis": sql_of("A2_sensor_kpis"),
    "series": SERIES_SQL,
    "locations": BY_LOCATION_SQL.replace("'co2'", "'temperature'"),
    "latest": f""", latest AS (
  SELECT * FROM readings WHERE sensor_type = 'temperature' ORDER BY event_time DESC, event_id DESC LIMIT 100)
SELECT {DISPLAY_SQL} FROM latest""",
    "alerts": f"""
SELECT * FROM readings WHERE event_time >= {AS_OF} - INTERVAL 60 MINUTES
  AND sensor_type = 'temperature' AND (value < 16 OR value > 28) ORDER BY event_time DESC, event_id DESC LIMIT 5""",
}


def summary_section(section: str) -> Query:
    """One section of the summary, asked of the stored readings."""

    def c3_section(spark, sf_dir):
        readings, folder = events_as_readings(spark, sf_dir), new_folder(spark, "store")
        store.write_batch(readings, folder, 0)
        stored = store.read_store(spark, folder)
        summary = jobs.operations_summary(stored, "temperature", WEEK, newest_time(readings), order=TIES, exact=True)
        found = summary[section]
        return found.select(*readings.columns) if section in ("series", "alerts") else found

    return c3_section


for name, sql in SUMMARY_SQL.items():
    query(f"C3_operations_summary_{name}", sql)(summary_section(name))


def section_from_log(section: str) -> Query:
    """One section of the summary from the partial aggregates of a store of several batches, some merged."""

    def c3_from_log(spark, sf_dir):
        readings = events_as_readings(spark, sf_dir)
        summary = jobs.summary_of_store(
            spark, merged_store(spark, readings), "temperature", WEEK, newest_time(readings), order=TIES, exact=True
        )
        return summary[section]

    return c3_from_log


for name in ("totals", "kpis", "locations"):
    query(f"C3_summary_of_store_{name}", SUMMARY_SQL[name])(section_from_log(name))


@query(
    "C4_historical_messages",
    f"""{SCHEDULE_SQL}
SELECT release_seconds, wait_seconds, sensor_type, value, {UNIT_SQL} AS unit FROM schedule""",
)
def c4(spark, sf_dir):
    sent = jobs.historical_messages(events_as_readings(spark, sf_dir), order=TIES, sent_at=SENT_AT)
    fields = F.from_json("value", fixed.READING_SCHEMA).alias("reading")
    return sent.select("release_seconds", "wait_seconds", fields).select(
        "release_seconds", "wait_seconds", "reading.sensor_type", "reading.value", "reading.unit"
    )


@query("C5_exploration", PROFILE_SQL + " HAVING column_name = 'value'")
def c5(spark, sf_dir):
    described = jobs.exploration(events_as_readings(spark, sf_dir), exact=True)["profile"]
    return rounded(described, "std_value", "q25", "q50", "q75")


def exploration_section(section: str) -> Query:
    def c5_section(spark, sf_dir):
        return jobs.exploration(events_as_readings(spark, sf_dir), order=IN_TIME, exact=True)[section]

    return c5_section


EXPLORATION_SQL = {
    "shapes": sql_of("P14_shapes"),
    "sample": sql_of("P14_first_rows"),
    "missing": sql_of("A10_missing_values"),
    "histogram": HISTOGRAM_SQL,
}

for name, sql in EXPLORATION_SQL.items():
    query(f"C5_exploration_{name}", sql)(exploration_section(name))


# --- readings with gaps ----------------------------------------------------

#: Some readings without a value, with NaN or an infinite one, or of an unknown sensor.
DIRTY_SQL = """, dirty AS (
  SELECT event_id, event_time, building_id, room_id, CASE WHEN event_id % 17 <> 0 THEN sensor_type END AS sensor_type,
         CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 13 = 0 THEN CAST('NaN' AS DOUBLE)
              WHEN event_id % 1009 = 0 THEN CAST('Infinity' AS DOUBLE) ELSE value END AS value FROM readings)"""
NO_NUMBER = "CASE WHEN NOT isnan(value) THEN value END"


def dirty_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.col("event_id")
    value = (
        F.when(number % 11 == 0, None)
        .when(number % 13 == 0, float("nan"))
        .when(number % 1009 == 0, float("inf"))
        .otherwise(F.col("value"))
    )
    sensor = F.when(number % 17 != 0, F.col("sensor_type"))
    return events_as_readings(spark, sf_dir).withColumns({"value": value, "sensor_type": sensor})


@query(
    "A2_sensor_kpis_dirty",
    f"""{DIRTY_SQL}, numbers AS (SELECT sensor_type, {NO_NUMBER} AS value FROM dirty WHERE {IN_WEEK})
SELECT sensor_type, round(CASE WHEN max(value) = CAST('Infinity' AS DOUBLE) THEN max(value)
       ELSE sum(CASE WHEN NOT isinf(value) THEN value END) / count(value) END, 6) AS avg_value,
       max(value) AS max_value, min(value) AS min_value, count(*) AS reading_count FROM numbers GROUP BY sensor_type""",
)
def a2_dirty(spark, sf_dir):
    readings = dirty_readings(spark, sf_dir)
    return reports.sensor_kpis(readings, WEEK, newest_time(readings)).withColumn("avg_value", F.round("avg_value", 6))


@query("F3_range_alerts_dirty", DIRTY_SQL + RANGE_ALERTS_SQL.replace("FROM readings WHERE", "FROM dirty WHERE NOT isnan(value) AND"))
def f3_dirty(spark, sf_dir):
    readings = dirty_readings(spark, sf_dir)
    return alerts.range_alerts(readings, newest_time(readings), WEEK)


@query("S10_read_store_dirty", f"{DIRTY_SQL}\nSELECT event_id, sensor_type, CASE WHEN isnan(value) THEN 'NaN' ELSE "
       "CAST(round(value) AS BIGINT)::VARCHAR END AS shown FROM dirty WHERE value IS NULL OR NOT isinf(value)")
def s10_dirty(spark, sf_dir):
    folder = new_folder(spark, "store")
    store.write_batch(dirty_readings(spark, sf_dir), folder, 0)
    found = store.read_store(spark, folder).where("value IS NULL OR value < double('Infinity') OR isnan(value)")
    shown = F.when(F.isnan("value"), "NaN").otherwise(F.round("value").cast("long").cast("string"))
    return found.select("event_id", "sensor_type", shown.alias("shown"))


#: Readings without a sensor, a value or with NaN: what the other operators make of them.
GAPS_SQL = """, gaps AS (
  SELECT event_id, event_time, building_id, room_id, CASE WHEN event_id % 17 <> 0 THEN sensor_type END AS sensor_type,
         CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 13 = 0 THEN CAST('NaN' AS DOUBLE) ELSE value END AS value FROM readings),
numbers AS (SELECT * REPLACE (CASE WHEN NOT isnan(value) THEN value END AS value) FROM gaps)"""


def readings_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.col("event_id")
    value = F.when(number % 11 == 0, None).when(number % 13 == 0, float("nan")).otherwise(F.col("value"))
    return events_as_readings(spark, sf_dir).withColumns({"value": value, "sensor_type": F.when(number % 17 != 0, F.col("sensor_type"))})


@query("A1_running_totals_gaps", f"{GAPS_SQL}{TOTALS_SQL.replace('FROM readings', 'FROM numbers')}")
def a1_gaps(spark, sf_dir):
    readings = readings_with_gaps(spark, sf_dir)
    return reports.running_totals(readings.withColumn("value", F.when(~F.isnan("value"), F.col("value"))), exact=True)


@query(
    "A10_profile_gaps",
    GAPS_SQL + PROFILE_SQL.replace("FROM readings", "FROM numbers"),
)
def a10_gaps(spark, sf_dir):
    described = quality.profile(readings_with_gaps(spark, sf_dir), exact=True)
    return rounded(described, "std_value", "q25", "q50", "q75")


@query(
    "A10_missing_values_gaps",
    GAPS_SQL + sql_of("A10_missing_values").replace("FROM readings", "FROM numbers"),
)
def a10_missing_gaps(spark, sf_dir):
    return quality.missing_values(readings_with_gaps(spark, sf_dir))


@query(
    "A11_histogram_gaps",
    GAPS_SQL
    + HISTOGRAM_SQL.replace("LEFT JOIN readings ON readings.sensor_type = bins.sensor_type", "LEFT JOIN numbers ON numbers.sensor_type IS NOT DISTINCT FROM bins.sensor_type").replace(
        "FROM readings GROUP BY", "FROM numbers WHERE value IS NOT NULL GROUP BY"
    ),
)
def a11_gaps(spark, sf_dir):
    return quality.histogram(readings_with_gaps(spark, sf_dir), exact=True)


W1_GAPS_SQL = scores_sql("event_time, event_id").replace("FROM readings WHERE", "FROM numbers WHERE value IS NOT NULL AND")


@query("W1_detect_anomalies_gaps", f"{GAPS_SQL}{W1_GAPS_SQL}\nSELECT event_id, sensor_type, {ANOMALY_SQL} FROM gaps LEFT JOIN scores USING (event_id)")
def w1_gaps(spark, sf_dir):
    scored = scoring.detect_anomalies(readings_with_gaps(spark, sf_dir), order=IN_TIME)
    return scored.select("event_id", "sensor_type", "ml_anomaly", "ml_confidence")


@query("W4_rolling_means_gaps", f"{GAPS_SQL}{rolling_sql('numbers')}\nSELECT * EXCLUDE (value) FROM rolled")
def w4_gaps(spark, sf_dir):
    return features.with_rolling_means(readings_with_gaps(spark, sf_dir), order=IN_TIME, exact=True).drop("value")


@query("D1_dedup_readings_gaps", f"{GAPS_SQL}{DEDUP_SQL.replace('FROM readings', 'FROM gaps')}\nSELECT * EXCLUDE (value) FROM clean")
def d1_gaps(spark, sf_dir):
    readings = readings_with_gaps(spark, sf_dir)
    hours = readings.withColumn("event_hour", F.date_trunc("hour", "event_time").cast("timestamp_ntz"))
    return quality.dedup_readings(hours, DEDUP_KEYS, TIES).drop("value")


@query(
    "D2_flag_outliers_gaps",
    GAPS_SQL
    + FLAGGED_SQL.replace("FROM readings GROUP BY", "FROM numbers GROUP BY")
    .replace("readings.*, NOT (value BETWEEN low AND high)", "numbers.*, NOT coalesce(value BETWEEN low AND high, false)")
    .replace("FROM readings JOIN bounds USING (sensor_type)", "FROM numbers JOIN bounds ON numbers.sensor_type IS NOT DISTINCT FROM bounds.sensor_type")
    + "\nSELECT event_id, sensor_type, is_outlier FROM flagged",
)
def d2_gaps(spark, sf_dir):
    return quality.flag_outliers(readings_with_gaps(spark, sf_dir)).select("event_id", "sensor_type", "is_outlier")


BROKEN = "event_id % 97 = 5"


@query(
    "T1_raw_stream_malformed",
    f""", kept AS (SELECT * FROM readings WHERE NOT ({BROKEN})){scores_sql(ARRIVAL).replace("FROM readings WHERE", "FROM kept WHERE")}
SELECT {STORED_SQL}, {ANOMALY_SQL}, simple AS ml_prediction, false AS is_malformed FROM kept LEFT JOIN scores USING (event_id)
UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, true FROM readings WHERE {BROKEN}""",
)
def t1_malformed(spark, sf_dir):
    """Some messages are cut off; they are stored as rows of NULLs."""
    path, progress, folder = (new_folder(spark, name) for name in ("raw", "progress", "messages"))
    for half in halves(events_as_readings(spark, sf_dir)):
        sent = messages.to_messages(half, sent_at=SENT_AT, keep=["event_id"])
        cut = F.when(F.expr(BROKEN), F.substring("value", 1, 20)).otherwise(F.col("value"))
        sent.select(cut.alias("value")).write.mode("append").text(folder)
        incoming = messages.read_readings_stream(spark, folder=folder)
        live.start_raw_stream(messages.parse_readings(incoming), path, progress, AVAILABLE_NOW).awaitTermination()
    stored = store.read_store(spark, path)
    shown = stored.select(*MESSAGE_COLUMNS, "ml_anomaly", "ml_confidence", "ml_prediction", "is_malformed")
    return as_naive(shown, "event_time")


@query(
    "P2_split_malformed",
    f"""
SELECT event_time, sensor_type, value, NULL::VARCHAR AS message FROM readings WHERE NOT ({BROKEN})
UNION ALL SELECT NULL, NULL, NULL, '{{"timestamp":"' || substr(strftime(event_time, '%Y-%m-%dT%H:%M:%S'), 1, 6) FROM readings WHERE {BROKEN}""",
)
def p2_split(spark, sf_dir):
    """The stores of good and of malformed messages together, each batch written twice."""
    sent = messages.to_messages(events_as_readings(spark, sf_dir), sent_at=SENT_AT, keep=["event_id"])
    cut = F.when(F.expr(BROKEN), F.substring("value", 1, 20)).otherwise(F.col("value"))
    parsed = messages.parse_readings(sent.select(cut.alias("value"), F.lit(SENT_AT).cast("timestamp").alias("timestamp")), with_text=True)
    good, bad = new_folder(spark, "good"), new_folder(spark, "rejected")
    sink = splitting_sink(store_sink(good), bad)
    for number in (0, 0):
        sink(parsed, number)
    parts = [store.read_store(spark, good).select("event_time", "sensor_type", "value", F.lit(None).cast("string").alias("message")),
             store.read_store(spark, bad).select("event_time", "sensor_type", F.lit(None).cast("double").alias("value"), "message")]
    return as_naive(features.union_readings(*parts), "event_time")


# --- order of what is written and sent --------------------------------------


def with_place(df: DataFrame, *order: str) -> DataFrame:
    """The place of each row, from 1, in the order of ``order``."""
    placed = with_position(stage_in_order(df, order))
    return placed.withColumn("place", F.col("_position") + 1).drop("_position")


def lines_in_order(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """The rows of CSV files with the place each has, file after file, line after line."""
    rows = spark.read.schema(schema).option("header", True).csv(folder).select("*", F.col("_metadata.file_name").alias("_file"), F.monotonically_increasing_id().alias("_line"))
    return with_place(rows, "_file", "_line").drop("_file", "_line")


IN_FILES = "row_number() OVER (ORDER BY room_id, sensor_type, event_time)"


@query("S7_processed_csv_order", f"\nSELECT event_id, room_id, sensor_type, {IN_FILES} AS place FROM readings")
def s7_order(spark, sf_dir):
    found = lines_in_order(spark, f"{processed_files(spark, sf_dir)}/all", PROCESSED_SCHEMA)
    return found.select("event_id", "room_id", "sensor_type", "place")


@query(
    "S8_processed_csv_by_sensor_order",
    "\nSELECT event_id, sensor_type, row_number() OVER (PARTITION BY sensor_type ORDER BY room_id, event_time) AS place FROM readings",
)
def s8_order(spark, sf_dir):
    folder = processed_files(spark, sf_dir)
    sensors = [r[0] for r in events_as_readings(spark, sf_dir).select("sensor_type").distinct().collect()]  # a handful
    parts = [lines_in_order(spark, f"{folder}/by_sensor/sensor={s}", PROCESSED_SCHEMA) for s in sorted(sensors)]
    return features.union_readings(*parts).select("event_id", "sensor_type", "place")


@query(
    "L6_processed_order",
    f"{DEDUP_SQL}\nSELECT event_id, {IN_FILES} AS place FROM clean",
)
def l6(spark, sf_dir):
    """The processed table in its total order, as its files lie."""
    processed = jobs.process(hourly(spark, sf_dir), DEDUP_KEYS, TIES, exact=True, total_order=True)
    rows = processed.select("event_id", F.col("_metadata.file_name").alias("_file"), F.monotonically_increasing_id().alias("_line"))
    return with_place(rows, "_file", "_line").select("event_id", "place")


NUMBERED_SQL = f"""{SCHEDULE_SQL}
SELECT release_seconds, wait_seconds, 'B' || CAST(substr(building_id, 2) AS VARCHAR) || '/' || room_id || '/' || sensor_type AS key,
       row_number() OVER (PARTITION BY building_id, room_id, sensor_type ORDER BY event_time) AS sequence, row_number() OVER (ORDER BY event_time) AS place,
       strftime(event_time, '%Y-%m-%dT%H:%M:%S') || CASE WHEN epoch_us(event_time) % 1000000 = 0 THEN '' ELSE strftime(event_time, '.%f') END AS "timestamp",
       '2026-01-02T03:04:05' AS kafka_timestamp, building_id, room_id, sensor_type, value, {UNIT_SQL} AS unit, 'historical_dataset' AS source,
       CAST(floor(epoch(event_time)) AS BIGINT) AS original_timestamp FROM schedule"""


@query("C4_numbered_messages", NUMBERED_SQL)
def c4_numbered(spark, sf_dir):
    """All fields of the replayed messages, their numbers within their keys and their places in the whole order."""
    sent = jobs.historical_messages(events_as_readings(spark, sf_dir), order=TIES, sent_at=SENT_AT)
    placed = with_position(messages.numbered(sent)).withColumn("place", F.col("_position") + 1)
    fields = (
        "timestamp STRING, kafka_timestamp STRING, building_id STRING, room_id STRING, sensor_type STRING, "
        "value DOUBLE, unit STRING, source STRING, original_timestamp LONG"
    )
    return placed.select("release_seconds", "wait_seconds", "key", "sequence", "place", F.from_json("value", fields).alias("sent")).select(
        "release_seconds", "wait_seconds", "key", "sequence", "place", "sent.*"
    )


# --- histories with a hot key, and rows in any order -------------------------

#: A third of all readings come from one room.
HOT_SQL = """, hot AS (SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN 'hall' ELSE room_id END AS room_id,
  CASE WHEN event_id % 3 = 0 THEN 'co2' ELSE sensor_type END AS sensor_type) FROM readings)"""


@query(
    "T4_history_stream_hot_key",
    f"""{HOT_SQL}{scores_sql(ARRIVAL, "building_id, room_id, sensor_type").replace("FROM readings WHERE", "FROM hot WHERE")}
SELECT event_time, building_id, room_id, sensor_type, value, {ANOMALY_SQL}, simple AS ml_prediction FROM hot LEFT JOIN scores USING (event_id)""",
)
def t4_hot(spark, sf_dir):
    """Histories by room and sensor, one of them of a third of all rows, which is cut into chunks of 500 rows."""
    path, progress, folder = (new_folder(spark, name) for name in ("scores", "progress", "messages"))
    third = F.col("event_id") % 3 == 0
    for half in halves(events_as_readings(spark, sf_dir)):
        hot = half.withColumns({"room_id": F.when(third, "hall").otherwise(F.col("room_id")), "sensor_type": F.when(third, "co2").otherwise(F.col("sensor_type"))})
        messages.to_messages(hot, sent_at=SENT_AT).write.mode("append").text(folder)
        incoming = messages.parse_readings(messages.read_readings_stream(spark, folder=folder))
        live.start_stateful_raw_stream(incoming, path, progress, AVAILABLE_NOW, order=("event_time", "value"), strategy="chunked", chunk_rows=500).awaitTermination()
    columns = ("event_time", "building_id", "room_id", "sensor_type", "value", "ml_anomaly", "ml_confidence", "ml_prediction")
    return as_naive(store.read_store(spark, path).select(*columns), "event_time")


@query(
    "T4_sorted_stream",
    f"""{scores_sql(ARRIVAL, "room_id, sensor_type")}
SELECT event_time, building_id, room_id, sensor_type, value, {ANOMALY_SQL}, simple AS ml_prediction FROM readings LEFT JOIN scores USING (event_id)""",
)
def t4_sorted(spark, sf_dir):
    """The later half arrives first; rows wait for the watermark, which a clock far ahead moves at the end."""
    path, progress, folder = (new_folder(spark, name) for name in ("scores", "progress", "messages"))
    readings = events_as_readings(spark, sf_dir)
    end = newest_time(readings)
    clock = readings.where(F.col("event_time") == F.lit(end)).select(
        (F.col("event_time") + F.expr("INTERVAL 20000 DAYS")).alias("event_time"), "building_id", "room_id", F.lit("clock").alias("sensor_type"), F.lit(0.0).alias("value")
    )
    before = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, ROCKS_DB)
    try:
        for part in [*reversed(halves(readings)), clock]:
            messages.to_messages(part, sent_at=SENT_AT).write.mode("append").text(folder)
            incoming = messages.parse_readings(messages.read_readings_stream(spark, folder=folder))
            live.start_sorted_raw_stream(
                incoming, path, progress, AVAILABLE_NOW, by=("room_id", "sensor_type"), order=("event_time", "building_id", "value"), delay="9000 days", slot_seconds=86400
            ).awaitTermination()
    finally:
        spark.conf.set(STATE_STORE, before)
    columns = ("event_time", "building_id", "room_id", "sensor_type", "value", "ml_anomaly", "ml_confidence", "ml_prediction")
    stored = store.read_store(spark, path).where("sensor_type <> 'clock'")
    return as_naive(stored.select(*columns), "event_time")
