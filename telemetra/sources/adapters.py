"""The given test tables seen as sensor readings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

EVENTS_SQL = """
    SELECT event_id,
           ts AS event_time,
           'B' || CAST(user_id % 3 AS VARCHAR) AS building_id,
           'R' || CAST(user_id % 10 AS VARCHAR) AS room_id,
           CASE event_type WHEN 'click' THEN 'temperature' WHEN 'view' THEN 'co2' WHEN 'error' THEN 'humidity'
                           WHEN 'purchase' THEN 'occupancy' ELSE 'light' END AS sensor_type,
           CASE event_type WHEN 'view' THEN value * 10 WHEN 'signup' THEN value * 5 ELSE value END AS value
    FROM events"""

LINEITEM_SQL = """
    SELECT l_shipdate AS event_time,
           'B' || CAST(l_suppkey % 10 AS VARCHAR) AS building_id,
           'R' || CAST(l_suppkey AS VARCHAR) AS room_id,
           'electricity' AS sensor_type,
           l_extendedprice AS value
    FROM lineitem"""


def events_as_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, "events", EVENTS_SQL)


def lineitem_as_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, "lineitem", LINEITEM_SQL)


def _view(spark: SparkSession, sf_dir: str, table: str, sql: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    source = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    return spark.sql(sql.replace("VARCHAR", "STRING").replace(f"FROM {table}", "FROM {source}"), source=source)


def newest_time(df: DataFrame, time: str = "event_time") -> object:
    """The instant that reports on stored data take as their "now"."""
    return df.agg(F.max(time)).first()[0]
