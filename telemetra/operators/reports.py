"""Answers to the usual operational questions about stored readings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from telemetra.functions import fixed_values as fixed
from telemetra.functions.columns import STORED_DAYS, mean, number
from telemetra.operators.features import of_sensor, recent, since


def running_totals(
    df: DataFrame, by: Sequence[str] = ("building_id", "sensor_type"), exact: bool = False
) -> DataFrame:
    """Average, maximum and number of readings per key, for batches and streams alike."""
    return df.groupBy(*by).agg(
        mean("value", exact).alias("avg_value"),
        F.max("value").alias("max_value"),
        F.count("*").alias("message_count"),
    )


def sensor_kpis(
    df: DataFrame,
    minutes: int,
    as_of: object,
    time: str = "event_time",
    newest: int | None = None,
    order: Sequence[str] = (),
    exact: bool = False,
) -> DataFrame:
    """Per sensor type in the period; ``newest`` looks only at that many latest readings of each."""
    readings = df.where(since(df, as_of, minutes, time))
    if newest is not None:
        latest = Window.partitionBy("sensor_type").orderBy(F.desc(time), *[F.desc(c) for c in order])
        readings = readings.withColumn("_age", F.row_number().over(latest)).where(F.col("_age") <= newest)
    value = number("value")
    return readings.groupBy("sensor_type").agg(
        mean(value, exact).alias("avg_value"),
        F.max(value).alias("max_value"),
        F.min(value).alias("min_value"),
        F.count("*").alias("reading_count"),
    )


def series_stats(
    df: DataFrame,
    by: Sequence[str] = (),
    time: str = "event_time",
    order: Sequence[str] = (),
    exact: bool = False,
) -> DataFrame:
    """Last value in time (ties broken by ``order``), maximum, minimum and mean."""
    value = number("value")
    latest = F.struct(time, *order) if order else F.col(time)  # a lone column can be hash-aggregated
    return df.groupBy(*by).agg(
        F.max_by("value", latest).alias("last_value"),
        F.max(value).alias("max_value"),
        F.min(value).alias("min_value"),
        mean(value, exact).alias("mean_value"),
    )


def location_column(df: DataFrame, candidates: Sequence[str] = fixed.LOCATION_COLUMNS, fill: bool = False) -> Column:
    """The first candidate the table has; ``fill`` lets later ones replace its NULLs."""
    present = [c for c in candidates if c in df.columns]
    if not present:
        raise ValueError(f"none of {', '.join(candidates)} is a column")
    return F.coalesce(*present) if fill else F.col(present[0])


def by_location(
    df: DataFrame,
    sensor: str,
    minutes: int,
    as_of: object,
    time: str = "event_time",
    fill: bool = False,
    exact: bool = False,
) -> DataFrame:
    """Mean and number of readings per location, highest mean first."""
    return (
        recent(df, sensor, minutes, as_of, time)
        .groupBy(location_column(df, fill=fill).alias("location"))
        .agg(mean(number("value"), exact).alias("avg_value"), F.count("*").alias("reading_count"))
        .orderBy(F.desc("avg_value"), "location")
    )


def store_totals(df: DataFrame) -> DataFrame:
    """All readings and the number of sensor types, a missing type counting as one."""
    per_type = df.groupBy("sensor_type").agg(F.count("*").alias("n"))
    return per_type.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("reading_count"), F.count("*").alias("sensor_types")
    )


def processing_summary(df: DataFrame, time: str = "event_time") -> DataFrame:
    """Rows, rooms, sensors, first and last time. Grouped first, so distinct counts see few rows."""
    pairs = df.groupBy("room_id", "sensor_type").agg(
        F.count("*").alias("n"), F.min(time).alias("first"), F.max(time).alias("last")
    )
    return pairs.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        F.count_distinct("room_id").alias("rooms"),
        F.count_distinct("sensor_type").alias("sensors"),
        F.min("first").alias("first_time"),
        F.max("last").alias("last_time"),
    )


def processing_summary_by_sensor(df: DataFrame, exact: bool = False) -> DataFrame:
    """Rows, mean (2 decimals) and rooms per sensor, in the order of its name."""
    value = number("value")
    if exact:
        value = value.cast("decimal(18,4)")
    pairs = df.groupBy("sensor_type", "room_id").agg(
        F.count("*").alias("n"), F.sum(value).alias("total"), F.count(value).alias("numbers")
    )
    average = F.sum("total").cast("double") / F.nullif(F.sum("numbers"), F.lit(0))
    return (
        pairs.groupBy("sensor_type")
        .agg(
            F.sum("n").alias("row_count"),
            F.round(average, 2).alias("mean_value"),
            F.count("room_id").alias("rooms"),
        )
        .orderBy("sensor_type")
    )


def time_series(
    df: DataFrame,
    sensor: str,
    minutes: int,
    as_of: object,
    time: str = "event_time",
    order: Sequence[str] = (),
    limit: int = fixed.SERIES_ROWS,
    newest: bool = False,
) -> DataFrame:
    """Readings of a sensor in the period, oldest first; beyond ``limit`` the oldest are kept, or the newest."""
    keys = [time, *order]
    found = recent(df, sensor, minutes, as_of, time)
    if newest:
        found = found.orderBy(*[F.desc(c) for c in keys]).limit(limit)
        return found.orderBy(*keys)
    return found.orderBy(*keys).limit(limit)


def latest_readings(
    df: DataFrame, sensor: str, limit: int = fixed.LATEST_ROWS, time: str = "event_time", order: Sequence[str] = ()
) -> DataFrame:
    """The latest readings of a sensor over all time, newest first.

    Of a store, which knows each row's day, the rows are counted by day first (no other column is
    read); only the days from the one that completes ``limit`` are read whole.
    """
    found = df.where(of_sensor(df, sensor))
    day = STORED_DAYS.get(time)
    if day in df.columns:
        per_day = found.where(F.col(day).isNotNull()).groupBy(day).agg(F.count("*").alias("n"))
        newest = Window.orderBy(F.desc(day))  # a row for each day
        enough = per_day.withColumn("so_far", F.sum("n").over(newest)).where(F.col("so_far") >= limit)
        first = enough.agg(F.max(day)).first()[0]
        if first is not None:
            # days are those of the sessions that wrote them, so a day may begin up to 26 hours apart
            found = found.where(F.col(day) >= F.date_sub(F.lit(first), 2))
    return found.orderBy(F.desc(time), *[F.desc(c) for c in order]).limit(limit)


def first_rows(
    df: DataFrame, by: Sequence[str] = ("room_id", "sensor_type"), order: Sequence[str] = ("event_time",), rows: int = 2
) -> DataFrame:
    """A look at the data: the first rows of every group."""
    window = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("_place", F.row_number().over(window)).where(F.col("_place") <= rows).drop("_place")


def shapes(df: DataFrame, by: Sequence[str] = ("room_id", "sensor_type")) -> DataFrame:
    """Rows of every group."""
    return df.groupBy(*by).agg(F.count("*").alias("row_count"))


def display_readings(
    df: DataFrame,
    time: str = "event_time",
    labels: Mapping[str, str] = fixed.DISPLAY_LABELS,
    time_label: str = fixed.DISPLAY_TIME_LABEL,
) -> DataFrame:
    """Time of day and the columns the table has, under their display names."""
    shown = [F.col(name).alias(label) for name, label in labels.items() if name in df.columns]
    if time in df.columns:
        shown.insert(0, F.date_format(F.col(time).cast("timestamp"), "HH:mm:ss").alias(time_label))
    return df.select(*shown)
