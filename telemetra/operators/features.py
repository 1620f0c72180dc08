"""Row-wise and rolling features, and the period filter."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from telemetra.functions import fixed_values as fixed
from telemetra.functions.columns import STORED_DAYS, STORED_SENSOR, lookup, mean, number, stored_sensor
from telemetra.operators.ordered import CHUNK_ROWS, with_row_frames


def since(df: DataFrame, as_of: object, minutes: int, time: str = "event_time") -> Column:
    """At or after ``as_of`` minus the period; compared in the column's own type, so it is pushed down."""
    start = F.lit(as_of).cast(df.schema[time].dataType) - F.expr(f"INTERVAL {int(minutes)} MINUTES")
    after = F.col(time) >= start
    day = STORED_DAYS.get(time)
    if day in df.columns:
        # a store's days are those of the session that wrote it, hence the day before as well
        after &= F.col(day) >= F.date_sub(F.to_date(start), 1)
    return after


def of_sensor(df: DataFrame, sensor: str) -> Column:
    """Whether a reading is of the sensor; prunes the directories of a store."""
    wanted = F.col("sensor_type") == sensor
    if STORED_SENSOR in df.columns:
        wanted &= F.col(STORED_SENSOR) == stored_sensor(F.lit(sensor))
    return wanted


def recent(
    df: DataFrame,
    sensor: str,
    minutes: int = fixed.DEFAULT_PERIOD,
    as_of: object = None,
    time: str = "event_time",
) -> DataFrame:
    """Readings of one sensor in the period that ends at ``as_of`` (default: now)."""
    end = F.current_timestamp() if as_of is None else as_of
    return df.where(of_sensor(df, sensor) & since(df, end, minutes, time))


def with_unit(df: DataFrame, display: bool = False) -> DataFrame:
    if display:
        return df.withColumn("unit", lookup("sensor_type", fixed.DISPLAY_UNITS, ""))
    return df.withColumn("unit", lookup("sensor_type", fixed.UNITS, fixed.UNKNOWN_UNIT))


def with_time_features(df: DataFrame, time: str = "event_time") -> DataFrame:
    """hour, day_of_week (Monday = 0), is_weekend (0 or 1), month, day."""
    weekday = F.weekday(time)
    return df.withColumns(
        {
            "hour": F.hour(time),
            "day_of_week": weekday,
            "is_weekend": weekday.isin(5, 6).cast("int"),
            "month": F.month(time),
            "day": F.dayofmonth(time),
        }
    )


def with_rolling_means(
    df: DataFrame,
    by: Sequence[str] = ("room_id", "sensor_type"),
    order: Sequence[str] = ("event_time",),
    rows: int = fixed.ROLLING_ROWS,
    sensors: Sequence[str] = fixed.ROLLING_SENSORS,
    exact: bool = False,
    strategy: str = "auto",
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """One ``<sensor>_rolling_mean`` column per sensor: mean of its last ten readings in the room.

    Missing values take a place in the ten rows but not in the mean.
    """
    names = {sensor: f"{sensor}_rolling_mean" for sensor in sensors}
    rolled = F.coalesce(F.col("sensor_type").isin(*sensors), F.lit(False))
    framed = with_row_frames(
        df.where(rolled),
        by,
        order,
        lambda window: {"_mean": mean(number("value"), exact, window.rowsBetween(1 - rows, 0))},
        preceding=rows - 1,
        strategy=strategy,
        chunk_rows=chunk_rows,
    )
    framed = framed.select(
        *df.columns, *[F.when(F.col("sensor_type") == s, F.col("_mean")).alias(n) for s, n in names.items()]
    )
    others = df.where(~rolled).select("*", *[F.lit(None).cast("double").alias(n) for n in names.values()])
    return framed.union(others)


def union_readings(*parts: DataFrame) -> DataFrame:
    """All rows of all parts, columns matched by name, absent ones NULL."""
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), parts)
