"""Reports from a store's partial aggregates: whole days from its log, raw rows only where a period cuts a day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from telemetra.functions import fixed_values as fixed
from telemetra.operators.features import union_readings
from telemetra.operators.quantiles import quantiles_from_sketches
from telemetra.operators.reports import location_column
from telemetra.sources.commits import KEYS, CommitLog, partial_aggregates

_ADDED = {"rows": F.sum, "numbers": F.sum, "fitting": F.sum, "exact_total": F.sum, "total": F.sum, "high": F.max, "low": F.min}


def together(name: str) -> Column:
    return _ADDED[name](name)


def mean_of_parts(exact: bool) -> Column:
    """The mean that ``columns.mean`` gives, from sums and counts."""
    count = F.nullif(together("numbers"), F.lit(0))
    plain = together("total") / count
    if not exact:
        return plain
    return F.when(together("fitting") == together("numbers"), together("exact_total").cast("double") / count).otherwise(plain)


def parts_of_period(spark: SparkSession, path: str, start: object, time: str = "event_time", sensor: str | None = None) -> DataFrame:
    """Partial aggregates of all readings from ``start`` on, by building, room and sensor type.

    A day counts as whole if no reading of it is before ``start``: its aggregates come from the log. Files
    are opened only of days that ``start`` cuts, one of them, or two where sessions of several time zones have written.
    """
    log = CommitLog(spark, path)
    entries = log.entries()
    if entries is None:
        raise ValueError(f"{path} has no log; read it and use the reports on rows")
    if f"last_{time}" not in entries.columns:
        raise ValueError(f"{path} is not laid out by {time}")
    day = {"event_time": "event_date", "processed_at": "processed_date"}[time]
    bound = F.lit(start).cast(entries.schema[f"last_{time}"].dataType)
    if sensor is not None:
        entries = entries.where(F.col("sensor_type") == sensor)
    first, last = F.min(f"first_{time}"), F.max(f"last_{time}")
    days = entries.groupBy(day).agg((first >= bound).alias("whole"), (last >= bound).alias("inside"))
    cut = sorted(row[0] for row in days.where("inside AND NOT whole").select(day).collect())  # one or two days
    keys = [c for c in KEYS if c in entries.columns]
    parts = list(_ADDED)
    if not cut:
        return entries.where(F.col(f"first_{time}") >= bound).select(*keys, *parts)
    whole = entries.where((F.col(f"first_{time}") >= bound) & ~F.col(day).isin(cut)).select(*keys, *parts)
    wanted = F.col(day).isin(cut) & (F.col(f"last_{time}") >= bound)
    if sensor is not None:
        wanted &= F.col("sensor_type") == sensor
    rows = union_readings(*log.read(log.files(wanted))).where(F.col(day).isin(cut) & (F.col(time) >= bound))
    if sensor is not None:
        rows = rows.where(F.col("sensor_type") == sensor)
    return whole.unionByName(rows.groupBy(*keys).agg(*partial_aggregates()).select(*keys, *parts))


def _start(as_of: object, minutes: int) -> Column:
    return F.lit(as_of) - F.expr(f"INTERVAL {int(minutes)} MINUTES")


def stored_totals(spark: SparkSession, path: str) -> DataFrame:
    """As ``reports.store_totals`` of the store; reads the log only."""
    entries = CommitLog(spark, path).entries()
    if entries is None:
        raise ValueError(f"{path} has no log; read it and use the reports on rows")
    per_type = entries.groupBy("sensor_type").agg(F.sum("rows").alias("n"))
    return per_type.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("reading_count"), F.count("*").alias("sensor_types"))


def stored_kpis(spark: SparkSession, path: str, minutes: int, as_of: object, time: str = "event_time", exact: bool = False) -> DataFrame:
    """As ``reports.sensor_kpis`` of the store."""
    parts = parts_of_period(spark, path, _start(as_of, minutes), time)
    return parts.groupBy("sensor_type").agg(
        mean_of_parts(exact).alias("avg_value"),
        together("high").alias("max_value"),
        together("low").alias("min_value"),
        together("rows").alias("reading_count"),
    )


def stored_by_location(
    spark: SparkSession,
    path: str,
    sensor: str,
    minutes: int,
    as_of: object,
    time: str = "event_time",
    fill: bool = False,
    exact: bool = False,
    candidates: Sequence[str] = fixed.LOCATION_COLUMNS,
) -> DataFrame:
    """As ``reports.by_location`` of the store."""
    parts = parts_of_period(spark, path, _start(as_of, minutes), time, sensor)
    return (
        parts.groupBy(location_column(parts, candidates, fill).alias("location"))
        .agg(mean_of_parts(exact).alias("avg_value"), together("rows").alias("reading_count"))
        .orderBy(F.desc("avg_value"), "location")
    )


def stored_running_totals(spark: SparkSession, path: str, by: Sequence[str] = ("building_id", "sensor_type"), exact: bool = False) -> DataFrame:
    """Average, maximum and number of all stored readings per key, some of building, room and sensor type; reads the log only.

    NaN is no number here, as in the other reports on stores.
    """
    entries = CommitLog(spark, path).entries()
    if entries is None:
        raise ValueError(f"{path} has no log; read it and use the reports on rows")
    return entries.groupBy(*by).agg(mean_of_parts(exact).alias("avg_value"), together("high").alias("max_value"), together("rows").alias("message_count"))


def stored_quantiles(spark: SparkSession, path: str, probabilities: Sequence[float] = fixed.OUTLIER_QUANTILES) -> DataFrame:
    """Exact quantiles of all stored readings by sensor type: brackets from the kept sketches, one scan of the values inside."""
    log = CommitLog(spark, path)
    sketches = log.sketches()
    if sketches is None:
        raise ValueError(f"{path} has no log; read it and use exact_quantiles")
    values = union_readings(*[part.select("sensor_type", "value") for part in log.read(log.files())])
    return quantiles_from_sketches(values, sketches, ["sensor_type"], probabilities)
