"""Rule-based alerts. The rule sets differ on purpose; each operator has its own default."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from telemetra.functions import fixed_values as fixed
from telemetra.functions.columns import is_valid, lookup, outside, severity
from telemetra.functions.fixed_values import Bands, Limits
from telemetra.operators.features import of_sensor, since


def filter_alerts(df: DataFrame, rules: Mapping[str, Limits] = fixed.STREAM_LIMITS) -> DataFrame:
    """Readings strictly outside the limits of their sensor, for batches and streams alike."""
    return df.where(outside(rules))


def range_alerts(
    df: DataFrame,
    as_of: object,
    minutes: int = 60,
    sensor: str | None = None,
    rules: Mapping[str, Limits] = fixed.RANGE_LIMITS,
    time: str = "event_time",
    order: Sequence[str] = (),
    newest: int | None = None,
) -> DataFrame:
    """Readings out of range in the last ``minutes``; ``newest`` keeps that many, latest first."""
    found = df.where(outside(rules) & is_valid("value") & since(df, as_of, minutes, time))
    if sensor is not None:
        found = found.where(of_sensor(df, sensor))
    if newest is None:
        return found
    return found.orderBy(F.desc(time), *[F.desc(c) for c in order]).limit(newest)


def tag_high_readings(
    df: DataFrame, rules: Mapping[str, Limits] = fixed.TAG_LIMITS, decimals: int | None = None
) -> DataFrame:
    """Add alert, alert_type, alert_value, alert_threshold, all NULL where nothing is raised.

    ``decimals`` rounds ``value`` after the comparison; alert_value stays as measured.
    """
    limit = lookup("sensor_type", {name: bound.high for name, bound in rules.items()})
    high = is_valid("value") & (F.col("value") > limit)
    tagged = df.select(
        "*",
        F.when(high, True).alias("alert"),
        F.when(high, F.concat(F.lit("high_"), F.col("sensor_type"))).alias("alert_type"),
        F.when(high, F.col("value")).alias("alert_value"),
        F.when(high, limit).alias("alert_threshold"),
    )
    return tagged if decimals is None else tagged.withColumn("value", F.round("value", decimals))


def severity_band(df: DataFrame, bands: Mapping[str, Bands] = fixed.SEVERITY_BANDS) -> DataFrame:
    return df.withColumn("severity", severity(bands))
