"""Anomaly flags and next-value predictions from the recent readings of a sensor."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import WindowSpec

from telemetra.functions import fixed_values as fixed
from telemetra.functions.columns import is_valid
from telemetra.operators.ordered import CHUNK_ROWS, with_row_frames

SCORE_TYPES = {"ml_anomaly": "boolean", "ml_confidence": "double", "ml_prediction": "double"}


# Each score is window columns first and an expression over them second: Spark
# evaluates a window function once per column that mentions it.


def history_columns(window: WindowSpec, value: str, history: int = fixed.HISTORY_ROWS) -> dict[str, Column]:
    before = window.rowsBetween(-history, -1)
    return {
        # every row here is a number, so the frame's size is known from the row's place
        "_before": F.least(F.row_number().over(window) - 1, F.lit(history)),
        "_mean": F.avg(value).over(before),
        "_deviation": F.stddev_pop(value).over(before),
    }


def is_anomaly(value: str, threshold: float, minimum: int = fixed.HISTORY_MINIMUM) -> Column:
    """True where the value is more than ``threshold`` deviations off its history, else NULL."""
    distance = F.abs(F.col(value) - F.col("_mean")) / F.nullif(F.col("_deviation"), F.lit(0.0))
    # an infinite value in the history makes the distance NaN, which Spark orders above all numbers
    return F.when((F.col("_before") >= minimum) & (distance > threshold) & ~F.isnan(distance), True)


def recent_columns(window: WindowSpec, value: str, method: str) -> dict[str, Column]:
    rows = fixed.PREDICTION_ROWS
    seen = {"_seen_rows": F.row_number().over(window)}
    if method == "simple":
        return {**seen, "_recent_mean": F.avg(value).over(window.rowsBetween(1 - rows, 0))}
    if method == "trend":
        return {**seen, **{f"_back_{k}": F.lag(value, k).over(window) for k in (1, 3, 4)}}
    raise ValueError(f"unknown method: {method}")


def prediction(value: str, method: str, decimals: int | None) -> Column:
    """``simple``: mean of the last five; ``trend``: last value plus their least-squares slope."""
    current, seen = F.col(value), F.col("_seen_rows")
    if method == "simple":
        expected = F.col("_recent_mean")
    else:
        slope = (2 * (current - F.col("_back_4")) + (F.col("_back_1") - F.col("_back_3"))) / 10
        expected = F.when(seen >= fixed.HISTORY_MINIMUM, current + slope).otherwise(current)
    expected = F.when(seen >= fixed.PREDICTION_ROWS, expected)
    return expected if decimals is None else F.round(expected, decimals)


def detect_anomalies(
    df: DataFrame,
    by: Sequence[str] = ("sensor_type",),
    order: Sequence[str] = ("event_time",),
    threshold: float = fixed.ANOMALY_THRESHOLD,
    sensors: Sequence[str] | None = fixed.SCORED_SENSORS,
    value: str = "value",
    strategy: str = "auto",
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Add ``ml_anomaly`` and ``ml_confidence``, both NULL unless raised.

    The history is the last 50 valid readings before the row in ``order`` among
    rows with equal ``by``. By sensor type it mixes all rooms; for a reading's own
    history pass building, room and sensor type.
    """
    return _score(df, by, order, threshold, None, sensors, value, None, strategy, chunk_rows)


def predict_next(
    df: DataFrame,
    method: str = "simple",
    by: Sequence[str] = ("sensor_type",),
    order: Sequence[str] = ("event_time",),
    sensors: Sequence[str] | None = fixed.SCORED_SENSORS,
    value: str = "value",
    decimals: int | None = 2,
    strategy: str = "auto",
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Add ``ml_prediction`` from the last five valid readings, the current one included."""
    return _score(df, by, order, None, method, sensors, value, decimals, strategy, chunk_rows)


def score_readings(
    df: DataFrame,
    by: Sequence[str] = ("sensor_type",),
    order: Sequence[str] = ("event_time",),
    threshold: float = fixed.ANOMALY_THRESHOLD,
    method: str = "simple",
    sensors: Sequence[str] | None = fixed.SCORED_SENSORS,
    value: str = "value",
    decimals: int | None = 2,
    strategy: str = "auto",
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Anomalies and predictions together, over one sort of the data."""
    return _score(df, by, order, threshold, method, sensors, value, decimals, strategy, chunk_rows)


def is_scored(sensors: Sequence[str] | None, value: str = "value") -> Column:
    """Rows that enter a history: a number, of a sensor type that has one. Never NULL."""
    valid = is_valid(value)
    return valid if sensors is None else valid & F.coalesce(F.col("sensor_type").isin(*sensors), F.lit(False))


def _score(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    threshold: float | None,
    method: str | None,
    sensors: Sequence[str] | None,
    value: str,
    decimals: int | None,
    strategy: str,
    chunk_rows: int,
) -> DataFrame:
    def columns(window: WindowSpec) -> dict[str, Column]:
        history = {} if threshold is None else history_columns(window, value)
        return history if method is None else {**history, **recent_columns(window, value, method)}

    # rows without a history of their own skip the shuffle instead of forming a group nobody needs
    scored = with_row_frames(
        df.where(is_scored(sensors, value)),
        by,
        order,
        columns,
        preceding=fixed.HISTORY_ROWS,
        strategy=strategy,
        chunk_rows=chunk_rows,
    )
    scores = {}
    if threshold is not None:
        scores["ml_anomaly"] = is_anomaly(value, threshold)
        scores["ml_confidence"] = F.when(scores["ml_anomaly"], fixed.ANOMALY_CONFIDENCE)
    if method is not None:
        scores["ml_prediction"] = prediction(value, method, decimals)
    others = df.where(~is_scored(sensors, value))
    return scored.select(*df.columns, *[c.alias(name) for name, c in scores.items()]).union(
        others.select("*", *[F.lit(None).cast(SCORE_TYPES[name]).alias(name) for name in scores])
    )
