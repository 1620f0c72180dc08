"""Names, limits and labels that results depend on.

Nothing here is tunable logic; operators take these as default arguments.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import types as T

# --- fixed values: messages ------------------------------------------------
TOPIC = "building-sensors"
READING_SCHEMA = T.StructType(
    [
        T.StructField("timestamp", T.StringType()),
        T.StructField("kafka_timestamp", T.StringType()),
        T.StructField("building_id", T.StringType()),
        T.StructField("room_id", T.StringType()),
        T.StructField("sensor_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("unit", T.StringType()),
        T.StructField("source", T.StringType()),
    ]
)
HISTORICAL_SOURCE = "historical_dataset"
REPLAY_SPEED = 50
SEND_OVERHEAD_SECONDS = 0.001

# --- fixed values: sensors -------------------------------------------------
BUILDING = "SDH_Building"
CSV_SENSORS = ("co2", "humidity", "temperature", "pir", "light")
PIR_NAME = "occupancy"
UNITS = {
    "co2": "ppm",
    "humidity": "%",
    "temperature": "celsius",
    "occupancy": "binary",
    "light": "lux",
}
UNKNOWN_UNIT = "unknown"
DISPLAY_UNITS = {
    "temperature": "°C",
    "humidity": "%",
    "co2": "ppm",
    "light": "lux",
    "pir": "",
    "occupancy": "pers",
}

# --- fixed values: limits --------------------------------------------------


class Limits(NamedTuple):
    """Raise below ``low`` or above ``high``; both bounds are themselves fine."""

    low: float | None = None
    high: float | None = None


class Bands(NamedTuple):
    """Above ``warning`` is a warning, above ``alert`` is an alert."""

    warning: float
    alert: float


STREAM_LIMITS = {
    "temperature": Limits(high=25.0),
    "electricity": Limits(high=5000.0),
}
RANGE_LIMITS = {
    "temperature": Limits(low=16.0, high=28.0),
    "co2": Limits(high=1200.0),
    "humidity": Limits(low=30.0, high=70.0),
}
TAG_LIMITS = {
    "co2": Limits(high=1200.0),
    "humidity": Limits(high=80.0),
    "temperature": Limits(high=28.0),
    "light": Limits(high=800.0),
}
SEVERITY_BANDS = {
    "temperature": Bands(warning=25.0, alert=28.0),
    "co2": Bands(warning=1000.0, alert=1200.0),
    "humidity": Bands(warning=70.0, alert=80.0),
}

# --- fixed values: scoring and features ------------------------------------
SCORED_SENSORS = ("temperature", "co2", "humidity")
HISTORY_ROWS = 50
HISTORY_MINIMUM = 10
ANOMALY_THRESHOLD = 2.5
ANOMALY_CONFIDENCE = 0.95
PREDICTION_ROWS = 5
ROLLING_SENSORS = ("temperature", "co2", "humidity", "light")
ROLLING_ROWS = 10
OUTLIER_QUANTILES = (0.01, 0.99)
HISTOGRAM_BINS = 30

# --- fixed values: reports -------------------------------------------------
PERIOD_MINUTES = (5, 15, 60, 1440)
DEFAULT_PERIOD = 15
SERIES_ROWS = 1000
LATEST_ROWS = 100
ALERT_ROWS = 5
LOCATION_COLUMNS = ("room_id", "location", "building_id", "room")
DISPLAY_LABELS = {
    "value": "Valeur",
    "room_id": "Pièce",
    "building_id": "Bâtiment",
    "location": "Localisation",
    "sensor_id": "ID Capteur",
    "unit": "Unité",
}
DISPLAY_TIME_LABEL = "Heure"
