import os
import sys
from datetime import datetime, timedelta

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

START = datetime(2024, 1, 1)


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.maxMetadataStringLength", "2000")
        .config("spark.driver.memory", "8g")
        .config("spark.python.unix.domain.socket.enabled", "true")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def readings(spark):
    """Readings from (sensor_type, value) or (sensor_type, value, room_id), one a minute."""

    def make(rows):
        full = [
            (i, START + timedelta(minutes=i), "B0", row[2] if len(row) > 2 else "R0", row[0], row[1])
            for i, row in enumerate(rows)
        ]
        return spark.createDataFrame(
            full,
            "event_id LONG, event_time TIMESTAMP, building_id STRING, room_id STRING, "
            "sensor_type STRING, value DOUBLE",
        )

    return make


def column(df, name, order="event_id"):
    return [row[name] for row in df.orderBy(order).select(name).collect()]
