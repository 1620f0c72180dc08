from datetime import timedelta

import math
import pytest

from conftest import START, column
from telemetra.operators.alerts import filter_alerts, range_alerts, severity_band, tag_high_readings


@pytest.mark.parametrize(
    "sensor, value, raised",
    [
        ("temperature", 25.0, False),
        ("temperature", 25.01, True),
        ("electricity", 5000.0, False),
        ("electricity", 5000.01, True),
        ("co2", 9999.0, False),
        ("temperature", None, False),
        (None, 9999.0, False),
        ("temperature", math.nan, True),  # NaN is the largest double in Spark
    ],
)
def test_stream_limits(readings, sensor, value, raised):
    assert filter_alerts(readings([(sensor, value)])).count() == int(raised)


@pytest.mark.parametrize(
    "sensor, value, raised",
    [
        ("temperature", 16.0, False),
        ("temperature", 15.9, True),
        ("temperature", 28.0, False),
        ("temperature", 28.1, True),
        ("co2", 1200.0, False),
        ("co2", 1200.1, True),
        ("co2", 0.0, False),
        ("humidity", 29.9, True),
        ("humidity", 70.1, True),
        ("light", 9999.0, False),
        ("temperature", math.nan, False),
    ],
)
def test_range_limits(readings, sensor, value, raised):
    assert range_alerts(readings([(sensor, value)]), START).count() == int(raised)


def test_range_alerts_period_and_order(readings):
    df = readings([("co2", 2000.0 + i) for i in range(90)])
    end = START + timedelta(minutes=89)
    assert range_alerts(df, end).count() == 61  # the bound itself counts
    latest = range_alerts(df, end, sensor="co2", newest=5)
    assert [r["value"] for r in latest.collect()] == [2089.0, 2088.0, 2087.0, 2086.0, 2085.0]


def test_tags(readings):
    rows = [("humidity", 80.01), ("light", 800.01), ("co2", 1200.0), ("occupancy", 5.0), ("temperature", 28.004)]
    tagged = tag_high_readings(readings(rows), decimals=2)
    assert column(tagged, "alert_type") == ["high_humidity", "high_light", None, None, "high_temperature"]
    assert column(tagged, "alert") == [True, True, None, None, True]
    assert column(tagged, "alert_threshold") == [80.0, 800.0, None, None, 28.0]
    # compared before rounding
    assert column(tagged, "value")[-1] == 28.0
    assert column(tagged, "alert_value")[-1] == 28.004


def test_severity(readings):
    rows = [("temperature", 25.0), ("temperature", 25.1), ("temperature", 28.1), ("co2", 1001.0), ("light", 9.0)]
    rows += [("humidity", None), ("humidity", math.nan)]
    found = column(severity_band(readings(rows)), "severity")
    assert found == ["normal", "warning", "alert", "warning", None, None, None]
