from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import START, column
from telemetra.operators import reports
from telemetra.operators.features import recent, union_readings, with_time_features, with_unit
from telemetra.plans.jobs import exploration, operations_summary


def test_weekday_starts_on_monday(spark):
    days = [(datetime(2024, 1, 1, 23),), (datetime(2024, 1, 6),), (datetime(2024, 1, 7),)]
    found = with_time_features(spark.createDataFrame(days, "event_time TIMESTAMP")).orderBy("event_time").collect()
    assert [(r["hour"], r["day_of_week"], r["is_weekend"], r["month"], r["day"]) for r in found] == [
        (23, 0, 0, 1, 1),
        (0, 5, 1, 1, 6),
        (0, 6, 1, 1, 7),
    ]


def test_units(readings):
    df = readings([("co2", 1.0), ("pir", 1.0), ("electricity", 1.0), (None, 1.0), ("occupancy", 1.0)])
    assert column(with_unit(df), "unit") == ["ppm", "unknown", "unknown", "unknown", "binary"]
    assert column(with_unit(df, display=True), "unit") == ["ppm", "", "", "", "pers"]


def test_recent_includes_its_bound(readings):
    df = readings([("co2", 1.0)] * 30)
    assert recent(df, "co2", 15, START + timedelta(minutes=29)).count() == 16
    assert recent(df, "light", 15, START).count() == 0
    assert recent(df, "co2").count() == 0  # long ago


def test_totals_with_null_keys(readings):
    df = readings([("co2", 1.0), ("co2", None), (None, 3.0), (None, None)])
    found = {r["sensor_type"]: r for r in reports.running_totals(df).collect()}
    assert (found["co2"]["avg_value"], found["co2"]["max_value"], found["co2"]["message_count"]) == (1.0, 1.0, 2)
    assert found[None]["message_count"] == 2
    assert reports.store_totals(df).first().asDict() == {"reading_count": 4, "sensor_types": 2}


def test_reports_on_nothing(readings):
    df = readings([])
    assert reports.store_totals(df).first().asDict() == {"reading_count": 0, "sensor_types": 0}
    assert reports.processing_summary(df).first()["row_count"] == 0
    assert reports.sensor_kpis(df, 5, START).count() == 0


def test_series_keeps_oldest_or_newest(readings):
    df = readings([("co2", float(i)) for i in range(20)])
    end = START + timedelta(minutes=19)
    oldest = reports.time_series(df, "co2", 60, end, order=["event_id"], limit=3)
    newest = reports.time_series(df, "co2", 60, end, order=["event_id"], limit=3, newest=True)
    assert [r["value"] for r in oldest.collect()] == [0.0, 1.0, 2.0]
    assert [r["value"] for r in newest.collect()] == [17.0, 18.0, 19.0]
    stats = reports.series_stats(oldest).first()
    assert (stats["last_value"], stats["max_value"], stats["min_value"], stats["mean_value"]) == (2.0, 2.0, 0.0, 1.0)


def test_locations(readings):
    df = readings([("co2", 1.0, "R1"), ("co2", 5.0, None), ("co2", 3.0, "R1"), ("light", 9.0, "R1")])
    found = reports.by_location(df, "co2", 60, START + timedelta(minutes=3))
    assert [tuple(r) for r in found.collect()] == [(None, 5.0, 1), ("R1", 2.0, 2)]
    filled = reports.by_location(df, "co2", 60, START + timedelta(minutes=3), fill=True)
    assert filled.first()["location"] == "B0"
    with pytest.raises(ValueError):
        reports.location_column(df.select("value"))


def test_display_shows_what_there_is(readings):
    df = readings([("co2", 1.0)]).withColumn("unit", F.lit("ppm"))
    shown = reports.display_readings(df)
    assert shown.columns == ["Heure", "Valeur", "Pièce", "Bâtiment", "Unité"]
    assert shown.first()["Heure"] == "00:00:00"
    assert reports.display_readings(df.select("value")).columns == ["Valeur"]


def test_union_by_name(readings):
    left = readings([("co2", 1.0)]).select("value", "room_id")
    right = readings([("co2", 2.0)]).select("sensor_type", "value")
    both = union_readings(left, right)
    assert sorted(tuple(r) for r in both.select("value", "room_id", "sensor_type").collect()) == [
        (1.0, "R0", None),
        (2.0, None, "co2"),
    ]


def test_summary_and_exploration(readings):
    df = readings([("co2", 1000.0 + i) for i in range(300)])
    summary = operations_summary(df, "co2", 5, START + timedelta(minutes=299), order=["event_id"])
    assert {name: part.count() for name, part in summary.items()} == {
        "totals": 1, "kpis": 1, "series": 6, "series_stats": 1, "locations": 1, "latest": 100, "alerts": 5,
    }
    report = exploration(df)
    assert report["sample"].count() == 2
    assert report["shapes"].first()["row_count"] == 300
    assert report["histogram"].agg(F.sum("value_count")).first()[0] == 300
    assert report["profile"].first()["q50"] == 1149.5


def test_exact_mean_of_values_beyond_the_decimal(spark, readings):
    for values, wanted in (((0.1, 0.2), 0.15), ((1.0, float("inf")), float("inf")), ((1e15, 3e15), 2e15), ((None,), None)):
        found = reports.running_totals(readings([("co2", v) for v in values]), exact=True).first()["avg_value"]
        assert found == (wanted if wanted is None else pytest.approx(wanted))
