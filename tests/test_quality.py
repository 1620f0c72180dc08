import math
import random

import numpy as np
import pytest

from conftest import column
from telemetra.operators.quality import dedup_readings, flag_outliers, histogram, missing_values, profile
from telemetra.operators.quantiles import exact_quantiles


def numbers(n, seed):
    rng = random.Random(seed)
    kinds = [lambda: rng.gauss(0, 1), lambda: round(rng.random(), 1), lambda: 7.0, lambda: rng.expovariate(1e-6)]
    # 7.0 makes up a third of everything
    return [rng.choices(kinds, [1, 1, 1.2, 0.3])[0]() for _ in range(n)]


@pytest.mark.parametrize("accuracy", [10, 50, 10_000])
def test_bracketed_quantiles(readings, accuracy):
    groups = {"co2": numbers(2000, 1), "light": numbers(37, 2), "humidity": [3.5], None: numbers(500, 3)}
    rows = [(s, v) for s, values in groups.items() for v in values]
    rows += [("co2", None), ("co2", math.nan), ("empty", None), ("empty", math.nan)]
    probabilities = [0.0, 0.01, 0.25, 0.5, 0.99, 1.0]
    df = readings(rows)
    found = exact_quantiles(df, ["sensor_type"], probabilities, strategy="bracketed", accuracy=accuracy)
    found = {r["sensor_type"]: r["quantiles"] for r in found.collect()}
    builtin = exact_quantiles(df, ["sensor_type"], probabilities, strategy="builtin")
    assert set(found) == {"co2", "light", "humidity", None, "empty"}
    assert found["empty"] in (None, [None] * len(probabilities))
    for sensor, values in groups.items():
        np.testing.assert_allclose(found[sensor], np.quantile(values, probabilities), rtol=1e-12)
    for row in builtin.where("sensor_type <> 'empty'").collect():
        np.testing.assert_allclose(found[row["sensor_type"]], row["quantiles"], rtol=1e-15)


def test_quantiles_reject_unknown_strategy(readings):
    with pytest.raises(ValueError):
        exact_quantiles(readings([("co2", 1.0)]), ["sensor_type"], [0.5], strategy="quick")


def test_groups_are_needed_where_joined(readings):
    with pytest.raises(ValueError):
        histogram(readings([("co2", 1.0)]), by=())


@pytest.mark.parametrize("strategy", ["builtin", "bracketed"])
def test_outliers_include_missing_values(readings, strategy):
    rows = [("co2", float(i)) for i in range(101)] + [("co2", None), ("co2", math.nan), ("gone", None)]
    flagged = flag_outliers(readings(rows), strategy=strategy)
    assert column(flagged, "is_outlier") == [True] + [False] * 99 + [True] * 4


def test_dedup_keeps_the_first(readings):
    df = readings([("co2", 1.0), ("co2", 2.0), ("co2", 3.0), ("light", 4.0), (None, 5.0), (None, 6.0)])
    kept = dedup_readings(df, ["room_id", "sensor_type"], ["event_id"])
    assert column(kept, "value") == [1.0, 4.0, 5.0]


def test_histogram_like_numpy(readings):
    rng = random.Random(3)
    values = [round(rng.gauss(50, 20), 2) for _ in range(800)]
    rows = [("co2", v) for v in values] + [("light", float(i)) for i in range(11)] + [("humidity", 4.0)] * 3
    rows += [("co2", None), ("co2", math.nan), ("gone", None)]
    bins = histogram(readings(rows)).orderBy("sensor_type", "bin").collect()
    for sensor, data in {"co2": values, "light": range(11), "humidity": [4.0] * 3}.items():
        counts, edges = np.histogram(list(data), 30)
        found = [r for r in bins if r["sensor_type"] == sensor]
        assert [r["value_count"] for r in found] == counts.tolist()
        np.testing.assert_allclose([r["bin_start"] for r in found], edges[:-1], rtol=1e-9, atol=1e-12)
        assert found[0]["mean_value"] == pytest.approx(float(np.mean(list(data))))
    assert not [r for r in bins if r["sensor_type"] == "gone"]


def test_profile_like_pandas(readings):
    rows = [("co2", v) for v in numbers(300, 9)] + [("co2", None), ("co2", math.nan)]
    df = readings(rows)
    found = profile(df, columns=["value"]).first()
    described = df.toPandas()["value"].describe()
    assert found["missing_count"] == 2
    names = {
        "value_count": "count", "mean_value": "mean", "std_value": "std", "min_value": "min",
        "q25": "25%", "q50": "50%", "q75": "75%", "max_value": "max",
    }
    for ours, theirs in names.items():
        assert found[ours] == pytest.approx(described[theirs], rel=1e-9)


def test_missing_values(readings):
    found = missing_values(readings([("co2", None), (None, math.nan), ("co2", 1.0)]))
    counts = {r["column_name"]: (r["data_type"], r["row_count"], r["missing_count"]) for r in found.collect()}
    assert counts["value"] == ("double", 3, 2)
    assert counts["sensor_type"] == ("string", 3, 1)
    assert counts["event_id"] == ("bigint", 3, 0)


def test_histogram_counts_infinite_values(readings):
    rows = [("co2", 1.0), ("co2", float("inf")), ("co2", 3.0), ("light", float("-inf"))]
    bins = histogram(readings(rows), bins=2).orderBy("sensor_type", "bin").collect()
    assert [(r["sensor_type"], r["value_count"], r["infinite_count"]) for r in bins] == [
        ("co2", 1, 1), ("co2", 1, 1), ("light", 0, 1), ("light", 0, 1),
    ]
    assert [r["bin_start"] for r in bins] == [1.0, 2.0, -0.5, 0.0]
