"""Known scoring results, an independent loop, and equality of the two ways to frame rows."""

import math
import random
from collections import defaultdict, deque

import numpy as np
import pytest

from conftest import column
from telemetra.operators import scale
from telemetra.operators.features import with_rolling_means
from telemetra.operators.replay import replay_schedule
from telemetra.operators.scoring import detect_anomalies, predict_next, score_readings

STEADY = [14.0, 14.2, 13.9, 14.1, 14.3, 13.8, 14.0, 14.4, 14.2]
CLIMB = [15.0 + 0.1 * i for i in range(6)]
ORDER = ("event_time", "event_id")


def flags(df, **options):
    return column(detect_anomalies(df, order=ORDER, **options), "ml_anomaly")


def test_jump_after_nine_values_passes_and_hides_what_follows(readings):
    df = readings([("temperature", v) for v in [*STEADY, 20.0, *CLIMB]])
    assert flags(df) == [None] * 16
    assert column(predict_next(df, order=ORDER), "ml_prediction")[-1] == 15.3
    assert column(predict_next(df, "trend", order=ORDER), "ml_prediction")[-1] == 15.6


def test_short_history_is_never_flagged(readings):
    assert flags(readings([("co2", v) for v in [7.0, 8.0, 7.5, 900.0]])) == [None] * 4


@pytest.mark.parametrize("value, expected", [(4.5, None), (4.6, True)])
def test_threshold_is_strict(readings, value, expected):
    assert flags(readings([("co2", v) for v in [1.0, 3.0] * 5 + [value]]))[-1] is expected


def test_constant_history_is_never_flagged(readings):
    assert flags(readings([("co2", v) for v in [0.1] * 10 + [99.0]]))[-1] is None


def test_infinite_value_is_flagged_and_spoils_its_history(readings):
    values = [1.0, 3.0] * 5 + [float("inf")] + [1.0, 99.0] * 5
    assert flags(readings([("co2", v) for v in values])) == [None] * 10 + [True] + [None] * 10


def test_only_fifty_earlier_values_count(readings):
    # ten wild values first: once fifty tame ones follow, they no longer widen the deviation
    values = [0.0, 1000.0] * 5 + [1.0, 3.0] * 25 + [4.6]
    assert flags(readings([("humidity", v) for v in values]))[-1] is True


def test_prediction_lengths(readings):
    df = readings([("co2", float(v)) for v in [10, 20, 30, 40, 50, 100]])
    assert column(predict_next(df, order=ORDER), "ml_prediction") == [None] * 4 + [30.0, 48.0]
    trend = column(predict_next(df, "trend", order=ORDER), "ml_prediction")
    assert trend == [None] * 4 + [50.0, 100.0]


def test_unknown_method_and_strategy(readings):
    df = readings([("co2", 1.0)])
    with pytest.raises(ValueError):
        predict_next(df, "guess", order=ORDER)
    with pytest.raises(ValueError):
        detect_anomalies(df, order=ORDER, strategy="fast")


def test_confidence_only_where_raised(readings):
    df = readings([("co2", v) for v in [1.0, 3.0] * 5 + [50.0]] + [("light", 9.0)])
    scored = detect_anomalies(df, order=ORDER)
    assert column(scored, "ml_confidence") == [None] * 10 + [0.95, None]


def mixed_rows(n=3000, seed=5):
    rng = random.Random(seed)
    sensors = ["temperature", "co2", "humidity", "light", None]
    rows = []
    for _ in range(n):
        value = rng.choice([rng.gauss(20, 3), rng.gauss(20, 3), rng.gauss(60, 20)])
        if rng.random() < 0.03:
            value = rng.choice([math.nan, None])
        rows.append((rng.choices(sensors, [5, 2, 1, 1, 0.2])[0], value, rng.choice(["R0", "R1", None])))
    return rows


def by_loop(rows):
    history = defaultdict(lambda: deque(maxlen=50))
    result = []
    for sensor, value, _ in rows:
        if sensor not in ("temperature", "co2", "humidity") or value is None or math.isnan(value):
            result.append((None, None))
            continue
        past = history[sensor]
        raised = len(past) >= 10 and np.std(past) > 0 and abs(value - np.mean(past)) / np.std(past) > 2.5
        past.append(value)
        prediction = float(np.mean(list(past)[-5:])) if len(past) >= 5 else None
        result.append((True if raised else None, prediction))
    return result


@pytest.mark.parametrize("options", [{"strategy": "plain"}, {"strategy": "chunked", "chunk_rows": 60}])
def test_against_loop(readings, options):
    rows = mixed_rows()
    expected = by_loop(rows)
    assert sum(1 for flag, _ in expected if flag) > 30
    scored = score_readings(readings(rows), order=ORDER, decimals=None, **options)
    found = scored.orderBy("event_id").select("ml_anomaly", "ml_prediction").collect()
    assert len(found) == len(expected)
    assert [row[0] for row in found] == [flag for flag, _ in expected]
    for (_, value), (_, wanted) in zip(found, expected):
        assert (value is None) == (wanted is None)
        assert value is None or value == pytest.approx(wanted, rel=1e-12)


@pytest.mark.parametrize("chunk_rows", [50, 51, 333, 5000])
def test_chunks_do_not_show(readings, chunk_rows):
    df = readings(mixed_rows(2000))
    by = ("building_id", "room_id", "sensor_type")

    def rows(**options):
        scored = score_readings(df, by, ORDER, method="trend", **options)
        return sorted(map(repr, scored.drop("value").collect()))

    assert rows(strategy="chunked", chunk_rows=chunk_rows) == rows(strategy="plain")


@pytest.mark.parametrize("by", [("sensor_type",), ("room_id", "sensor_type"), ()])
def test_hot_groups_alone_are_chunked(readings, monkeypatch, by):
    df = readings(mixed_rows(2500))

    def rows(**options):
        scored = score_readings(df, by, ORDER, method="trend", **options)
        return sorted(map(repr, scored.drop("value").collect())), scored

    wanted, _ = rows(strategy="chunked", chunk_rows=100)
    monkeypatch.setattr(scale, "TASK_ROWS", 300)
    found, scored = rows(chunk_rows=100)
    assert found == wanted
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_chunk" in plan
    if by:
        assert plan.count("stddev_pop(") == 2 and "LeftAnti" in plan


def test_chunk_must_cover_the_frame(readings):
    with pytest.raises(ValueError):
        detect_anomalies(readings([("co2", 1.0)]), order=ORDER, strategy="chunked", chunk_rows=49)


def test_chunked_without_rows(readings):
    df = readings([("light", 1.0)])
    assert flags(df, strategy="chunked") == [None]


@pytest.mark.parametrize("options", [{"strategy": "plain"}, {"strategy": "chunked", "chunk_rows": 9}])
def test_rolling_means_against_pandas(readings, options):
    rows = mixed_rows(400)
    df = readings(rows)
    means = with_rolling_means(df, order=ORDER, **options).orderBy("event_id")
    pandas = df.orderBy("event_id").toPandas()
    for sensor in ("temperature", "co2", "humidity", "light"):
        chosen = pandas[pandas.sensor_type == sensor]
        rolled = chosen.groupby("room_id", dropna=False)["value"].transform(
            lambda s: s.rolling(10, min_periods=1).mean()
        )
        wanted = [rolled.get(i, math.nan) for i in range(len(rows))]
        found = [math.nan if r[0] is None else r[0] for r in means.select(f"{sensor}_rolling_mean").collect()]
        np.testing.assert_allclose(found, wanted, rtol=1e-9)


@pytest.mark.parametrize("chunk_rows", [1, 7, 1000])
def test_replay_waits(readings, chunk_rows):
    timed = replay_schedule(readings([("co2", 1.0)] * 20), 60, order=("event_id",), chunk_rows=chunk_rows)
    assert column(timed, "gap_seconds") == [60.0] * 19 + [None]
    assert column(timed, "wait_seconds") == [0.999] * 19 + [0.0]
    assert column(timed, "release_seconds") == [float(i) for i in range(20)]
