"""The log of a store: what readers plan from it, what stays while batches merge, and reports from its partial aggregates."""

import math
import shutil
from datetime import timedelta

import pytest
from pyspark import TaskContext
from pyspark.sql import functions as F

from conftest import START
from telemetra.operators import quantiles, reports, rollups
from telemetra.plans.jobs import operations_summary, summary_of_store
from telemetra.sources import store
from telemetra.sources.commits import CommitLog

SENSORS = ("co2", "light", "temperature", None, "a/b=c+d e%")
END = START + timedelta(days=9)


def some_readings(spark, batch, rows=400):
    """Nine days of readings, some without a time, a room, a value; values with four decimals, one of 9e13."""
    number = F.col("id") + batch * rows
    sensors = F.array(*[F.lit(s) for s in SENSORS])
    return spark.range(rows).select(
        number.alias("event_id"),
        F.when(number % 41 > 0, F.timestamp_micros(F.unix_micros(F.lit(START)) + number * 7919 % (9 * 86400) * 1000000)).alias("event_time"),
        F.lit("B").alias("building_id"),
        F.when(number % 13 > 0, F.concat(F.lit("R"), (number % 7).cast("string"))).alias("room_id"),
        F.element_at(sensors, (number % 5 + 1).cast("int")).alias("sensor_type"),
        F.when(number % 17 == 0, None).when(number % 19 == 0, math.nan).when(number == 777, 9e13).otherwise((number * 7 % 1000) / 16).alias("value"),
    )


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("made") / "store")
    for batch in range(5):
        store.write_batch(some_readings(spark, batch), path, batch)
    store.compact(spark, path)
    store.write_batch(some_readings(spark, 5), path, 5)
    return path


@pytest.fixture
def path(made, tmp_path):
    """A copy: the log's paths are those below the store."""
    return shutil.copytree(made, str(tmp_path / "store"))


def shown(df):
    return sorted(map(repr, df.collect()))


def rows_of(df):
    return shown(df.select("event_id", "event_time", "room_id", "sensor_type", "value"))


def test_entries_are_aggregated_by_many_tasks(spark, tmp_path):
    """Without adaptive execution, as below a stateful stream, no task takes all partitions of an entry's aggregates."""
    adaptive = "spark.sql.adaptive.enabled"
    before = spark.conf.get(adaptive)
    spark.conf.set(adaptive, "false")
    try:
        task = F.udf(lambda _: TaskContext.get().taskAttemptId(), "long").asNondeterministic()
        counts = spark.range(1000).groupBy("id").count().withColumn("task", task("count"))
        CommitLog(spark, str(tmp_path))._place(counts, "_commits", "batch-0")
    finally:
        spark.conf.set(adaptive, before)
    entry = spark.read.parquet(f"{tmp_path}/_commits/batch-0")
    assert entry.agg(F.count("*"), F.sum("count")).first() == (1000, 1000)
    assert entry.select("task").distinct().count() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert len(entry.inputFiles()) == 1


def test_all_rows_are_found(spark, path):
    stored = store.read_store(spark, path)
    whole = [some_readings(spark, batch) for batch in range(6)]
    assert rows_of(stored) == sorted(r for df in whole for r in rows_of(df))
    for sensor in SENSORS[:3] + SENSORS[4:]:
        expected = sorted(r for df in whole for r in rows_of(df.where(F.col("sensor_type") == sensor)))
        assert rows_of(store.read_store(spark, path, sensor)) == expected != []
    since, until = START + timedelta(days=2, hours=3), START + timedelta(days=5, minutes=1)
    expected = sorted(r for df in whole for r in rows_of(df.where(F.col("event_time").between(F.lit(since), F.lit(until)))))
    assert rows_of(store.read_store(spark, path, since=since, until=until)) == expected != []
    assert store.read_store(spark, path, "no such sensor").count() == 0


def opened(df):
    return set(df.inputFiles())


def test_files_are_planned_from_the_log(spark, path, monkeypatch):
    """Files of other sensors and days are not opened, and their folders are not listed."""
    log = CommitLog(spark, path)
    assert len(log.files()) == len(opened(store.read_store(spark, path)))
    some = store.read_store(spark, path, "co2", START + timedelta(days=3), START + timedelta(days=4, seconds=-1))
    files = opened(some)
    assert files and all("stored_sensor=sensor-co2/" in f and "event_date=2024-01-04" in f for f in files)
    # a file that the log doesn't name is not there for readers
    stray = some_readings(spark, 9)
    stray.withColumns({"stored_sensor": F.lit("sensor-co2"), "event_date": F.to_date("event_time")}).write.partitionBy("stored_sensor", "event_date").parquet(f"{path}/spark_batch_id=9")
    assert opened(store.read_store(spark, path, "co2", START + timedelta(days=3), START + timedelta(days=4, seconds=-1))) == files


def test_readers_keep_their_files_while_batches_merge(spark, path):
    """A table planned before a merge reads the same rows after it, from the same files."""
    before = store.read_store(spark, path)
    files, expected = opened(before), rows_of(before)
    store.write_batch(some_readings(spark, 6), path, 6)
    store.write_batch(some_readings(spark, 7), path, 7)
    store.compact(spark, path)
    assert opened(before) == files and rows_of(before) == expected
    now = store.read_store(spark, path)
    assert len(rows_of(now)) == len(expected) + 800 and any("_merged-3-5" in f for f in opened(now))


def test_a_batch_without_an_entry_does_not_count(spark, path, monkeypatch):
    """A writer that dies before its entry is in place; the batch run again is whole."""
    expected = rows_of(store.read_store(spark, path))

    def dies(self, name, folder):
        raise OSError("gone")

    with monkeypatch.context() as m:
        m.setattr(CommitLog, "add", dies)
        with pytest.raises(OSError):
            store.write_batch(some_readings(spark, 6), path, 6)
        with pytest.raises(OSError):
            store.compact(spark, path, keep=1)
    assert rows_of(store.read_store(spark, path)) == expected
    for _ in range(2):
        store.write_batch(some_readings(spark, 6), path, 6)
        store.compact(spark, path, keep=1)
        assert len(rows_of(store.read_store(spark, path))) == len(expected) + 400


def test_a_store_without_a_log_is_read_as_it_is(spark, path):
    expected = rows_of(store.read_store(spark, path, "co2"))
    other = f"{path}-plain"
    store.read_store(spark, path).drop("spark_batch_id").write.partitionBy("stored_sensor", "event_date").parquet(other)
    assert rows_of(store.read_store(spark, other, "co2")) == expected
    with pytest.raises(ValueError, match="no log"):
        rollups.stored_totals(spark, other)


PERIODS = [60, 24 * 60, 3 * 24 * 60 + 17, 9 * 24 * 60, 400 * 24 * 60]


@pytest.mark.parametrize("minutes", PERIODS)
def test_reports_equal_those_of_all_rows(spark, path, minutes):
    stored = store.read_store(spark, path)
    for as_of in (END, END - timedelta(hours=5, seconds=1)):
        assert shown(rollups.stored_kpis(spark, path, minutes, as_of, exact=True)) == shown(reports.sensor_kpis(stored, minutes, as_of, exact=True))
        for sensor in ("co2", SENSORS[4]):
            found = rollups.stored_by_location(spark, path, sensor, minutes, as_of, exact=True).collect()
            assert found == reports.by_location(stored, sensor, minutes, as_of, exact=True).collect()
    assert shown(rollups.stored_totals(spark, path)) == shown(reports.store_totals(stored))
    numbers = stored.withColumn("value", F.when(~F.isnan("value"), F.col("value")))
    assert shown(rollups.stored_running_totals(spark, path, exact=True)) == shown(reports.running_totals(numbers, exact=True))


@pytest.mark.parametrize("minutes", PERIODS)
def test_periods_open_two_days_at_most(spark, path, minutes):
    parts = rollups.parts_of_period(spark, path, F.lit(END) - F.expr(f"INTERVAL {minutes} MINUTES"))
    days = {f.split("event_date=")[1].split("/")[0] for f in opened(parts) if "event_date=" in f}
    assert len(days) <= 2
    assert not any("event_date=" in f for f in opened(rollups.stored_totals(spark, path)))


def test_days_of_other_time_zones(spark, tmp_path):
    """Days written in two session time zones overlap; no reading is counted twice or left out."""
    path, before = str(tmp_path / "zones"), spark.conf.get("spark.sql.session.timeZone")
    try:
        for batch, zone in enumerate(("Pacific/Auckland", "America/Los_Angeles", "UTC")):
            spark.conf.set("spark.sql.session.timeZone", zone)
            store.write_batch(some_readings(spark, batch), path, batch)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    stored = store.read_store(spark, path)
    for hours in (1, 7, 20, 49, 100):
        assert shown(rollups.stored_kpis(spark, path, hours * 60, END, exact=True)) == shown(reports.sensor_kpis(stored, hours * 60, END, exact=True))


def test_summary_of_store(spark, path):
    found = summary_of_store(spark, path, "co2", 3 * 24 * 60, END, order=("event_id",), exact=True)
    expected = operations_summary(store.read_store(spark, path), "co2", 3 * 24 * 60, END, order=("event_id",), exact=True)
    assert found.keys() == expected.keys()
    for name in found:
        columns = [c for c in expected[name].columns if c in found[name].columns]
        assert shown(found[name].select(columns)) == shown(expected[name].select(columns)), name


def test_a_lost_log_is_not_guessed(spark, path):
    shutil.rmtree(f"{path}/_commits")
    with pytest.raises(ValueError, match="no log"):
        rollups.stored_kpis(spark, path, 60, END)


@pytest.mark.parametrize("probabilities", [(0.01, 0.99), (0.0, 0.25, 0.5, 1.0)])
def test_quantiles_from_kept_sketches(spark, tmp_path, probabilities):
    """Exact, for groups above and below the size that the sketches are trusted from, with one scan of the store."""
    path = str(tmp_path / "many")
    for batch in range(3):
        readings = some_readings(spark, batch, 20_000).withColumn("value", F.when(F.col("event_id") % 50 > 0, F.col("value") + F.col("event_id") % 7919 / 100))
        store.write_batch(readings.where(F.col("sensor_type").isin("co2", "light") | (F.col("event_id") % 400 == 2) | F.col("sensor_type").isNull()), path, batch)
    store.compact(spark, path, keep=1)
    stored = store.read_store(spark, path)
    expected = {r["sensor_type"]: r["quantiles"] for r in quantiles.exact_quantiles(stored, ["sensor_type"], probabilities, strategy="builtin").collect()}
    found = rollups.stored_quantiles(spark, path, probabilities)
    found = {r["sensor_type"]: r["quantiles"] for r in found.collect()}
    assert found.keys() == expected.keys() and len(found) > 3
    for sensor, values in expected.items():
        assert found[sensor] == pytest.approx(values, rel=1e-12), sensor


def test_sketches_that_miss_cost_a_scan_not_the_result(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "few")
    store.write_batch(some_readings(spark, 0, 5000), path, 0)
    stored = store.read_store(spark, path)
    wrong = CommitLog(spark, path).sketches().withColumn("numbers", F.col("numbers") * 3)
    found = quantiles.quantiles_from_sketches(stored, wrong, ["sensor_type"], (0.5,), margin=1e-6)
    exact = quantiles.exact_quantiles(stored, ["sensor_type"], (0.5,), strategy="builtin")
    assert found.count() == exact.where("quantiles[0] IS NOT NULL").count()
    good = quantiles.quantiles_from_sketches(stored, CommitLog(spark, path).sketches(), ["sensor_type"], (0.5,), margin=1e-9)
    assert shown(good) == shown(exact)  # no sketch is trusted: everything is counted


def test_sketches_bracket_closely(spark, tmp_path):
    """What is left to count is a few hundredths of the rows."""
    path = str(tmp_path / "wide")
    store.write_batch(some_readings(spark, 0, 60_000).where("sensor_type = 'co2'"), path, 0)
    merged = CommitLog(spark, path).sketches().agg(F.kll_merge_agg_double("sketch").alias("s"), F.sum("numbers").alias("n"))
    low, high = merged.select(F.kll_sketch_get_quantile_double("s", F.lit(0.49)), F.kll_sketch_get_quantile_double("s", F.lit(0.51))).first()
    stored = store.read_store(spark, path).where("NOT isnan(value)")
    ranks = stored.select(F.avg((F.col("value") <= low).cast("int")), F.avg((F.col("value") <= high).cast("int"))).first()
    assert 0.47 < ranks[0] < 0.5 < ranks[1] < 0.53
