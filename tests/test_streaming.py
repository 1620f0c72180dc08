"""Streams give what their batch twins give, after restarts and repeated batches too."""

import json
import os
import random
import time
from datetime import timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import START
from telemetra.functions import fixed_values as fixed
from telemetra.operators import ordered, scale
from telemetra.operators.reports import running_totals
from telemetra.operators.scoring import is_scored, score_readings
from telemetra.plans.jobs import live as live_job
from telemetra.sources import messages, store
from telemetra.sources.staging import shared_folder
from telemetra.streaming import history, queries as live
from telemetra.streaming.history import HistoryScorer
from telemetra.streaming.sinks import READING_ORDER, aggregate_sink, alert_sink, raw_sink, splitting_sink, totals_sink

NOW = {"availableNow": True}
SENSORS = ("temperature", "co2", "humidity", "light")


def text_of(i):
    if i % 97 == 5:
        return "{broken"
    value = None if i % 31 == 0 else 20.0 + (i * 7 % 11) / 10 + (30 if i % 41 == 1 else 0)
    return json.dumps(
        {
            "timestamp": (START + timedelta(seconds=i)).isoformat(),
            "building_id": f"B{i % 2}",
            "room_id": None if i % 19 == 0 else f"R{i % 3}",
            "sensor_type": SENSORS[i * 5 // 7 % 4],
            "value": value,
            "unit": "x",
            "source": "test",
        }
    )


class Feed:
    """A folder of message files, added one slice after the other."""

    def __init__(self, spark, folder):
        self.spark, self.folder, self.sent, self.files = spark, folder, 0, 0
        folder.mkdir()

    def add(self, n, shuffled=False):
        lines = [text_of(i) for i in range(self.sent, self.sent + n)]
        if shuffled:
            random.Random(n).shuffle(lines)
        (self.folder / f"part-{self.files}.txt").write_text("\n".join(lines) + "\n")
        self.sent, self.files = self.sent + n, self.files + 1

    def stream(self, **options):
        source = messages.read_readings_stream(self.spark, folder=str(self.folder), options=options)
        return messages.parse_readings(source)

    def batch(self):
        return messages.parse_readings(messages.read_message_files(self.spark, str(self.folder)))


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path / "messages")


def rows(df, *columns):
    return sorted(map(repr, df.select(*columns).collect()))


def finish(*running):
    for query in running:
        query.awaitTermination()
        assert query.exception() is None


SCORED = ("event_time", "room_id", "sensor_type", "value", "ml_anomaly", "ml_confidence", "ml_prediction")


@pytest.mark.parametrize("strategy", ["auto", "chunked"])
def test_raw_stream_equals_batch_across_restarts(spark, feed, tmp_path, strategy):
    path, progress = str(tmp_path / "raw"), str(tmp_path / "progress")
    for n in (7, 120, 0, 200, 30):
        if n:
            feed.add(n)
        finish(live.start_raw_stream(feed.stream(), path, progress, NOW, strategy=strategy, chunk_rows=50))
    wanted = score_readings(feed.batch(), order=READING_ORDER)
    stored = store.read_store(spark, path)
    assert stored.where("ml_anomaly").count() > 0
    assert rows(stored, *SCORED) == rows(wanted, *SCORED)
    assert stored.where("kafka_timestamp = processed_at").count() == feed.sent


def test_repeated_batch_changes_nothing(spark, feed, tmp_path):
    feed.add(80)
    first = feed.batch().persist()
    feed.add(80)
    second = feed.batch().where(F.col("event_time") >= START + timedelta(seconds=80)).persist()
    path, history = str(tmp_path / "raw"), str(tmp_path / "history")
    sink = raw_sink(path, history, as_of=START)
    sink(first, 0)
    sink(second, 1)
    before = rows(store.read_store(spark, path), *SCORED)
    sink(second, 1)
    assert rows(store.read_store(spark, path), *SCORED) == before
    sink(second.limit(0), 2)
    assert rows(store.read_store(spark, path), *SCORED) == before


def test_history_by_room(spark, feed, tmp_path):
    by = ("building_id", "room_id", "sensor_type")
    path, progress = str(tmp_path / "raw"), str(tmp_path / "progress")
    for n in (300, 300):
        feed.add(n)
        finish(live.start_raw_stream(feed.stream(), path, progress, NOW, by=by))
    wanted = score_readings(feed.batch(), by, READING_ORDER)
    assert rows(store.read_store(spark, path), *SCORED) == rows(wanted, *SCORED)


def test_alert_stream(spark, feed, tmp_path):
    path, progress = str(tmp_path / "alerts"), str(tmp_path / "progress")
    for n in (400, 400):
        feed.add(n)
        finish(live.start_alert_stream(feed.stream(), path, progress, NOW, START))
    stored = store.read_store(spark, path)
    wanted = feed.batch().where("sensor_type = 'temperature' AND value > 25")
    assert rows(stored, "event_time", "value") == rows(wanted, "event_time", "value")
    assert {r[0] for r in stored.select("spark_batch_id").distinct().collect()} == {0, 1}
    assert stored.where(F.col("processed_at") != F.lit(START)).count() == 0


def test_quiet_alert_batch_writes_nothing(spark, feed, tmp_path):
    feed.add(1)
    alert_sink(str(tmp_path / "alerts"))(feed.batch().limit(0), 0)
    assert not (tmp_path / "alerts").exists()


def test_aggregate_stream_equals_batch(spark, feed, tmp_path):
    path, progress = str(tmp_path / "totals"), str(tmp_path / "progress")
    for n in (100, 150, 50):
        feed.add(n)
        finish(live.start_aggregate_stream(feed.stream(maxFilesPerTrigger=1), path, progress, NOW, exact=True))
    columns = ("building_id", "sensor_type", "avg_value", "max_value", "message_count")
    stored = store.KeyedTable(spark, path).read()
    assert rows(stored, *columns) == rows(running_totals(feed.batch(), exact=True), *columns)
    assert stored.where("sensor_type IS NULL").first()["message_count"] == 4  # the broken messages
    assert stored.agg(F.max("spark_batch_id")).first()[0] == 2


def test_aggregate_batch_twice(spark, feed, tmp_path):
    feed.add(50)
    totals = running_totals(feed.batch())
    sink = aggregate_sink(str(tmp_path / "totals"), as_of=START)
    for batch in (0, 1, 1):
        sink(totals, batch)
    stored = store.KeyedTable(spark, str(tmp_path / "totals")).read()
    assert stored.count() == totals.count()
    assert {r[0] for r in stored.select("spark_batch_id").collect()} == {1}


def test_pipeline_names_and_progress(spark, feed, tmp_path):
    feed.add(60)
    started = live.start_pipeline(feed.stream(), str(tmp_path / "out"), str(tmp_path / "progress"), NOW, START)
    assert [q.name for q in started] == ["raw_to_store", "alerts_to_store", "aggregates_to_store"]
    finish(*started)
    for q in started:
        assert (tmp_path / "progress" / q.name / "commits").is_dir()


def test_one_query_fills_the_same_stores(spark, feed, tmp_path):
    for n in (90, 150):
        feed.add(n)
        for kind, once in (("three", False), ("one", True)):
            out, progress = str(tmp_path / kind), str(tmp_path / f"{kind}-progress")
            incoming = messages.read_readings_stream(spark, folder=str(feed.folder))
            finish(*live_job(incoming, out, progress, NOW, START, once))
    columns = ("building_id", "sensor_type", "max_value", "message_count", "spark_batch_id", "last_update")
    for part, names in (("raw", SCORED), ("alerts", ("event_time", "value"))):
        three, one = [store.read_store(spark, str(tmp_path / kind / part)) for kind in ("three", "one")]
        assert rows(one, *names) == rows(three, *names)
    three, one = [store.KeyedTable(spark, str(tmp_path / kind / "aggregates")).read() for kind in ("three", "one")]
    assert rows(one, *columns) == rows(three, *columns)
    averages = [{(r[0], r[1]): r["avg_value"] for r in df.collect()} for df in (three, one)]
    assert averages[0].keys() == averages[1].keys()
    for key, value in averages[0].items():
        assert value == averages[1][key] or averages[1][key] == pytest.approx(value, rel=1e-12)


def test_repeated_totals_change_nothing(spark, feed, tmp_path):
    feed.add(50)
    batch = feed.batch()
    sink = totals_sink(str(tmp_path / "totals"), as_of=START, exact=True)
    for number in (0, 1, 1):
        sink(batch, number)
    found = store.KeyedTable(spark, str(tmp_path / "totals")).read()
    assert found.agg(F.sum("message_count")).first()[0] == 100
    columns = ("building_id", "sensor_type", "avg_value", "max_value")
    assert rows(found, *columns) == rows(running_totals(batch, exact=True), *columns)


def test_passing_tables_go(spark, feed, tmp_path):
    feed.add(60)
    before = staged_folders(spark)
    raw_sink(str(tmp_path / "raw"), str(tmp_path / "history"), strategy="chunked", chunk_rows=50)(feed.batch(), 0)
    assert staged_folders(spark) == before


def staged_folders(spark):
    return {name for name in os.listdir(shared_folder(spark)) if name.startswith(("sorted-", "table-"))}


@pytest.mark.parametrize("by", [("sensor_type",), ("room_id", "sensor_type")])
def test_stateful_stream_equals_batch(spark, feed, tmp_path, by):
    path, progress = str(tmp_path / "scores"), str(tmp_path / "progress")
    for n in (140, 760):
        feed.add(n)
        finish(live.start_stateful_raw_stream(feed.stream(), path, progress, NOW, START, by=by))
    wanted = score_readings(feed.batch(), by, READING_ORDER)
    stored = store.read_store(spark, path)
    assert stored.where("ml_anomaly").count() > 0
    assert rows(stored, *SCORED) == rows(wanted, *SCORED)
    assert stored.where(F.col("kafka_timestamp") == F.lit(START)).count() == feed.sent


@pytest.mark.parametrize("tail", [[99.0], [float("inf"), 1.0, 99.0], [0.1, 0.1, 0.3]])
def test_block_scores_equal_the_loop(tail):
    values = [0.1] * 12 + tail + [0.1, 0.4, 0.2, 7.0] * 30 + [1e6]
    scorer = HistoryScorer(["event_time"], [], 2.5, 0.95, 50, 10, 5)
    found = []
    for block in (values[:7], values[7:8], values[8:100], values[100:]):
        seen = len(found)
        past = values[max(0, seen - 50) : seen]
        found += list(scorer._scores(np.array([*past, *block]), len(past))["ml_anomaly"])
    for i, value in enumerate(values):
        past = values[max(0, i - 50) : i]
        raised = len(past) >= 10 and len(set(past)) > 1 and np.isfinite(past).all()
        raised = raised and abs(value - np.mean(past)) / np.std(past) > 2.5
        assert found[i] is (True if raised else None)


@pytest.fixture
def rocks_db(spark):
    """The state store that timers and map states need."""
    before = spark.conf.get(history.STATE_STORE)
    spark.conf.set(history.STATE_STORE, history.ROCKS_DB)
    yield
    spark.conf.set(history.STATE_STORE, before)


def clock(feed, seconds):
    """A reading that is not scored, far ahead in time."""
    reading = {"timestamp": (START + timedelta(seconds=seconds)).isoformat(), "sensor_type": "occupancy", "value": 1.0, "source": "clock"}
    (feed.folder / f"part-{feed.files}.txt").write_text(json.dumps(reading) + "\n")
    feed.files += 1


@pytest.mark.parametrize("by", [("sensor_type",), ("room_id", "sensor_type")])
def test_sorted_stream_takes_files_in_any_order(spark, feed, tmp_path, rocks_db, by):
    """Files in reverse, rows shuffled, more rows in a slot than in an Arrow block, a restart in between."""
    block = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(block)
    spark.conf.set(block, 20)
    try:
        for _ in range(6):
            feed.add(300, shuffled=True)
        for number in range(6):  # the file source goes by time of modification
            os.utime(feed.folder / f"part-{number}.txt", (time.time() - 5000 - number * 100,) * 2)
        path, progress = str(tmp_path / "scores"), str(tmp_path / "progress")
        settings = {"by": by, "order": READING_ORDER, "delay": "40 minutes", "slot_seconds": 97}
        run = lambda: live.start_sorted_raw_stream(feed.stream(maxFilesPerTrigger=1), path, progress, NOW, START, **settings)
        finish(run())
        assert store.read_store(spark, path).where("ml_prediction IS NOT NULL").isEmpty()  # all wait
        clock(feed, 100_000)
        query = run()
        finish(query)
    finally:
        spark.conf.set(block, before)
    wanted = score_readings(feed.batch(), by, READING_ORDER)
    stored = store.read_store(spark, path)
    assert stored.where("ml_anomaly").count() > 0
    assert rows(stored, *SCORED) == rows(wanted, *SCORED)
    assert history.late_rows(query) == 0
    feed.add(100)  # far behind the watermark now
    query = run()
    finish(query)
    late = feed.batch().where(is_scored(fixed.SCORED_SENSORS)).count() - wanted.where(is_scored(fixed.SCORED_SENSORS)).count()
    assert history.late_rows(query) == late > 50
    assert store.read_store(spark, path).count() == wanted.count() + (100 - late)


def test_sorted_stream_wants_its_state_store(feed):
    feed.add(1)
    with pytest.raises(ValueError, match="providerClass"):
        history.detect_anomalies_stream(feed.stream())


def test_stateful_stream_of_shuffled_rows(spark, feed, tmp_path):
    path, progress = str(tmp_path / "scores"), str(tmp_path / "progress")
    feed.add(2000, shuffled=True)
    finish(live.start_stateful_raw_stream(feed.stream(), path, progress, NOW, START, by=("sensor_type",), strategy="chunked", chunk_rows=60))
    wanted = score_readings(feed.batch(), ("sensor_type",), READING_ORDER)
    assert rows(store.read_store(spark, path), *SCORED) == rows(wanted, *SCORED)


def test_hot_key_of_a_batch_is_divided(spark, tmp_path, monkeypatch):
    """A third of a million rows have one key: scores are the batch's, and no task gets many of them."""
    n, limit = 1_000_000, 20_000
    monkeypatch.setattr(scale, "TASK_ROWS", limit)
    number = F.col("id")
    made = spark.range(n).select(
        F.timestamp_seconds(F.lit(1_700_000_000) + number).alias("event_time"),
        F.lit("B").alias("building_id"),
        F.when(number % 3 == 0, "hot").otherwise(F.concat(F.lit("R"), (F.xxhash64("id") % 997).cast("string"))).alias("room_id"),
        F.lit("co2").alias("sensor_type"),
        (F.abs(F.xxhash64("id", F.lit(1))) % 1000 + F.when(number % 501 == 0, 5000).otherwise(0)).cast("double").alias("value"),
        F.lit(None).cast("timestamp").alias("kafka_time"),
    )
    made.write.parquet(str(tmp_path / "made"))
    readings = spark.read.parquet(str(tmp_path / "made"))
    by, path = ("room_id", "sensor_type"), str(tmp_path / "raw")
    sizes = []
    divided = ordered._chunked

    def watched(df, *args):
        parts = divided(df, *args)
        sizes.append((df.count(), args[-1]))
        return parts

    monkeypatch.setattr(ordered, "_chunked", watched)
    sink = raw_sink(path, str(tmp_path / "history"), by, chunk_rows=limit)
    sink(readings.where("event_time < timestamp_seconds(1700300000)"), 0)
    sink(readings.where("event_time >= timestamp_seconds(1700300000)"), 1)
    assert [(rows > 90_000, size) for rows, size in sizes] == [(True, limit), (True, limit)]  # chunks of as many rows as wanted
    wanted = score_readings(readings, by, READING_ORDER, strategy="plain")
    total = lambda df: df.agg(F.count("*"), F.count("ml_anomaly"), F.sum(F.xxhash64(*SCORED).cast("decimal(38,0)"))).first()
    assert total(store.read_store(spark, path)) == total(wanted)
    state = store.KeyedTable(spark, str(tmp_path / "history")).read()
    assert state.count() == 50 * state.select("room_id").distinct().count()  # 50 values for each key, no more


def test_carried_history_is_read_by_partition(spark, feed, tmp_path):
    """A batch of one room leaves the histories of the others as they are."""
    by, folder = ("building_id", "room_id", "sensor_type"), tmp_path / "history"
    feed.add(900)
    sink = raw_sink(str(tmp_path / "raw"), str(folder), by)
    sink(feed.batch(), 0)
    before = json.loads((folder / "manifests" / "0").read_text())["folders"]
    sink(feed.batch().where("building_id = 'B1' AND room_id = 'R1' AND sensor_type = 'co2'"), 1)
    after = json.loads((folder / "manifests" / "1").read_text())["folders"]
    assert before.keys() == after.keys() and sum(before[p] != after[p] for p in before) == 1


def test_malformed_messages_are_split_off(spark, feed, tmp_path):
    """Good and split-off rows together are the input, after a repeated batch too; the texts are kept."""
    out, progress = tmp_path / "out", str(tmp_path / "progress")
    for n in (150, 150):
        feed.add(n)
        incoming = messages.read_readings_stream(spark, folder=str(feed.folder))
        finish(*live_job(incoming, str(out), progress, NOW, START, split_malformed=True))
    good, rejected = (store.read_store(spark, str(out / name)) for name in ("raw", "rejected"))
    assert good.count() + rejected.count() == feed.sent and good.where("is_malformed").isEmpty()
    assert {r["message"] for r in rejected.collect()} == {"{broken"} and rejected.count() == 4
    wanted = feed.batch().where("NOT is_malformed")
    assert rows(good, *SCORED) == rows(score_readings(wanted, order=READING_ORDER), *SCORED)
    totals = store.KeyedTable(spark, str(out / "aggregates")).read()
    assert totals.where("sensor_type IS NULL").isEmpty() and totals.agg(F.sum("message_count")).first()[0] == feed.sent - 4

    parsed = messages.parse_readings(messages.read_message_files(spark, str(feed.folder)), with_text=True)
    seen = []
    sink = splitting_sink(lambda batch, number: seen.append(batch.count()), str(tmp_path / "again"), START)
    for number in (0, 0, 1, 1):
        sink(parsed, number)
    assert seen == [feed.sent - 4] * 4 and store.read_store(spark, str(tmp_path / "again")).count() == 8
