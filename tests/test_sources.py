"""Sensor files, messages and stored tables."""

import csv
import json
import math
import os
import shutil
from datetime import datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F, types as T

from conftest import START, column
from telemetra.operators.reports import latest_readings, running_totals
from telemetra.operators.scoring import score_readings
from telemetra.plans.jobs import historical_messages, operations_summary, preprocess, process
from telemetra.sources import messages, staging, store
from telemetra.sources.adapters import events_as_readings
from telemetra.sources.csv_tree import read_sensor_csv
from telemetra.sources import keyed
from telemetra.sources.staging import shared_folder, stage, stage_in_order

BASE_TIME = 1377299108


@pytest.fixture
def tree(tmp_path):
    files = {
        "413/co2.csv": "time,value\n1377299108,450.5\n1377299109,\n1377299110,470\n1377299110,999\n",
        "413/temperature.csv": "time,value\n1377299108,22.5\n1377299168,23.5\n",
        "413/pir.csv": "time,value\n1377299108,1\n",
        "413/notes.csv": "time,value\n1377299108,7\n",
        "415/co2.csv": "time,value,quality\n1377299108,500.25,9\n",
        "415/light.csv": "value\n1377299108\n1377299109\n",  # a single column: left out
        "417/humidity.csv": "time,value\n1377299108,40\n1377299109\n",  # a short line: kept, without a value
        "stray.csv": "time,value\n1377299108,1\n",
    }
    for name, text in files.items():
        path = tmp_path / "tree" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)
    return str(tmp_path / "tree")


def rows_of(df):
    return sorted((r["room_id"], r["sensor_type"], r["timestamp_unix"], r["value"]) for r in df.na.fill(-1.0).collect())


def test_sensor_tree(spark, tree):
    df = read_sensor_csv(spark, tree)
    assert rows_of(df) == [
        ("413", "co2", BASE_TIME, 450.5),
        ("413", "co2", BASE_TIME + 1, -1.0),
        ("413", "co2", BASE_TIME + 2, 470.0),
        ("413", "co2", BASE_TIME + 2, 999.0),
        ("413", "occupancy", BASE_TIME, 1.0),
        ("413", "temperature", BASE_TIME, 22.5),
        ("413", "temperature", BASE_TIME + 60, 23.5),
        ("415", "co2", BASE_TIME, 500.25),
        ("417", "humidity", BASE_TIME, 40.0),
        ("417", "humidity", BASE_TIME + 1, -1.0),
    ]
    first = df.first()
    assert first["building_id"] == "SDH_Building"
    assert df.agg(F.min("event_time")).first()[0] == datetime(2013, 8, 23, 23, 5, 8)


def test_sensor_tree_options(spark, tree):
    df = read_sensor_csv(spark, tree, map_pir=False, rooms=["413"])
    assert {r[0] for r in df.select("room_id").distinct().collect()} == {"413"}
    assert "pir" in {r[0] for r in df.select("sensor_type").distinct().collect()}
    unchecked = read_sensor_csv(spark, tree, check_width=False)
    assert unchecked.where("sensor_type = 'light'").count() == 2


@pytest.mark.parametrize("total_order", [False, True])
def test_preprocess_writes_everything(spark, tree, tmp_path, total_order):
    folder = str(tmp_path / "out")
    processed = preprocess(spark, tree, folder, total_order=total_order)
    assert processed.count() == 9  # one duplicate
    assert [r["value"] for r in processed.where(f"timestamp_unix = {BASE_TIME + 2}").collect()] == [470.0]
    # the missing values and the extremes of each sensor lie outside its quantiles
    assert processed.where("value IS NULL AND is_outlier").count() == 2
    full = spark.read.option("header", True).csv(f"{folder}/all")
    assert full.count() == 9
    assert full.columns == (
        "timestamp_unix value room_id sensor_type building_id timestamp is_outlier hour day_of_week is_weekend month "
        "day temperature_rolling_mean co2_rolling_mean humidity_rolling_mean light_rolling_mean"
    ).split()
    assert full.agg(F.min("timestamp")).first()[0] == "2013-08-23 23:05:08"
    by_sensor = spark.read.option("header", True).csv(f"{folder}/by_sensor")
    assert by_sensor.where("sensor = 'pir'").count() == 1
    summary = spark.read.option("header", True).csv(f"{folder}/summary").first()
    assert (summary["row_count"], summary["rooms"], summary["sensors"]) == ("9", "3", "4")
    per_sensor = spark.read.option("header", True).csv(f"{folder}/summary_by_sensor").collect()
    assert sorted((r["sensor_type"], r["row_count"], r["rooms"]) for r in per_sensor) == [
        ("co2", "4", "2"), ("humidity", "2", "1"), ("pir", "1", "1"), ("temperature", "2", "1"),
    ]


def test_files_to_scores_and_summary(spark, tmp_path):
    lines = [f"{BASE_TIME + i},{20 + i % 3}" for i in range(30)] + [f"{BASE_TIME + 29},90"]
    (tmp_path / "413").mkdir()
    (tmp_path / "413" / "co2.csv").write_text("\n".join(["time,value", *lines]) + "\n")
    loaded = read_sensor_csv(spark, str(tmp_path))
    for options in ({}, {"strategy": "chunked", "chunk_rows": 50}):
        by = ("room_id", "sensor_type")
        scored = score_readings(loaded, by, ("event_time", "source_row"), **options)
        assert [r["value"] for r in scored.where("ml_anomaly").collect()] == [90.0]
    table = process(loaded)
    summary = operations_summary(table, "co2", 60, as_of="2013-08-23 23:30:00")
    assert summary["totals"].first()["reading_count"] == 30
    assert summary["kpis"].first()["max_value"] == 22.0


def parsed(spark, *texts):
    lines = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id INT, value STRING")
    stamped = lines.select(F.col("value").cast("binary").alias("value"), F.timestamp_seconds("id").alias("timestamp"))
    return messages.parse_readings(stamped).orderBy("kafka_time").collect()


def test_malformed_messages_stay(spark):
    found = parsed(spark, "{bad", "[1,2]", "null", "", "{}")
    assert len(found) == 5
    assert all(r["is_malformed"] and r["value"] is None and r["sensor_type"] is None for r in found)
    lines = spark.createDataFrame([("{bad",), ('{"value":1}',)], "value STRING")
    lines = lines.withColumn("timestamp", F.current_timestamp())
    assert messages.parse_readings(lines, keep_malformed=False).count() == 1


def test_parsed_values(spark):
    found = parsed(
        spark,
        '{"sensor_type":"co2","value":1}',
        '{"sensor_type":"co2","value":NaN}',
        '{"sensor_type":"co2","value":"12.5"}',
        '{"sensor_type":"co2","value":"abc"}',
        '{"sensor_type":"co2","timestamp":"2024-01-01T10:00:00.5","alert":true,"simulation_time":3}',
        '{"sensor_type":"co2","timestamp":"noon"}',
    )
    assert [r["sensor_type"] for r in found] == ["co2"] * 6
    assert found[0]["value"] == 1.0 and math.isnan(found[1]["value"])
    assert found[2]["value"] is None and found[3]["value"] is None
    assert found[4]["event_time"] == datetime(2024, 1, 1, 10, 0, 0, 500000)
    assert found[5]["event_time"] is None and found[5]["timestamp"] == "noon"
    assert not any(r["is_malformed"] for r in found)


def test_messages_there_and_back(spark, readings):
    df = readings([("co2", 450.125), ("pir", 1.0), ("light", math.nan), ("humidity", None)])
    sent = messages.to_messages(df, source="test", sent_at=START, keep=["event_id"])
    first = json.loads(sent.orderBy("event_id").first()["value"])
    assert first == {
        "timestamp": "2024-01-01T00:00:00",
        "kafka_timestamp": "2024-01-01T00:00:00",
        "building_id": "B0",
        "room_id": "R0",
        "sensor_type": "co2",
        "value": 450.125,
        "unit": "ppm",
        "source": "test",
        "original_timestamp": 1704067200,
    }
    back = messages.parse_readings(sent.withColumn("timestamp", F.current_timestamp())).orderBy("event_time").collect()
    assert [r["unit"] for r in back] == ["ppm", "unknown", "lux", "%"]
    assert back[0]["event_time"] == START and math.isnan(back[2]["value"]) and back[3]["value"] is None


def test_historical_messages(spark, tree):
    sent = historical_messages(read_sensor_csv(spark, tree), 60, sent_at=START)
    due = sorted(r["release_seconds"] for r in sent.collect())
    assert len(due) == 10 and due[0] == 0.0 and due[-1] == 1.0


def test_stream_source_needs_one_place(spark):
    with pytest.raises(ValueError):
        messages.read_readings_stream(spark)
    with pytest.raises(ValueError):
        messages.read_readings_stream(spark, servers="kafka:9092", folder="/tmp")


def test_kafka_is_configuration(spark):
    with pytest.raises(AnalysisException, match="kafka"):  # the connector is not among the jars here
        messages.read_readings_stream(spark, servers="kafka:9092", options={"maxOffsetsPerTrigger": 10})


def test_batch_is_replaced_when_written_again(spark, readings, tmp_path):
    path = str(tmp_path / "store")
    df = readings([("co2", 1.0), ("light", 2.0), (None, 3.0)])
    store.write_batch(df, path, 0)
    store.write_batch(df, path, 0)
    store.write_batch(df.withColumn("event_time", F.expr("event_time + INTERVAL 2 DAYS")), path, 1)
    assert store.read_store(spark, path).count() == 6
    assert store.read_store(spark, path, sensor="co2").count() == 2
    later = store.read_store(spark, path, since=datetime(2024, 1, 2))
    assert later.count() == 3 and set(column(later, "spark_batch_id", "event_time")) == {1}
    assert store.read_store(spark, path, "light", datetime(2024, 1, 1), datetime(2024, 1, 2)).count() == 1


def test_batches_merge(spark, readings, tmp_path):
    path = str(tmp_path / "store")

    def write(batch):
        rows = readings([("co2", float(batch)), (None, 2.0), ("light", math.nan)])
        rows = rows.withColumns({"processed_at": F.lit(START) + F.make_dt_interval(F.lit(batch)), "event_time": F.when(F.col("value") != 2, F.col("event_time"))})
        store.write_batch(rows, path, batch)

    def stored(**options):
        return sorted(map(repr, store.read_store(spark, path, **options).select("spark_batch_id", "event_id", "event_time", "sensor_type", "value", "processed_at").collect()))

    for batch in range(5):
        write(batch)
    before = stored()
    assert len(before) == 15
    store.compact(spark, path)
    assert (tmp_path / "store" / "_merged-0-2").exists() and stored() == before
    write(4)  # as after a restart
    assert stored() == before
    write(5), write(6)
    before = stored()
    store.compact(spark, path)
    assert not (tmp_path / "store" / "spark_batch_id=2").exists() and (tmp_path / "store" / "spark_batch_id=4").exists()
    assert stored() == before and len(before) == 21
    shutil.rmtree(tmp_path / "store" / "_commits" / "merged-3-4")  # as if the writer had died
    assert stored() == before
    store.compact(spark, path)
    store.compact(spark, path)
    assert stored() == before
    assert sorted(f.name for f in (tmp_path / "store").iterdir()) == ["_commits", "_merged-0-2", "_merged-3-4", "_sketches", "spark_batch_id=5", "spark_batch_id=6"]
    later = store.read_store(spark, path, "co2", datetime(2024, 1, 4), time="processed_at")
    assert sorted(r["value"] for r in later.collect()) == [3.0, 4.0, 5.0, 6.0]
    scans = later._jdf.queryExecution().executedPlan().toString().split("PartitionFilters:")[1:]
    # the first merge has nothing of that time and is not opened
    assert len(scans) == 2 and all("processed_date" in s.split("PushedFilters")[0] and "stored_sensor" in s.split("PushedFilters")[0] for s in scans)


def test_latest_readings_of_a_store_read_few_days(spark, readings, tmp_path):
    path = str(tmp_path / "store")
    df = readings([("co2", float(i)) for i in range(40)] + [("light", 1.0)]).withColumn("event_time", F.expr("event_time + make_interval(0, 0, 0, event_id)"))
    store.write_batch(df.withColumn("event_time", F.when(F.col("event_id") != 39, F.col("event_time"))), path, 0)
    found = latest_readings(store.read_store(spark, path), "co2", 5)
    filters = found._jdf.queryExecution().executedPlan().toString().split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert "event_date" in filters
    assert [r["value"] for r in found.collect()] == [38.0, 37.0, 36.0, 35.0, 34.0]
    all_of = latest_readings(store.read_store(spark, path), "co2", 60).collect()  # more than there are: those without a time come last
    assert len(all_of) == 40 and all_of[-1]["value"] == 39.0
    assert latest_readings(store.read_store(spark, path), "pir", 5).count() == 0


def test_one_file_per_small_directory(spark, readings, tmp_path):
    df = readings([(sensor, float(i)) for i in range(50) for sensor in ("co2", "light")]).repartition(8)
    store.write_batch(df, str(tmp_path / "store"), 0)
    for sensor in ("co2", "light"):
        files = list((tmp_path / "store").glob(f"spark_batch_id=0/stored_sensor=sensor-{sensor}/*/*.parquet"))
        assert len(files) == 1


def test_store_prunes(spark, readings, tmp_path):
    path = str(tmp_path / "store")
    store.write_batch(readings([("co2", 1.0), ("light", 2.0)]), path, 0)
    found = store.read_store(spark, path, "co2", datetime(2024, 1, 1))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "stored_sensor" in plan.split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert "event_date" in plan.split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert "GreaterThanOrEqual(event_time" in plan


def test_upsert_matches_null_keys(spark, readings):
    def totals(rows, batch):
        return running_totals(readings(rows)).withColumn("spark_batch_id", F.lit(batch))

    first = totals([("co2", 1.0), (None, 2.0), ("light", 3.0)], 1)
    second = totals([("co2", 10.0), (None, 20.0)], 2)
    for existing, batch in ((first, second), (second, first)):
        merged = store.upsert_latest(existing, batch, ["building_id", "sensor_type"])
        assert {r["sensor_type"]: r["max_value"] for r in merged.collect()} == {"co2": 10.0, None: 20.0, "light": 3.0}
    assert store.upsert_latest(None, first, ["building_id", "sensor_type"]).count() == 3


def test_keyed_table_versions(spark, tmp_path):
    table = store.KeyedTable(spark, str(tmp_path / "keyed"))
    assert table.read() is None
    for batch in (0, 3, 4, 9):
        table.write(spark.range(batch + 1), batch)
    assert table.read().count() == 10
    assert table.read(before=9).count() == 5
    assert table.read(before=4) is None  # outdated versions are gone
    (tmp_path / "keyed" / "manifests" / "9").unlink()  # as if the writer had died
    assert table.read().count() == 5
    table.write(spark.range(2), 9)
    assert table.read().count() == 2


def test_a_batch_rewrites_the_partitions_it_touches(spark, tmp_path):
    """One changed key of a million: one partition of all is written, read by its keys, and stays the same when run again."""
    path = str(tmp_path / "keyed")
    table = store.KeyedTable(spark, path, ["k"])
    table.write(spark.range(1_000_000).select(F.col("id").alias("k"), F.lit(0).alias("v")), 0)
    begun = manifest_of(path, 0)["folders"]
    assert len(begun) == keyed.PARTITIONS

    def change(batch_id):
        batch = spark.createDataFrame([(77, 1), (None, 5)], "k LONG, v INT").where("k IS NOT NULL OR " + str(batch_id == 2))
        touched = table.touched(batch, before=batch_id)
        earlier = table.read(before=batch_id, only=touched)
        assert earlier.count() < 2.2 * len(touched) * 1_000_000 / keyed.PARTITIONS
        changed = batch.select(F.col("k").alias("key"), F.col("v").alias("more"))
        merged = earlier.join(changed, F.col("k").eqNullSafe(F.col("key")), "full").select(F.coalesce("k", "key").alias("k"), (F.coalesce("v", F.lit(0)) + F.coalesce("more", F.lit(0))).alias("v"))
        table.write(merged, batch_id, touched)
        return touched

    for batch_id in (1, 1, 1):  # run again: builds on the version before it
        assert len(change(batch_id)) == 1
        after = manifest_of(path, 1)["folders"]
        assert sum(after[p] != begun[p] for p in begun) == 1
        assert table.read().where("v <> 0").collect() == [(77, 1)] and table.read().count() == 1_000_000
    touched = change(2)
    other = store.KeyedTable(spark, path)  # a new start knows keys and partitions from the table
    assert len(touched) == 2 and set(other.touched(spark.range(77, 78).select(F.col("id").alias("k")))) < set(touched)
    assert {tuple(r) for r in other.read().where("v <> 0").collect()} == {(77, 2), (None, 5)}
    assert table.read(before=2).where("v <> 0").collect() == [(77, 1)]
    with pytest.raises(ValueError, match="not replaced"):
        table.write(spark.range(1000).select(F.col("id").alias("k"), F.lit(0).alias("v")), 3, [1])


def manifest_of(path, number):
    return json.loads(open(f"{path}/manifests/{number}").read())


def test_keyed_table_keeps_two_versions_of_files(spark, tmp_path):
    path = str(tmp_path / "keyed")
    table = store.KeyedTable(spark, path, ["k"], 4)
    rows = lambda v: spark.range(40).select(F.col("id").alias("k"), F.lit(v).alias("v"))
    for number in range(6):
        table.write(rows(number), number)
    table.write(rows(99), 5)  # again
    folders = [p for p in (tmp_path / "keyed" / "data").glob("*/*") if p.is_dir()]
    assert len(folders) == 8  # four partitions of the newest two versions
    assert {r[0] for r in table.read().select("v").distinct().collect()} == {99}
    assert {r[0] for r in table.read(before=5).select("v").distinct().collect()} == {4}
    empty = store.KeyedTable(spark, str(tmp_path / "none"), ["k"])
    empty.write(rows(1).limit(0), 0)
    assert empty.read().count() == 0 and empty.read().columns == ["k", "v"]
    assert table.read(only=[]).count() == 0


def test_staged_order(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("n"))
    staged = stage_in_order(df, ["n"]).collect()
    places = sorted((r["_part"], r["_row"], r["n"]) for r in staged)
    assert [p[2] for p in places] == list(range(1000))
    for part in {p[0] for p in places}:
        assert [p[1] for p in places if p[0] == part] == list(range(sum(1 for p in places if p[0] == part)))


def test_staged_table_keeps_its_schema(spark):
    df = spark.range(3).select("id", F.lit(None).cast("string").alias("s"), F.array(F.lit(1.5)).alias("a"))
    assert [f.dataType for f in stage(df).schema] == [T.LongType(), T.StringType(), T.ArrayType(T.DoubleType())]


def test_shared_folder(spark, monkeypatch):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert shared_folder(spark) == configured.rstrip("/")
    monkeypatch.setattr(staging, "_CHECKPOINT_SETTING", "spark.no.such.setting")
    own = shared_folder(spark)
    assert os.path.isdir(own) and shared_folder(spark) == own


def test_header_decides_the_width(spark, tmp_path):
    (tmp_path / "1").mkdir()
    (tmp_path / "1" / "co2.csv").write_text("ts,value\n1\n2\n")
    (tmp_path / "1" / "light.csv").write_text("ts\n1,5\n")
    found = read_sensor_csv(spark, str(tmp_path)).select("sensor_type", "timestamp_unix", "value").collect()
    assert sorted(tuple(r) for r in found) == [("co2", 1, None), ("co2", 2, None)]


def test_decimal_times_stay(spark, tmp_path):
    """Whole seconds, with .0, with a fraction and others in one file: each has its own time, and none is a copy of another."""
    (tmp_path / "tree" / "1").mkdir(parents=True)
    times = ["1377299108", "1377299109.0", "1377299110.5", "1377299110.250001", "1.377299111e9", "", "x", "NaN", "1e300"]
    (tmp_path / "tree" / "1" / "co2.csv").write_text("time,value\n" + "".join(f"{t},{i}\n" for i, t in enumerate(times)))
    rows = {r["value"]: r for r in read_sensor_csv(spark, str(tmp_path / "tree")).collect()}
    assert len(rows) == len(times)
    begin = datetime(2013, 8, 23, 23, 5, 8)
    after = [0, 1, 2.5, 2.250001, 3]
    assert [(rows[i]["event_time"] - begin).total_seconds() for i in range(5)] == after
    assert [rows[i]["timestamp_unix"] - BASE_TIME for i in range(4)] == pytest.approx(after[:4], abs=1e-6)
    assert all(rows[i]["event_time"] is None for i in range(5, 9))
    folder = str(tmp_path / "out")
    assert preprocess(spark, str(tmp_path / "tree"), folder).where("value < 5").count() == 5
    written = spark.read.option("header", True).csv(f"{folder}/all").where("double(value) < 5").collect()
    assert sorted(r["timestamp_unix"] for r in written) == ["1377299108", "1377299109", "1377299110.250001", "1377299110.500000", "1377299111"]
    assert sorted(r["timestamp"] for r in written)[2] == "2013-08-23 23:05:10.250001"


def test_odd_headers(spark, tmp_path):
    texts = {"a/co2.csv": '"a,b"\n1,2\n', "b/co2.csv": 'time,\n1,2\n', "c/co2.csv": '"time","v"\n\n1,2\n', "d/co2.csv": "", "e/co2.csv": "time,value\n"}
    for name, text in texts.items():
        (tmp_path / name).parent.mkdir()
        (tmp_path / name).write_text(text)
    assert rows_of(read_sensor_csv(spark, str(tmp_path))) == [("b", "co2", 1, 2.0), ("c", "co2", 1, 2.0)]


def test_files_in_many_blocks(spark, tmp_path):
    """A file is cut into blocks; only its first line is a header, whatever block a line is in."""
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    (tmp_path / "1").mkdir()
    (tmp_path / "1" / "co2.csv").write_text("time,value\n" + "".join(f"{i},{i}\n" for i in range(5000)))
    (tmp_path / "1" / "light.csv").write_text("time\n" + "".join(f"{i},{i}\n" for i in range(5000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        found = read_sensor_csv(spark, str(tmp_path)).groupBy("sensor_type").agg(F.count("*"), F.sum("value"), F.countDistinct("source_row.block")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [(r[0], r[1], r[2], r[3] > 5) for r in found] == [("co2", 5000, sum(range(5000)), True)]


def test_sensor_files_are_read_once(spark, tree, tmp_path):
    """The result comes from the written lines, not from the files."""
    found = read_sensor_csv(spark, tree)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Format: CSV" not in plan and "Format: Text" not in plan and tree not in plan


@pytest.mark.parametrize("total_order", [False, True])
def test_processed_files_are_in_order(spark, tmp_path, total_order):
    table = events_as_readings(spark, "/root/testdata/sf0.001")
    table = table.withColumn("timestamp_unix", F.unix_timestamp("event_time")).repartition(8)
    processed = process(table, ("event_id",), ("event_id",), total_order=total_order)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        store.save_processed(processed, str(tmp_path))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    folders = [tmp_path / "all", *sorted((tmp_path / "by_sensor").glob("sensor=*"))]
    for folder in folders:
        files = sorted(folder.glob("part-*.csv"))
        rows = [row for f in files for row in csv.DictReader(f.open())]
        keys = [(r["room_id"], r["sensor_type"], r["timestamp"]) for r in rows]
        assert keys and keys == sorted(keys)
    assert len(sorted((tmp_path / "all").glob("part-*.csv"))) > 1


@pytest.mark.parametrize("section", ["kpis", "series", "series_stats", "locations", "alerts", "latest"])
def test_summary_of_a_store_prunes(spark, readings, tmp_path, section):
    path = str(tmp_path / "store")
    store.write_batch(readings([("co2", 1.0), ("light", 2.0)]), path, 0)
    found = operations_summary(store.read_store(spark, path), "co2", 60, datetime(2024, 1, 1, 1))[section]
    filters = found._jdf.queryExecution().executedPlan().toString().split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert section == "latest" or "event_date" in filters
    assert section == "kpis" or "stored_sensor" in filters


def test_store_keeps_sensor_names(spark, readings, tmp_path):
    path = str(tmp_path / "store")
    names = ["1", "2", "", "none", "sensor-1", "a/b=c", None]
    store.write_batch(readings([(name, float(i)) for i, name in enumerate(names)]), path, 0)
    stored = store.read_store(spark, path)
    assert {r["value"]: r["sensor_type"] for r in stored.collect()} == dict(enumerate(names))
    for i, name in enumerate(names[:-1]):
        assert [r["value"] for r in store.read_store(spark, path, sensor=name).collect()] == [i]


def test_historical_messages_come_in_time_order(spark, readings):
    df = readings([("co2", float(i)) for i in range(40)] + [("light", float(i)) for i in range(40)]).repartition(7)
    sent = historical_messages(df, order=("sensor_type", "value"))
    due = [r["release_seconds"] for r in sent.collect()]
    assert due == sorted(due) and len(due) == 80
    numbers = messages.numbered(sent).collect()
    for key in {r["key"] for r in numbers}:
        own = sorted((r["sequence"], r["release_seconds"]) for r in numbers if r["key"] == key)
        assert [n for n, _ in own] == list(range(1, 41)) and [d for _, d in own] == sorted(d for _, d in own)
    tasks = messages.in_sending_order(sent).withColumn("task", F.spark_partition_id()).withColumn("place", F.monotonically_increasing_id()).collect()
    assert len(tasks) == 80
    for task in {r["task"] for r in tasks}:
        own = sorted((r["place"], r["_part"], r["release_seconds"]) for r in tasks if r["task"] == task)
        assert own == sorted(own, key=lambda r: r[1:])


def test_a_hot_key_is_sent_by_many_tasks(spark):
    """A third of the messages have one key, another third none: numbers without gaps, stretches of bounded size."""
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("k"), (F.col("id") % 97).cast("string")))
    sent = spark.range(30_000).select(key.alias("key"), F.col("id").cast("string").alias("value"), (F.col("id") * 7919 % 30_011).alias("release_seconds"))
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = messages.numbered(sent)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    per_key = found.groupBy("key").agg(F.count("*").alias("n"), F.min("sequence").alias("low"), F.max("sequence").alias("high"), F.count_distinct("sequence").alias("different"))
    assert per_key.where("low <> 1 OR high <> n OR different <> n").isEmpty() and per_key.count() == 99
    late = found.alias("a").join(found.alias("b"), F.expr("a.key <=> b.key AND b.sequence = a.sequence + 1 AND a.release_seconds > b.release_seconds"))
    assert late.isEmpty()
    parts = found.groupBy("_part").agg(F.count("*").alias("n"), F.count_if(F.col("key") == "hot").alias("hot")).collect()
    assert len(parts) == 8 and max(r["n"] for r in parts) < 2 * 30_000 / 8 and max(r["hot"] for r in parts) < 2 * 10_000 / 8

