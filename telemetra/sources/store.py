"""Stored tables: appended readings and alerts, keyed aggregates, processed CSV."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from telemetra.functions.columns import STORED_DAYS, STORED_SENSOR, iso_time, stored_sensor
from telemetra.operators.features import of_sensor, union_readings
from telemetra.sources.commits import LOG, CommitLog
from telemetra.sources.keyed import KeyedTable
from telemetra.sources.staging import file_system, hadoop_path

__all__ = ["KeyedTable", "compact", "export_csv", "read_store", "save_processed", "upsert_latest", "write_batch"]


#: Folders of batches and merges, with the number of the last batch in them.
FOLDER = re.compile(r"(?:spark_batch_id=|_merged-\d+-)(\d+)")


def write_batch(df: DataFrame, path: str, batch_id: int, time: str = "event_time") -> None:
    """Store one micro-batch in a folder of its own, so that writing it again replaces it.

    Inside, the files are laid out by sensor (``stored_sensor``), day of processing (``processed_date``, if
    ``processed_at`` is there) and day (``event_date``), which readers prune by; the sensor type itself is
    in the files and comes back as it was. The batch counts from the moment its entry is in the store's log.
    """
    path, log = path.rstrip("/"), CommitLog(df.sparkSession, path)
    columns = {STORED_SENSOR: stored_sensor(F.col("sensor_type")), "event_date": F.to_date(time)}
    if "processed_at" in df.columns:
        columns["processed_date"] = F.to_date("processed_at")
    log.drop(f"batch-{batch_id}")
    folder = f"spark_batch_id={batch_id}"
    _write_by_day(df.withColumns(columns), f"{path}/{folder}")
    log.add(f"batch-{batch_id}", folder)


def _write_by_day(df: DataFrame, folder: str) -> None:
    """Rebalancing gathers small directories into single files and divides large ones among tasks."""
    by = [c for c in (STORED_SENSOR, "processed_date", "event_date") if c in df.columns]
    df.hint("rebalance", *by).write.mode("overwrite").partitionBy(*by).parquet(folder)


def compact(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Merge the batches since the last call, but for the newest ``keep``, into one folder by sensor and day.

    Run it now and then, say daily, from one place: the entries and folders then grow with the days, not with the
    batches, and no row is merged twice. A merge counts when its entry is in the log, and replaces its batches from
    then on, so a call that dies changes nothing. The batches themselves go with the next call, for the
    sake of readers that planned before; a query that starts again repeats its newest batch only, which
    ``keep`` leaves alone.
    """
    path, log = path.rstrip("/"), CommitLog(spark, path)
    root = hadoop_path(spark, path)
    counting = {*log.merged().values(), *[f"spark_batch_id={b}" for b in log.batches()], LOG}
    newest = max([*log.batches(), *[last for _, last in log.merged()]], default=-1)
    for status in file_system(spark, root).listStatus(root):
        name = status.getPath().getName()
        number = FOLDER.fullmatch(name)
        if number and name not in counting and int(number[1]) <= newest:  # a newer one is being written
            file_system(spark, root).delete(status.getPath(), True)
    for name in log.outdated():
        log.drop(name)
    batches = log.batches()
    old = batches[: max(len(batches) - max(keep, 1), 0)]
    if old:
        folders = tuple(f"spark_batch_id={b}/" for b in old)
        rows = union_readings(*log.read([f for f in log.files() if f.startswith(folders)]))
        merged = f"merged-{old[0]}-{old[-1]}"
        _write_by_day(rows, f"{path}/_{merged}")
        log.add(merged, f"_{merged}")


def read_store(
    spark: SparkSession,
    path: str,
    sensor: str | None = None,
    since: object = None,
    until: object = None,
    time: str = "event_time",
) -> DataFrame:
    """Stored readings of a sensor from ``since`` up to ``until``, both included; merged batches and others.

    The files to open are planned from the store's log by sensor and time bounds; no directory of the store is listed, and
    the table stays the same while batches are merged.
    """
    path, log = path.rstrip("/"), CommitLog(spark, path)
    entries = log.entries()
    if entries is None:
        return _rows_of(spark.read.parquet(path), sensor, since, until, time)  # written without a log
    bounds = [F.lit(True)]
    if sensor is not None:
        bounds.append(F.col(STORED_SENSOR) == stored_sensor(F.lit(sensor)))
    if since is not None and f"last_{time}" in entries.columns:
        bounds.append(F.col(f"last_{time}") >= F.lit(since).cast(entries.schema[f"last_{time}"].dataType))
    if until is not None and f"first_{time}" in entries.columns:
        bounds.append(F.col(f"first_{time}") <= F.lit(until).cast(entries.schema[f"first_{time}"].dataType))
    files = log.files(reduce(and_, bounds))
    some = files or log.files()[:1]
    if not some:
        raise ValueError(f"nothing is stored at {path}")
    stored = union_readings(*log.read(some))
    return _rows_of(stored if files else stored.limit(0), sensor, since, until, time)


def _rows_of(stored: DataFrame, sensor: str | None, since: object, until: object, time: str) -> DataFrame:
    day = STORED_DAYS.get(time)
    kind = stored.schema[time].dataType
    if sensor is not None:
        stored = stored.where(of_sensor(stored, sensor))
    if since is not None:
        bound = F.lit(since).cast(kind)
        stored = stored.where(F.col(time) >= bound)
        if day in stored.columns:
            stored = stored.where(F.col(day) >= F.date_sub(F.to_date(bound), 1))
    if until is not None:
        bound = F.lit(until).cast(kind)
        stored = stored.where(F.col(time) <= bound)
        if day in stored.columns:
            stored = stored.where(F.col(day) <= F.date_add(F.to_date(bound), 1))
    return stored


def upsert_latest(
    existing: DataFrame | None, batch: DataFrame, keys: Sequence[str], version: str = "spark_batch_id"
) -> DataFrame:
    """Existing rows with those of the batch put in their place; NULL keys match each other."""
    rows = batch if existing is None else existing.unionByName(batch, allowMissingColumns=True)
    newest = Window.partitionBy(*keys).orderBy(F.desc(version))
    return rows.withColumn("_age", F.row_number().over(newest)).where("_age = 1").drop("_age")


def _plain_number(name: str) -> Column:
    """Seconds without an exponent, and without a fraction where they have none."""
    seconds = F.col(name)
    exact = F.when(F.abs(seconds) < 1e13, seconds).cast("decimal(20,6)").cast("string")
    return F.coalesce(F.regexp_replace(exact, r"\.0+$", ""), seconds.cast("string")).alias(name)


def save_processed(df: DataFrame, folder: str) -> None:
    """The processed table as CSV twice: whole, and divided by sensor type; in order inside and between files."""
    inner = ("source_file", "source_row")
    shown = {"event_time": iso_time("event_time", " ").alias("timestamp"), "timestamp_unix": _plain_number("timestamp_unix")}
    columns = [shown.get(name, F.col(name)) for name in df.columns if name not in inner]
    order = [name for name in ("room_id", "sensor_type", "event_time", *inner) if name in df.columns]
    # sorted last, as reading a table again mixes its files
    in_order = df.repartitionByRange(*order).sortWithinPartitions(*order)
    export_csv(in_order.select(*columns), f"{folder}/all")
    # the directory name takes the sensor, the files keep it too
    order = ["sensor", *order]
    by_sensor = df.withColumn("sensor", F.col("sensor_type")).repartitionByRange(*order).sortWithinPartitions(*order)
    by_sensor.select(*columns, "sensor").write.mode("overwrite").option("header", True).partitionBy("sensor").csv(f"{folder}/by_sensor")


def export_csv(df: DataFrame, folder: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(folder)
