"""The composite jobs: preprocessing, live pipeline, operations summary, replay, exploration."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from telemetra.functions import fixed_values as fixed
from telemetra.operators import alerts, features, quality, replay, reports, rollups
from telemetra.sources import csv_tree, messages, store
from telemetra.sources.staging import passing_tables, stage, stage_in_order
from telemetra.streaming.queries import start_pipeline


def process(
    readings: DataFrame,
    dedup_keys: Sequence[str] = ("timestamp_unix", "room_id", "sensor_type"),
    order: Sequence[str] = ("source_file", "source_row"),
    exact: bool = False,
    total_order: bool = False,
) -> DataFrame:
    """Deduplicate, flag outliers, add time and rolling features; sorted by room, sensor, time.

    The result is a written table, since several outputs are made from it. Each of its
    files is sorted; ``total_order`` sorts from file to file too, for one more shuffle.
    """
    sorting = ["room_id", "sensor_type", "event_time", *order]
    with passing_tables(readings.sparkSession):
        clean = stage(quality.dedup_readings(readings, dedup_keys, order))
        # the windows shuffle the narrow table; columns that need only their row come after
        rolled = features.with_rolling_means(clean, order=["event_time", *order], exact=exact)
        processed = features.with_time_features(quality.flag_outliers(rolled, measured_on=clean))
        added = [name for name in processed.columns if name not in rolled.columns]
        means = [name for name in rolled.columns if name not in clean.columns]
        processed = processed.select(*clean.columns, *added, *means)
        if total_order:
            return stage_in_order(processed, sorting, keep=True).drop("_part", "_row")
        return stage(processed.sortWithinPartitions(*sorting), keep=True)


def preprocess(
    spark: SparkSession, base: str, folder: str, rooms: Sequence[str] | None = None, total_order: bool = False
) -> DataFrame:
    """Sensor files to processed CSV plus two summaries, all below ``folder``; returns the table."""
    readings = csv_tree.read_sensor_csv(spark, base, map_pir=False, rooms=rooms)
    processed = process(readings, total_order=total_order)
    store.save_processed(processed, folder)
    store.export_csv(reports.processing_summary(processed), f"{folder}/summary")
    store.export_csv(reports.processing_summary_by_sensor(processed), f"{folder}/summary_by_sensor")
    return processed


def live(
    incoming: DataFrame,
    folder: str,
    checkpoint: str,
    trigger: dict | None = None,
    as_of: object = None,
    read_once: bool = False,
    split_malformed: bool = False,
) -> list[StreamingQuery]:
    """A stream from ``read_readings_stream`` to stored readings, alerts and aggregates.

    ``split_malformed`` puts messages that don't parse into a store of their own instead of rows of NULLs.
    """
    parsed = messages.parse_readings(incoming, with_text=split_malformed)
    return start_pipeline(parsed, folder, checkpoint, trigger, as_of, read_once, split_malformed)


def operations_summary(
    readings: DataFrame,
    sensor: str,
    minutes: int,
    as_of: object,
    time: str = "event_time",
    order: Sequence[str] = (),
    exact: bool = False,
) -> dict[str, DataFrame]:
    """What an operator looks at for one sensor and period: one table per section."""
    series = reports.time_series(readings, sensor, minutes, as_of, time, order)
    return {
        "totals": reports.store_totals(readings),
        "kpis": reports.sensor_kpis(readings, minutes, as_of, time, exact=exact),
        "series": series,
        "series_stats": reports.series_stats(series, time=time, order=order, exact=exact),
        "locations": reports.by_location(readings, sensor, minutes, as_of, time, exact=exact),
        "latest": reports.display_readings(reports.latest_readings(readings, sensor, time=time, order=order), time),
        "alerts": alerts.range_alerts(
            readings, as_of, sensor=sensor, time=time, order=order, newest=fixed.ALERT_ROWS
        ),
    }


def summary_of_store(
    spark: SparkSession,
    path: str,
    sensor: str,
    minutes: int,
    as_of: object,
    time: str = "event_time",
    order: Sequence[str] = (),
    exact: bool = False,
) -> dict[str, DataFrame]:
    """:func:`operations_summary` of a store: totals, KPIs and locations come from the log's partial aggregates.

    The other sections open the files of the sensor and the period only.
    """
    stored = store.read_store(spark, path, sensor)
    return {
        **operations_summary(stored, sensor, minutes, as_of, time, order, exact),
        "totals": rollups.stored_totals(spark, path),
        "kpis": rollups.stored_kpis(spark, path, minutes, as_of, time, exact),
        "locations": rollups.stored_by_location(spark, path, sensor, minutes, as_of, time, exact=exact),
    }


def historical_messages(
    readings: DataFrame,
    speed_factor: float = fixed.REPLAY_SPEED,
    order: Sequence[str] = ("source_file", "source_row"),
    sent_at: object = None,
) -> DataFrame:
    """Stored readings as keyed messages in time order, each with its due time after the start of the replay."""
    timed = replay.replay_schedule(features.with_unit(readings), speed_factor, order=order)
    keep = ["release_seconds", "wait_seconds"]
    in_time = timed.orderBy("release_seconds", *order)
    return messages.to_messages(in_time, sent_at=sent_at, keep=keep, keyed=True)


def exploration(
    readings: DataFrame, column: str = "value", order: Sequence[str] = ("event_time",), exact: bool = False
) -> dict[str, DataFrame]:
    """Size, sample, missing values, description and distribution of the readings."""
    return {
        "shapes": reports.shapes(readings),
        "sample": reports.first_rows(readings, order=order),
        "missing": quality.missing_values(readings),
        "profile": quality.profile(readings, columns=[column], exact=exact),
        "histogram": quality.histogram(readings, column, exact=exact),
    }
