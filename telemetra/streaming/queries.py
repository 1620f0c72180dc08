"""The three live queries over one stream of parsed readings.

A store belongs to its checkpoint: batches are numbered by the checkpoint, and a new one
starts again from 0 and replaces what the old one stored. Start both afresh, or neither.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from telemetra.operators.alerts import filter_alerts
from telemetra.operators.reports import running_totals
from telemetra.streaming.history import detect_anomalies_stream
from telemetra.streaming.sinks import (
    RAW_STAMPS,
    BatchFunction,
    aggregate_sink,
    alert_sink,
    combined_sink,
    raw_sink,
    splitting_sink,
    store_sink,
    totals_sink,
)

RAW = "raw_to_store"
ALERTS = "alerts_to_store"
AGGREGATES = "aggregates_to_store"
ALL = "readings_to_store"
SORTED = "sorted_to_store"


def start_query(
    df: DataFrame, name: str, sink: BatchFunction, checkpoint: str, mode: str, trigger: dict | None = None
) -> StreamingQuery:
    """Each query keeps its progress in its own folder below ``checkpoint``."""
    writer = (
        df.writeStream.queryName(name)
        .outputMode(mode)
        .option("checkpointLocation", f"{checkpoint.rstrip('/')}/{name}")
        .foreachBatch(sink)
    )
    return (writer.trigger(**trigger) if trigger else writer).start()


def start_raw_stream(
    readings: DataFrame, path: str, checkpoint: str, trigger: dict | None = None, **scoring
) -> StreamingQuery:
    """Every reading with its scores, appended. ``scoring`` goes to :func:`raw_sink`."""
    sink = raw_sink(path, f"{checkpoint.rstrip('/')}/{RAW}-history", **scoring)
    return start_query(readings, RAW, sink, checkpoint, "append", trigger)


def start_stateful_raw_stream(
    readings: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
    as_of: object = None,
    by: Sequence[str] = ("building_id", "room_id", "sensor_type"),
    **scoring,
) -> StreamingQuery:
    """The same with a history for each room and sensor, or what ``by`` says; ``scoring`` goes to :func:`raw_sink`.

    The histories are a keyed table of hash partitions: a batch reads and writes those of its keys only, and
    rows of a hot key are divided by position, each part with the 50 rows before it.
    """
    return start_raw_stream(readings, path, checkpoint, trigger, by=by, as_of=as_of, **scoring)


def start_sorted_raw_stream(
    readings: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
    as_of: object = None,
    **scoring,
) -> StreamingQuery:
    """Scores in order of event time, whatever the order of arrival: readings wait for the watermark.

    ``scoring`` goes to :func:`detect_anomalies_stream`.
    """
    scored = detect_anomalies_stream(readings, **scoring)
    return start_query(scored, SORTED, store_sink(path, RAW_STAMPS, as_of), checkpoint, "append", trigger)


def start_alert_stream(
    readings: DataFrame, path: str, checkpoint: str, trigger: dict | None = None, as_of: object = None
) -> StreamingQuery:
    return start_query(filter_alerts(readings), ALERTS, alert_sink(path, as_of), checkpoint, "append", trigger)


def start_aggregate_stream(
    readings: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
    keys: Sequence[str] = ("building_id", "sensor_type"),
    as_of: object = None,
    exact: bool = False,
) -> StreamingQuery:
    """Running totals; a batch sends the keys it changed, and the store keeps the rest."""
    totals = running_totals(readings, keys, exact)
    return start_query(totals, AGGREGATES, aggregate_sink(path, keys, as_of), checkpoint, "update", trigger)


def start_pipeline(
    readings: DataFrame,
    folder: str,
    checkpoint: str,
    trigger: dict | None = None,
    as_of: object = None,
    read_once: bool = False,
    split_malformed: bool = False,
) -> list[StreamingQuery]:
    """All three, storing below ``folder``; wait with ``spark.streams.awaitAnyTermination()``.

    Three queries read and parse the source three times, each at its own pace.
    ``read_once`` makes them one query that reads it once and fills the same stores. ``split_malformed``
    does too, and puts messages that don't parse into a fourth store, ``rejected``, with their text; the
    readings then come from ``parse_readings(..., with_text=True)``.
    """
    stores = [f"{folder.rstrip('/')}/{name}" for name in ("raw", "alerts", "aggregates")]
    if read_once or split_malformed:
        sink = combined_sink(
            raw_sink(stores[0], f"{checkpoint.rstrip('/')}/{RAW}-history", as_of=as_of),
            alert_sink(stores[1], as_of),
            totals_sink(stores[2], as_of=as_of),
        )
        if split_malformed:
            sink = splitting_sink(sink, f"{folder.rstrip('/')}/rejected", as_of)
        return [start_query(readings, ALL, sink, checkpoint, "append", trigger)]
    return [
        start_raw_stream(readings, stores[0], checkpoint, trigger, as_of=as_of),
        start_alert_stream(readings, stores[1], checkpoint, trigger, as_of),
        start_aggregate_stream(readings, stores[2], checkpoint, trigger, as_of=as_of),
    ]
