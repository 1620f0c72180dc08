"""Scoring in order of event time as a stateful operator: late rows wait in the state store for their turn."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from telemetra.functions import fixed_values as fixed
from telemetra.operators.scoring import SCORE_TYPES, is_scored

# the processor travels to the executors with the query; they need not have this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rows scored at once.
_BLOCK_ROWS = 10_000
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_SLOT = "_slot"


class HistoryScorer(StatefulProcessor):
    """Holds the rows of a key by slots of event time and scores a slot when the watermark has passed it.

    Memory holds a block of arriving rows, or one slot of one key; everything else is in the state store.
    """

    def __init__(
        self,
        order: Sequence[str],
        columns: Sequence[str],
        threshold: float,
        confidence: float,
        size: int,
        minimum: int,
        recent: int,
        slot_ms: int = 60_000,
        names: Sequence[str] = (),
    ):
        self.order = list(order)
        self.columns = list(columns)
        self.threshold = threshold
        self.confidence = confidence
        self.size = size
        self.minimum = minimum
        self.recent = recent
        self.slot_ms = slot_ms
        self.names = list(names)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.history = handle.getListState("history", T.StructType([T.StructField("value", T.DoubleType())]))
        # slot -> number of its blocks; (slot, number) -> a block of rows, as Arrow has them
        self.slots = handle.getMapState("slots", "slot LONG", "blocks INT")
        self.waiting = handle.getMapState("waiting", "slot LONG, block INT", "rows BINARY")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for frame in rows:
            frame.columns = self.names  # they come with names that Python could use for fields
            for slot, part in frame.groupby(_SLOT):
                slot = int(slot)
                blocks = self.slots.getValue((slot,))[0] if self.slots.containsKey((slot,)) else 0
                if not blocks:
                    self.handle.registerTimer((slot + 1) * self.slot_ms)
                self.waiting.updateValue((slot, blocks), (_packed(part.drop(columns=_SLOT)),))
                self.slots.updateValue((slot,), (blocks + 1,))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        slot = expiredTimerInfo.getExpiryTimeInMs() // self.slot_ms - 1
        blocks = self.slots.getValue((slot,))[0]
        batch = pd.concat([_unpacked(self.waiting.getValue((slot, block))[0]) for block in range(blocks)], ignore_index=True)
        for block in range(blocks):
            self.waiting.removeKey((slot, block))
        self.slots.removeKey((slot,))
        past = np.array([row[0] for row in self.history.get()], dtype=float)
        batch = batch.sort_values(self.order, kind="stable", ignore_index=True)
        for start in range(0, len(batch), _BLOCK_ROWS):
            block = batch.iloc[start : start + _BLOCK_ROWS].reset_index(drop=True)
            values = block["value"].to_numpy(dtype=float)
            series = np.concatenate([past, values])
            scores = self._scores(series, len(past))
            past = series[-self.size :]
            yield block.assign(**scores)[self.columns]
        self.history.put([(float(v),) for v in past])

    def close(self) -> None:
        pass

    def _scores(self, series: np.ndarray, start: int) -> dict[str, pd.Series]:
        padded = np.concatenate([np.full(self.size, np.nan), series])
        # row i of the view: the 50 values before value i, NaN where there were none
        before = np.lib.stride_tricks.sliding_window_view(padded, self.size)[start : len(series)]
        count = np.count_nonzero(~np.isnan(before), axis=1)
        total = np.maximum(count, 1)
        current = series[start:]
        with np.errstate(invalid="ignore"):  # infinite values: no finite average, nothing raised
            # seen from the latest value, equal values have a deviation of exactly 0
            latest = before[:, -1:]
            moved = before - latest
            average = np.nansum(moved, axis=1) / total
            deviation = np.sqrt(np.nansum((moved - average[:, None]) ** 2, axis=1) / total)
            average = average + latest[:, 0]
            raised = (
                (count >= self.minimum)
                & (deviation > 0)
                & np.isfinite(average)
                & (np.abs(current - average) / np.where(deviation > 0, deviation, 1) > self.threshold)
            )
            last = np.concatenate([np.full(self.recent - 1, np.nan), series])
            recent = np.lib.stride_tricks.sliding_window_view(last, self.recent)[start:]
            prediction = recent.mean(axis=1)
        return {
            "ml_anomaly": pd.Series(np.where(raised, True, None), dtype="object"),
            "ml_confidence": pd.Series(np.where(raised, self.confidence, None), dtype="object"),
            "_prediction": pd.Series(np.where(np.isnan(prediction), None, prediction), dtype="object"),
        }


def _packed(rows: pd.DataFrame) -> bytes:
    table = pa.Table.from_pandas(rows, preserve_index=False)
    with pa.BufferOutputStream() as out:
        with pa.ipc.new_stream(out, table.schema) as writer:
            writer.write_table(table)
        return out.getvalue().to_pybytes()


def _unpacked(rows: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(bytes(rows)).read_pandas()


def detect_anomalies_stream(
    readings: DataFrame,
    by: Sequence[str] = ("building_id", "room_id", "sensor_type"),
    order: Sequence[str] = ("event_time",),
    threshold: float = fixed.ANOMALY_THRESHOLD,
    delay: str = "10 minutes",
    slot_seconds: int = 60,
    time: str = "event_time",
) -> DataFrame:
    """Add ml_anomaly, ml_confidence and ml_prediction to a stream of readings, in order of event time across micro-batches.

    A reading is held until the watermark, ``delay`` behind the newest event time, has passed its slot of
    ``slot_seconds``; then the slot is put in ``order`` (which begins with ``time``) and scored after all slots before it.
    The scores are thus those of the batch operator, in whatever order files or partitions arrive. Rows later than the watermark are not
    scored nor passed on; :func:`late_rows` counts them. Readings of other sensor types, without a value or
    without a time pass by at once, without scores.

    State is 50 values for each key and the waiting rows. A task holds a block of arriving rows or one
    slot of one key, whose rows arrive in one task, though: for few or hot keys use the raw
    sink, which divides them and takes arrival as the order between batches. The state store must be RocksDB.
    """
    if readings.sparkSession.conf.get(STATE_STORE) != ROCKS_DB:
        raise ValueError(f"set {STATE_STORE} to {ROCKS_DB}")
    output = T.StructType(
        [
            *readings.schema.fields,
            T.StructField("ml_anomaly", T.BooleanType()),
            T.StructField("ml_confidence", T.DoubleType()),
            T.StructField("_prediction", T.DoubleType()),
        ]
    )
    slot_ms = slot_seconds * 1000
    held = F.coalesce(is_scored(fixed.SCORED_SENSORS) & F.col(time).isNotNull(), F.lit(False))
    # all readings with a time move the watermark; a filter without the time would be moved in front of it
    slot = F.when(held, F.floor(F.unix_millis(time) / slot_ms))
    waiting = readings.withWatermark(time, delay).withColumn(_SLOT, slot).where(F.col(_SLOT).isNotNull())
    scored = (
        waiting.groupBy(*by)
        .transformWithStateInPandas(
            HistoryScorer(
                order,
                output.fieldNames(),
                threshold,
                fixed.ANOMALY_CONFIDENCE,
                fixed.HISTORY_ROWS,
                fixed.HISTORY_MINIMUM,
                fixed.PREDICTION_ROWS,
                slot_ms,
                waiting.columns,
            ),
            outputStructType=output,
            outputMode="append",
            timeMode="EventTime",
        )
    )
    scored = scored.select(
        *readings.columns, "ml_anomaly", "ml_confidence", F.round("_prediction", 2).alias("ml_prediction")
    )
    others = readings.where(~held)
    return scored.union(others.select("*", *[F.lit(None).cast(t).alias(n) for n, t in SCORE_TYPES.items()]))


def late_rows(query: StreamingQuery) -> int:
    """Rows that came later than the watermark, in the batches whose progress the query still has."""
    return sum(o["numRowsDroppedByWatermark"] for p in query.recentProgress for o in p["stateOperators"])
