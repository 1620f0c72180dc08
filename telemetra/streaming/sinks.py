"""What each streaming query does with a micro-batch. All of it can be run again safely."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, Window, functions as F

from telemetra.functions import fixed_values as fixed
from telemetra.functions.columns import now
from telemetra.operators.alerts import filter_alerts
from telemetra.operators.ordered import CHUNK_ROWS
from telemetra.operators.scoring import is_scored, score_readings
from telemetra.sources.staging import passing_tables
from telemetra.sources.store import KeyedTable, upsert_latest, write_batch

BatchFunction = Callable[[DataFrame, int], None]
RAW_STAMPS = ("processed_at", "kafka_timestamp")
READING_ORDER = ("event_time", "building_id", "room_id", "value", "kafka_time")


@contextmanager
def held(batch: DataFrame) -> Iterator[None]:
    """Keep a batch that is read several times, unless a caller already does."""
    if batch.is_cached:
        yield
        return
    batch.persist()
    try:
        yield
    finally:
        batch.unpersist()


def unless_empty(write: BatchFunction) -> BatchFunction:
    """Skip empty batches; looking and writing share one evaluation, of state above all."""

    def write_held(batch: DataFrame, batch_id: int) -> None:
        with held(batch):
            if not batch.isEmpty():
                write(batch, batch_id)

    return write_held


def stamped(df: DataFrame, names: Sequence[str], as_of: object) -> DataFrame:
    return df.withColumns({name: now(as_of) for name in names})


def raw_sink(
    path: str,
    history_path: str,
    by: Sequence[str] = ("sensor_type",),
    order: Sequence[str] = READING_ORDER,
    threshold: float = fixed.ANOMALY_THRESHOLD,
    method: str = "simple",
    as_of: object = None,
    strategy: str = "auto",
    chunk_rows: int = CHUNK_ROWS,
) -> BatchFunction:
    """Score every reading against the readings before it, earlier batches included, and store it.

    The last 50 readings of each key are carried from batch to batch in a keyed
    table at ``history_path``, of which a batch reads and writes the partitions of its keys only. Inside a batch
    ``order`` decides, between batches arrival. Hot keys are divided: see ``with_row_frames``.
    """
    carried = list(dict.fromkeys([*by, "sensor_type", "value", *order]))

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        with passing_tables(spark):
            history = KeyedTable(spark, history_path, by)
            scored_rows = batch.where(is_scored(fixed.SCORED_SENSORS))
            touched = history.touched(scored_rows, before=batch_id)
            earlier = history.read(before=batch_id, only=touched)
            # _age: 50 to 1 for the rows carried over, 0 for those of the batch
            together = batch.withColumns({"_carried": F.lit(False), "_age": F.lit(0)})
            if earlier is not None:
                together = together.unionByName(
                    earlier.withColumn("_carried", F.lit(True)), allowMissingColumns=True
                )
            together = together.withColumn("_turn", -F.col("_age"))
            arrival = ["_turn", *order]
            scored = score_readings(
                together, by, arrival, threshold, method, strategy=strategy, chunk_rows=chunk_rows
            ).where(~F.col("_carried"))
            write_batch(stamped(scored.drop("_carried", "_age", "_turn"), RAW_STAMPS, as_of), path, batch_id)
            backwards = Window.partitionBy(*by).orderBy(*[F.desc(c) for c in arrival])
            kept = (
                together.where(is_scored(fixed.SCORED_SENSORS))
                .withColumn("_age", F.row_number().over(backwards))
                .where(F.col("_age") <= fixed.HISTORY_ROWS)
            )
            history.write(kept.select(*carried, "_age"), batch_id, touched)

    return unless_empty(write)


def store_sink(path: str, stamps: Sequence[str] = ("processed_at",), as_of: object = None) -> BatchFunction:
    """Store rows with their processing time; the batch number is the folder they are in."""

    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(stamped(batch, stamps, as_of), path, batch_id)

    return unless_empty(write)


def alert_sink(path: str, as_of: object = None) -> BatchFunction:
    return store_sink(path, as_of=as_of)


def aggregate_sink(
    path: str, keys: Sequence[str] = ("building_id", "sensor_type"), as_of: object = None
) -> BatchFunction:
    """Replace the rows of the keys that the batch brings."""

    def write(batch: DataFrame, batch_id: int) -> None:
        table = KeyedTable(batch.sparkSession, path, keys)
        stamped = batch.withColumns({"spark_batch_id": F.lit(batch_id).cast("long"), "last_update": now(as_of)})
        touched = table.touched(batch, before=batch_id)
        table.write(upsert_latest(table.read(before=batch_id, only=touched), stamped, keys), batch_id, touched)

    return unless_empty(write)


def totals_sink(
    path: str,
    keys: Sequence[str] = ("building_id", "sensor_type"),
    as_of: object = None,
    exact: bool = False,
) -> BatchFunction:
    """Add the sums of a batch of readings to the stored ones; same columns as :func:`aggregate_sink`."""
    value = F.col("value").cast("decimal(18,4)") if exact else F.col("value")
    total_type = "decimal(38,4)" if exact else "double"

    def write(batch: DataFrame, batch_id: int) -> None:
        table = KeyedTable(batch.sparkSession, path, keys)
        touched = table.touched(batch, before=batch_id)
        sums = batch.groupBy(*keys).agg(
            F.sum(value).cast(total_type).alias("value_sum"),
            F.count("value").alias("value_count"),
            F.max("value").alias("max_value"),
            F.count("*").alias("message_count"),
        )
        sums = sums.withColumns({"spark_batch_id": F.lit(batch_id).cast("long"), "last_update": now(as_of)})
        earlier = table.read(before=batch_id, only=touched)
        if earlier is not None:
            sums = sums.unionByName(earlier.drop("avg_value"))
        merged = sums.groupBy(*keys).agg(
            F.sum("value_sum").cast(total_type).alias("value_sum"),
            F.sum("value_count").alias("value_count"),
            F.max("max_value").alias("max_value"),
            F.sum("message_count").alias("message_count"),
            F.max("spark_batch_id").alias("spark_batch_id"),
            F.max("last_update").alias("last_update"),
        )
        average = F.col("value_sum").cast("double") / F.nullif(F.col("value_count"), F.lit(0))
        table.write(merged.withColumn("avg_value", average), batch_id, touched)

    return unless_empty(write)


def combined_sink(raw: BatchFunction, alerts: BatchFunction, totals: BatchFunction) -> BatchFunction:
    """All three stores from one reading and parsing of the batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        raw(batch, batch_id)
        alerts(filter_alerts(batch), batch_id)
        totals(batch, batch_id)

    return unless_empty(write)


def splitting_sink(good: BatchFunction, rejected_path: str, as_of: object = None) -> BatchFunction:
    """Malformed messages to a store of their own, with their text; all others on to ``good``.

    The batch comes from ``parse_readings(..., with_text=True)``. Both stores take the batch under its number, so a batch
    that is run again replaces its rows in both, and together they hold every message once.
    """
    rejected = store_sink(rejected_path, as_of=as_of)

    def write(batch: DataFrame, batch_id: int) -> None:
        rejected(batch.where("is_malformed").select("message", "kafka_time", "event_time", "sensor_type"), batch_id)
        good(batch.where("NOT is_malformed").drop("message"), batch_id)

    return unless_empty(write)
