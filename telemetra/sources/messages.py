"""JSON messages: the stream source, parsing, and the way back."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, DataFrameReader, SparkSession, Window, functions as F
from pyspark.sql.streaming import DataStreamReader

from telemetra.functions import fixed_values as fixed
from telemetra.functions.columns import iso_time, lookup
from telemetra.sources.staging import stage_in_order


def read_readings_stream(
    spark: SparkSession,
    servers: str | None = None,
    topic: str = fixed.TOPIC,
    folder: str | None = None,
    options: dict[str, object] | None = None,
) -> DataFrame:
    """Unparsed messages (``value``, ``timestamp``) from a Kafka topic or a folder of text files.

    A folder holds one message per line; its files arrive in order of modification.
    ``options`` are those of the source, such as ``maxOffsetsPerTrigger`` or ``maxFilesPerTrigger``.
    """
    if (servers is None) == (folder is None):
        raise ValueError("name either Kafka servers or a folder")
    if folder is not None:
        return _from_folder(spark.readStream, folder, options)
    source = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "latest")
        .option("failOnDataLoss", "false")
    )
    return source.options(**(options or {})).load().select("value", "timestamp")


def read_message_files(spark: SparkSession, folder: str) -> DataFrame:
    """The same folder as a batch."""
    return _from_folder(spark.read, folder, None)


def _from_folder(reader: DataFrameReader | DataStreamReader, folder: str, options: dict | None) -> DataFrame:
    lines = reader.options(**(options or {})).format("text").load(folder)
    return lines.select("value", F.col("_metadata.file_modification_time").alias("timestamp"))


def parse_readings(messages: DataFrame, keep_malformed: bool = True, with_text: bool = False) -> DataFrame:
    """Message bytes to columns. Text that does not parse becomes a row of NULLs with ``is_malformed``.

    ``with_text`` adds the text of malformed messages as ``message``, which :func:`telemetra.streaming.sinks.splitting_sink` stores.
    """
    text = F.col("value").cast("string")
    parsed = messages.select(
        F.from_json(text, fixed.READING_SCHEMA).alias("data"),
        F.col("timestamp").alias("kafka_time"),
        *([text.alias("message")] if with_text else []),
    ).select("data.*", "kafka_time", *(["message"] if with_text else []))
    nothing = reduce(and_, [F.col(name).isNull() for name in fixed.READING_SCHEMA.fieldNames()])
    readings = parsed.select(
        "*", F.try_to_timestamp(F.col("timestamp")).alias("event_time"), nothing.alias("is_malformed")
    )
    if with_text:
        readings = readings.withColumn("message", F.when(F.col("is_malformed"), F.col("message")))
    return readings if keep_malformed else readings.where(~F.col("is_malformed"))


def to_messages(
    df: DataFrame,
    time: str = "event_time",
    source: str = fixed.HISTORICAL_SOURCE,
    sent_at: object = None,
    keep: Sequence[str] = (),
    keyed: bool = False,
) -> DataFrame:
    """One JSON ``value`` per reading, ready for a Kafka or text sink.

    ``sent_at`` is the sending time written into the message (default: now);
    ``keep`` names columns to have beside the message; ``keyed`` adds a ``key`` of building, room
    and sensor, which Kafka keeps in one partition and so in order.
    """
    sent = F.current_timestamp() if sent_at is None else F.lit(sent_at).cast("timestamp")
    unit = F.col("unit") if "unit" in df.columns else lookup("sensor_type", fixed.UNITS, fixed.UNKNOWN_UNIT)
    return df.select(
        *keep,
        *([F.concat_ws("/", "building_id", "room_id", "sensor_type").alias("key")] if keyed else []),
        F.to_json(
            F.struct(
                iso_time(time).alias("timestamp"),
                iso_time(sent).alias("kafka_timestamp"),
                "building_id",
                "room_id",
                "sensor_type",
                F.col("value").cast("double").alias("value"),
                unit.alias("unit"),
                F.lit(source).alias("source"),
                F.unix_seconds(F.col(time).cast("timestamp")).alias("original_timestamp"),
            )
        ).alias("value"),
    )


def numbered(messages: DataFrame, time: str = "release_seconds", ties: Sequence[str] = ("key", "value")) -> DataFrame:
    """Messages with ``sequence``: 1, 2, 3 and so on for each key, in the order of ``time``, then ``ties``.

    All messages are sorted over the cluster once and written; a message's number is its place among those of its key in
    its part of the order, after the key's messages in the parts before. So a hot key is divided among
    all parts, and whoever receives messages out of order can put a key's back in order and see gaps. ``_part`` and ``_row`` say where in the order a message is.
    """
    placed = stage_in_order(messages, [time, *ties])
    counts = placed.groupBy("key", "_part").agg(F.count("*").alias("_rows"))  # for a hot key as many rows as parts
    earlier = Window.partitionBy("key").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        F.col("key").alias("_key"), F.col("_part").alias("_of"), F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start")
    )
    joined = placed.join(starts, F.col("key").eqNullSafe(F.col("_key")) & (F.col("_part") == F.col("_of")))
    inside = F.row_number().over(Window.partitionBy("_part", "key").orderBy("_row"))
    return joined.withColumn("sequence", F.col("_start") + inside).drop("_key", "_of", "_start")


def in_sending_order(messages: DataFrame, time: str = "release_seconds") -> DataFrame:
    """Each task sends a stretch of time, sorted; messages that are not ``numbered`` yet get their numbers.

    Within a stretch a key's messages leave in order; those of different stretches meet in the topic as they
    come, and ``sequence`` gives their order back.
    """
    some = messages if "sequence" in messages.columns else numbered(messages, time)
    return some.repartition("_part").sortWithinPartitions("_part", "_row")


def publish(messages: DataFrame, servers: str, topic: str = fixed.TOPIC, time: str = "release_seconds") -> None:
    """Send messages to Kafka; those with a key are numbered, and the number is in the header ``sequence``. Needs the Kafka connector."""
    writer_options = {"kafka.bootstrap.servers": servers, "kafka.batch.size": 16384, "kafka.linger.ms": 10, "topic": topic}
    if "key" in messages.columns:
        number = F.struct(F.lit("sequence").alias("key"), F.col("sequence").cast("string").cast("binary").alias("value"))
        messages = in_sending_order(messages, time).select("key", "value", F.array(number).alias("headers"))
        writer_options["includeHeaders"] = True
    messages.write.format("kafka").options(**writer_options).save()
