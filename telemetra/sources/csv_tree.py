"""Per-room sensor files: ``<base>/<room>/<sensor>.csv``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from telemetra.functions import fixed_values as fixed
from telemetra.functions.columns import lookup
from telemetra.operators.scale import join_groups
from telemetra.sources.staging import stage

FILES = "{" + ",".join(f"{s}.csv" for s in fixed.CSV_SENSORS) + "}"
ROOM_AND_SENSOR = r"([^/]+)/([^/]+)\.csv$"


#: Timestamps end there.
_MOST_SECONDS = 9_000_000_000_000


def _below_headers(lines: DataFrame) -> DataFrame:
    """The lines below the first one of each file, if that has two columns.

    An empty column is NULL like a missing one, but only a line with too few columns, or too many, is kept as ``odd``.
    """
    wide = F.col("second").isNotNull() | F.col("odd").isNull() | F.regexp_replace("odd", '"[^"]*"', "").contains(",")
    tops = lines.where("source_row.block = 0").groupBy("source_file").agg(
        F.min(F.struct(F.col("source_row.line").alias("line"), wide.alias("wide"))).alias("top")
    )
    tops = stage(tops)
    with_top = join_groups(lines, tops, ["source_file"], tops.count(), "inner")
    return with_top.where("top.wide AND (source_row.block > 0 OR source_row.line > top.line)").drop("top")


def read_sensor_csv(
    spark: SparkSession,
    base: str,
    map_pir: bool = True,
    rooms: Sequence[str] | None = None,
    building: str = fixed.BUILDING,
    files: str | None = None,
    room_and_sensor: str = ROOM_AND_SENSOR,
    check_width: bool = True,
    building_pattern: str | None = None,
) -> DataFrame:
    """All sensor files of a tree as one scan; the listing and the parsing are distributed.

    Columns are taken by position (Unix seconds, value) below a header line; seconds may have a fraction, which
    ``event_time`` keeps to the microsecond. Room and sensor come from the path: for another layout give ``files``, the glob below
    ``base``, and ``room_and_sensor``, a pattern with those two groups. ``building_pattern``, with
    one group, takes the building from the path too; ``building`` stands in where it finds none. ``check_width``
    leaves out files whose header has fewer than two columns: the files are read once, into a written table, whose
    first lines decide; short lines of other files stay, without a value. ``source_file`` and ``source_row`` give the order in which the rows were stored.
    """
    if files is None:
        chosen = "*" if rooms is None else "{" + ",".join(rooms) + "}"
        files = f"{chosen}/{FILES}"
    lines = (
        spark.read.schema("first STRING, second STRING, odd STRING")
        .option("header", not check_width)
        .option("columnNameOfCorruptRecord", "odd")
        .csv(f"{base.rstrip('/')}/{files}")
        .select(
            "first",
            "second",
            "odd",
            F.col("_metadata.file_path").alias("source_file"),
            F.struct(
                F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line")
            ).alias("source_row"),
        )
    )
    if rooms is not None:
        lines = lines.where(F.regexp_extract("source_file", room_and_sensor, 1).isin(*rooms))
    if check_width:
        lines = _below_headers(stage(lines))
    seconds = F.expr("try_cast(first AS DECIMAL(20,6))")
    lines = lines.select(
        F.expr("try_cast(first AS DOUBLE)").alias("timestamp_unix"),
        F.expr("try_cast(second AS DOUBLE)").alias("value"),
        F.timestamp_seconds(F.when(F.abs(seconds) < _MOST_SECONDS, seconds)).alias("event_time"),
        "source_file",
        "source_row",
    )
    sensor = F.regexp_extract("source_file", room_and_sensor, 2)
    if map_pir:
        sensor = F.coalesce(lookup(sensor, {"pir": fixed.PIR_NAME}), sensor)
    place = F.lit(building)
    if building_pattern is not None:
        named = F.regexp_extract("source_file", building_pattern, 1)
        place = F.when(named != "", named).otherwise(building)
    return lines.select(
        "timestamp_unix",
        "value",
        F.regexp_extract("source_file", room_and_sensor, 1).alias("room_id"),
        sensor.alias("sensor_type"),
        place.alias("building_id"),
        "event_time",
        "source_file",
        "source_row",
    )
