"""Bounded row frames (the last 50 rows, the next row) that do not depend on key counts.

A plain window gives one task per key. Telemetry has few keys and hot ones: their
rows are sorted once over the whole cluster, cut into equal chunks by position, and
every chunk receives the few rows before and after it that its frames reach into.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.window import WindowSpec

from telemetra.operators.scale import split_hot_groups
from telemetra.sources.staging import stage_in_order

CHUNK_ROWS = 1_000_000
FrameColumns = Callable[[WindowSpec], Mapping[str, Column]]


def with_row_frames(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    columns: FrameColumns,
    preceding: int = 0,
    following: int = 0,
    strategy: str = "auto",
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Add window columns whose frames reach at most ``preceding`` / ``following`` rows away.

    ``order`` must break every tie. ``strategy`` is ``plain``, ``chunked`` or ``auto``:
    chunked for the groups that one task could not handle, plain for the others, after
    counting them. An empty ``by`` orders all rows, always in chunks.
    """
    if strategy not in ("auto", "plain", "chunked"):
        raise ValueError(f"unknown strategy: {strategy}")
    hot, others = (df, None) if strategy == "chunked" or not by else (None, df)
    if strategy == "auto" and by:
        hot, others = split_hot_groups(df, by)
    parts = []
    if hot is not None:
        parts.append(_chunked(hot, by, order, columns, preceding, following, chunk_rows))
    if others is not None:
        parts.append(others.withColumns(dict(columns(Window.partitionBy(*by).orderBy(*order)))))
    return reduce(DataFrame.unionByName, parts)


def _chunked(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    columns: FrameColumns,
    preceding: int,
    following: int,
    chunk_rows: int,
) -> DataFrame:
    if chunk_rows < max(preceding, following, 1):
        raise ValueError("a chunk must hold at least as many rows as the frame reaches")
    placed = with_position(stage_in_order(df, [*by, *order]))
    home = F.expr(f"_position div {chunk_rows}")
    offset = F.col("_position") % chunk_rows
    # a row goes to its own chunk, and near the edges to the neighbour's as well
    first = home - (offset < following).cast("long")
    last = home + (offset >= chunk_rows - preceding).cast("long")
    spread = placed.select("*", home.alias("_home"), F.explode(F.sequence(first, last)).alias("_chunk"))
    window = Window.partitionBy("_chunk", *by).orderBy("_position")
    return (
        spread.withColumns(dict(columns(window)))
        .where(F.col("_home") == F.col("_chunk"))
        .drop("_position", "_home", "_chunk")
    )


def with_position(staged: DataFrame) -> DataFrame:
    """Replace ``_part`` and ``_row`` by ``_position``, the place in the overall order from 0."""
    # one row per sort partition, so this window and the broadcast stay that small
    starts = staged.groupBy("_part").agg(F.count("*").alias("_rows"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start"))
    return (
        staged.join(F.broadcast(starts), "_part")
        .withColumn("_position", F.col("_start") + F.col("_row"))
        .drop("_part", "_row", "_start")
    )
