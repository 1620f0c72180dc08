"""Timing for sending stored readings again, faster than they were measured."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from telemetra.functions import fixed_values as fixed
from telemetra.functions.columns import micros
from telemetra.operators.ordered import CHUNK_ROWS, with_row_frames


def replay_schedule(
    df: DataFrame,
    speed_factor: float = fixed.REPLAY_SPEED,
    time: str = "event_time",
    order: Sequence[str] = (),
    by: Sequence[str] = (),
    overhead: float = fixed.SEND_OVERHEAD_SECONDS,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Add when each reading is due and how long to wait after it.

    ``gap_seconds`` to the next reading of the whole set (or of its ``by`` series; NULL
    for the last), ``wait_seconds`` that gap sped up less the cost of sending, and
    ``release_seconds`` since the first reading.
    """
    framed = with_row_frames(
        df,
        by,
        [time, *order],
        lambda window: {"_next": F.lead(micros(time)).over(window)},
        following=1,
        chunk_rows=chunk_rows,
    )
    first = df.agg(F.min(micros(time))).scalar()
    gap = (F.col("_next") - micros(time)) / 1_000_000
    return framed.select(
        *df.columns,
        gap.alias("gap_seconds"),
        F.when(gap > 0, F.greatest(gap / speed_factor - overhead, F.lit(0.0))).otherwise(0.0).alias("wait_seconds"),
        ((micros(time) - first) / 1_000_000 / speed_factor).alias("release_seconds"),
    )
