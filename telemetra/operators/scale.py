"""Size checks that decide between a plain plan and one that splits hot groups."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from telemetra.sources.staging import stage

BROADCAST_GROUPS = 100_000
TASK_ROWS = 1_000_000


class GroupSizes(NamedTuple):
    groups: int
    largest: int


def group_sizes(df: DataFrame, by: Sequence[str], size: Column | None = None) -> GroupSizes:
    """Number of groups and rows of the largest one: reads the key columns, returns one row.

    ``size`` is the aggregate that gives a group's rows, where ``df`` is already counted.
    """
    row = (
        df.groupBy(*by)
        .agg((F.count("*") if size is None else size).alias("n"))
        .agg(F.count("*").alias("groups"), F.coalesce(F.max("n"), F.lit(0)).alias("largest"))
        .first()
    )
    return GroupSizes(row["groups"], row["largest"])


def split_hot_groups(df: DataFrame, by: Sequence[str]) -> tuple[DataFrame | None, DataFrame | None]:
    """Rows of groups too large for one task, and all other rows; None where there are none.

    A group is too large beyond ``TASK_ROWS``, whatever the total. The keys of such groups
    are counted, and broadcast only if they are few.
    """
    counts = df.groupBy(*by).agg(F.count("*").alias("_n"))
    rows, largest = counts.agg(F.coalesce(F.sum("_n"), F.lit(0)), F.coalesce(F.max("_n"), F.lit(0))).first()
    if largest <= TASK_ROWS:
        return None, df
    hot = stage(counts.where(F.col("_n") > TASK_ROWS))
    groups, inside = hot.agg(F.count("*"), F.sum("_n")).first()
    if inside == rows:
        return df, None
    keys = hot.select(*by)
    return join_groups(df, keys, by, groups, "left_semi"), join_groups(df, keys, by, groups, "left_anti")


def join_groups(df: DataFrame, per_group: DataFrame, by: Sequence[str], groups: int, how: str = "left") -> DataFrame:
    """Attach one row per group to its rows, NULL keys included.

    Broadcast only when ``groups`` (counted, not guessed) is small; beyond that a
    shuffled join, whose hot keys adaptive execution splits.
    """
    if not by:
        raise ValueError("name at least one column to group by")
    right = per_group.withColumnsRenamed({key: f"_right_{key}" for key in by})
    if groups <= BROADCAST_GROUPS:
        right = F.broadcast(right)
    same_group = reduce(and_, [df[key].eqNullSafe(right[f"_right_{key}"]) for key in by])
    return df.join(right, same_group, how).drop(*[f"_right_{key}" for key in by])
