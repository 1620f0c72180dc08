"""Cleaning and exploration: duplicates, outliers, profile, histogram."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F, types as T

from telemetra.functions import fixed_values as fixed
from telemetra.functions.columns import is_valid, mean, number
from telemetra.operators.quantiles import exact_quantiles
from telemetra.operators.scale import group_sizes, join_groups
from telemetra.sources.staging import stage


def dedup_readings(
    df: DataFrame,
    keys: Sequence[str] = ("timestamp_unix", "room_id", "sensor_type"),
    order: Sequence[str] = ("source_file", "source_row"),
) -> DataFrame:
    """Keep the first row of each key in ``order``; every task drops its own copies before the shuffle."""
    first = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_copy", F.row_number().over(first)).where("_copy = 1").drop("_copy")


def flag_outliers(
    df: DataFrame,
    by: Sequence[str] = ("sensor_type",),
    probabilities: Sequence[float] = fixed.OUTLIER_QUANTILES,
    strategy: str = "auto",
    measured_on: DataFrame | None = None,
) -> DataFrame:
    """Add ``is_outlier``: outside the 1 % / 99 % quantiles of the group, or no number at all.

    ``measured_on`` is a cheaper table with the same readings to take the quantiles from.
    """
    measured = df if measured_on is None else measured_on
    sizes = group_sizes(measured, by)
    bounds = exact_quantiles(measured, by, probabilities, strategy=strategy, sizes=sizes).select(
        *by, F.col("quantiles")[0].alias("_low"), F.col("quantiles")[1].alias("_high")
    )
    inside = F.col("value").between(F.col("_low"), F.col("_high"))
    return (
        join_groups(df, bounds, by, sizes.groups)
        .withColumn("is_outlier", ~F.coalesce(inside, F.lit(False)))
        .drop("_low", "_high")
    )


def outlier_stats(df: DataFrame, by: Sequence[str] = ("sensor_type",), exact: bool = False) -> DataFrame:
    """Per sensor, over readings flagged by :func:`flag_outliers`."""
    value = number("value")
    return df.groupBy(*by).agg(
        F.min(value).alias("min_value"),
        F.max(value).alias("max_value"),
        mean(value, exact).alias("mean_value"),
        F.stddev_samp(value).alias("std_value"),
        F.count_if("is_outlier").alias("outliers"),
    )


def missing_values(df: DataFrame) -> DataFrame:
    """One row per column: its type, rows, and rows that are NULL (or NaN)."""

    def missing(field: T.StructField):
        col = F.col(field.name)
        absent = col.isNull()
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            absent = absent | F.isnan(col)
        return F.count_if(absent)

    counted = df.agg(
        F.count("*").alias("_rows"), *[missing(f).alias(f"_{i}") for i, f in enumerate(df.schema.fields)]
    )
    entries = [
        F.struct(
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.col("_rows").alias("row_count"),
            F.col(f"_{i}").alias("missing_count"),
        )
        for i, f in enumerate(df.schema.fields)
    ]
    return counted.select(F.inline(F.array(*entries)))


def profile(
    df: DataFrame,
    by: Sequence[str] = ("sensor_type",),
    columns: Sequence[str] | None = None,
    exact: bool = False,
    strategy: str = "auto",
) -> DataFrame:
    """Per group and numeric column: missing values, count, mean, std, min, quartiles, max."""
    if columns is None:
        columns = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in by]
    # all columns in one pass, then one row per column
    wide = df.select(*by, *[F.col(c).cast("double").alias(c) for c in columns])
    stats = wide.groupBy(*by).agg(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.count_if(~is_valid(c)).alias("missing_count"),
                F.count(number(c)).alias("value_count"),
                mean(number(c), exact).alias("mean_value"),
                F.stddev_samp(number(c)).alias("std_value"),
                F.min(number(c)).alias("min_value"),
                F.max(number(c)).alias("max_value"),
            ).alias(f"_{i}")
            for i, c in enumerate(columns)
        ]
    )
    stats = stage(stats.select(*by, F.inline(F.array(*[f"_{i}" for i in range(len(columns))]))))
    keys = [*by, "column_name"]
    sizes = group_sizes(stats, keys, F.sum("value_count"))
    cells = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("_value")) for c in columns]
    values = wide.select(*by, F.explode(F.array(*cells)).alias("_cell")).select(*by, "_cell.*")
    quartiles = exact_quantiles(values, keys, (0.25, 0.5, 0.75), "_value", strategy, sizes=sizes)
    return join_groups(stats, quartiles, keys, sizes.groups).select(
        *keys,
        "missing_count", "value_count", "mean_value", "std_value", "min_value",
        *[F.col("quantiles")[i].alias(name) for i, name in enumerate(("q25", "q50", "q75"))],
        "max_value",
    )


def histogram(
    df: DataFrame,
    column: str = "value",
    by: Sequence[str] = ("sensor_type",),
    bins: int = fixed.HISTOGRAM_BINS,
    exact: bool = False,
) -> DataFrame:
    """Equal-width bins between each group's minimum and maximum, empty ones included.

    The last bin includes the maximum. A group of equal values gets the range of
    half a unit around it. Infinite values are in no bin; ``infinite_count`` has their number in each row
    of the group, and a group without other values gets bins around 0.
    """
    numbers = df.select(*by, F.col(column).cast("double").alias("_value")).where(is_valid("_value"))
    finite = F.abs("_value") < float("inf")
    in_range = F.when(finite, F.col("_value"))
    ranges = numbers.groupBy(*by).agg(
        F.coalesce(F.min(in_range), F.lit(0.0)).alias("_low"),
        F.coalesce(F.max(in_range), F.lit(0.0)).alias("_high"),
        mean("_value", exact).alias("mean_value"),
        F.count_if(~finite).alias("infinite_count"),
    )
    numbers = numbers.where(finite)
    same = F.col("_low") == F.col("_high")
    ranges = ranges.select(
        *by,
        F.when(same, F.col("_low") - 0.5).otherwise(F.col("_low")).alias("_low"),
        F.when(same, F.col("_high") + 0.5).otherwise(F.col("_high")).alias("_high"),
        "mean_value",
        "infinite_count",
    )
    ranges = stage(ranges)
    groups = ranges.count()
    low, value = F.col("_low"), F.col("_value")
    width = (F.col("_high") - low) / bins
    guess = F.least(F.floor((value - low) / (F.col("_high") - low) * bins), F.lit(bins - 1))
    # the division may land on the wrong side of an edge; the edges themselves decide
    below = (value < low + guess * width).cast("int")
    above = ((value >= low + (guess + 1) * width) & (guess < bins - 1)).cast("int")
    counts = (
        join_groups(numbers, ranges.drop("mean_value", "infinite_count"), by, groups, "inner")
        .groupBy(*by, (guess + 1 - below + above).cast("int").alias("bin"))
        .agg(F.count("*").alias("value_count"))
    )
    all_bins = ranges.select("*", F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin")).select(
        *by,
        "bin",
        (low + (F.col("bin") - 1) * width).alias("bin_start"),
        (low + F.col("bin") * width).alias("bin_end"),
        "mean_value",
        "infinite_count",
    )
    return join_groups(all_bins, counts, [*by, "bin"], groups * bins).withColumn(
        "value_count", F.coalesce("value_count", F.lit(0))
    )
