"""Exact quantiles with linear interpolation, also for groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from telemetra.functions.columns import number
from telemetra.operators.scale import GroupSizes, group_sizes, join_groups
from telemetra.sources.staging import stage, stage_in_order

IN_MEMORY_ROWS = 250_000
#: Size of kept sketches, and how far a rank by them is trusted to be off: some twice their usual error.
SKETCH_SIZE, SKETCH_MARGIN = 800, 0.01


def exact_quantiles(
    df: DataFrame,
    by: Sequence[str],
    probabilities: Sequence[float],
    value: str = "value",
    strategy: str = "auto",
    accuracy: int = 10_000,
    sizes: GroupSizes | None = None,
) -> DataFrame:
    """One row per group: the ``by`` columns and ``quantiles``, an array in the order asked for.

    NULL and NaN are skipped; a group without numbers gets NULL. ``percentile`` keeps
    every distinct value of a group in memory, so larger groups take the ``bracketed``
    way: a sketch brackets each quantile, a second scan counts the values inside
    the brackets, and only those are sorted. Both give the same numbers.
    """
    if strategy not in ("auto", "builtin", "bracketed"):
        raise ValueError(f"unknown strategy: {strategy}")
    if strategy == "auto":
        largest = (sizes or group_sizes(df, by)).largest
        strategy = "builtin" if largest <= IN_MEMORY_ROWS else "bracketed"
    if strategy == "builtin":
        wanted = F.array(*[F.lit(float(p)) for p in probabilities])
        return df.groupBy(*by).agg(F.percentile(number(value), wanted).alias("quantiles"))

    values = df.select(*by, number(value).alias("_value"))
    return _exactly(values, stage(_brackets(values, by, probabilities, accuracy)), by, probabilities)


def quantiles_from_sketches(
    df: DataFrame,
    sketches: DataFrame,
    by: Sequence[str],
    probabilities: Sequence[float],
    value: str = "value",
    margin: float = SKETCH_MARGIN,
) -> DataFrame:
    """As :func:`exact_quantiles`, with one scan of ``df``: the brackets come from sketches kept of the same rows.

    ``sketches`` has the ``by`` columns, ``numbers`` (how many are sketched) and ``sketch`` (KLL), any number of rows
    for a group. A sketch that misses, or has counted other rows, costs another scan, never the result.
    """
    merged = sketches.groupBy(*by).agg(F.sum("numbers").alias("_rows"), F.kll_merge_agg_double("sketch").alias("_sketch"))
    least = F.col("_rows") >= 4 / margin

    def bound(probability: float) -> Column:
        if not 0 < probability < 1:
            return F.lit(None).cast("double")
        return F.when(least, F.kll_sketch_get_quantile_double("_sketch", F.lit(probability)))

    lows, highs = [bound(p - margin) for p in probabilities], [bound(p + margin) for p in probabilities]
    brackets = stage(_entries(merged, by, probabilities, lows, highs))
    return _exactly(df.select(*by, number(value).alias("_value")), brackets, by, probabilities)


def _exactly(values: DataFrame, brackets: DataFrame, by: Sequence[str], probabilities: Sequence[float]) -> DataFrame:
    found = stage(_between_brackets(values, brackets, by))
    if not found.where("_found < _asked").isEmpty():  # the sketch missed: no bounds, sort everything
        brackets = stage(_brackets(values, by, probabilities, None))
        found = stage(_between_brackets(values, brackets, by))
    each = [F.max(F.when(F.col("_p") == i, F.col("_quantile"))) for i in range(len(probabilities))]
    per_group = found.groupBy(*by).agg(F.array(*each).alias("quantiles"))
    return join_groups(brackets.select(*by), per_group, by, brackets.count())


def _between_brackets(values: DataFrame, brackets: DataFrame, by: Sequence[str]) -> DataFrame:
    """Per group and probability: the quantile, how many ranks it needed and how many were found."""
    keys = [*by, "_p"]
    each = brackets.select(*by, F.explode("_brackets").alias("_bracket")).select(*by, "_bracket.*")
    groups, entries = brackets.count(), each.count()

    # above the bracket: dropped; inside: counted per value; below: counted together under NULL
    inside = F.when(F.col("_low").isNull() | (F.col("_value") >= F.col("_low")), F.col("_value"))
    counts = (
        join_groups(values.where("_value IS NOT NULL"), brackets, by, groups, "inner")
        .select(*by, "_value", F.explode("_brackets").alias("_bracket"))
        .select(*by, "_value", "_bracket._p", "_bracket._low", "_bracket._high")
        .where(F.col("_high").isNull() | (F.col("_value") <= F.col("_high")))
        .groupBy(*keys, inside.alias("_value"))
        .agg(F.count("*").alias("_count"))
    )
    ordered = stage_in_order(counts, [*keys, "_value"])

    # totals per sort partition tell which of them hold a wanted rank
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = (
        ordered.groupBy(*keys, "_part")
        .agg(F.sum("_count").alias("_total"))
        .withColumn("_before", F.coalesce(F.sum("_total").over(earlier), F.lit(0)))
    )
    ranks = each.select(*keys, F.explode("_ranks").alias("_rank"))
    located = (
        join_groups(totals, ranks, keys, entries, "inner")
        .where((F.col("_rank._at") >= F.col("_before")) & (F.col("_rank._at") < F.col("_before") + F.col("_total")))
        .groupBy(*keys, "_part", "_before")
        .agg(F.collect_list("_rank").alias("_ranks"))  # at most two
    )
    within = Window.partitionBy(*keys, "_part").orderBy("_value")
    picked = (
        join_groups(ordered, located, [*keys, "_part"], entries * 2, "inner")
        .withColumn("_end", F.col("_before") + F.sum("_count").over(within))
        .withColumn("_rank", F.explode("_ranks"))
        .where((F.col("_rank._at") < F.col("_end")) & (F.col("_rank._at") >= F.col("_end") - F.col("_count")))
        .groupBy(*keys)
        .agg(
            F.count("_value").alias("_found"),
            F.min("_value").alias("_least"),
            F.max("_value").alias("_most"),
            F.sum(F.col("_rank._weight") * F.col("_value")).alias("_weighted"),
        )
    )
    asked = ranks.groupBy(*keys).agg(F.count("*").alias("_asked"))
    quantile = F.when(F.col("_least") == F.col("_most"), F.col("_least")).otherwise(F.col("_weighted"))
    return join_groups(asked, picked, keys, entries).select(
        *keys, quantile.alias("_quantile"), "_asked", F.coalesce("_found", F.lit(0)).alias("_found")
    )


def _brackets(values: DataFrame, by: Sequence[str], probabilities: Sequence[float], accuracy: int | None) -> DataFrame:
    """Per group an array with, for every probability, the bounds to keep and the ranks to find.

    The sketch is off by at most 1/accuracy of the rows, so bounds taken twice that
    away enclose the ranks. A group too small for that margin, or a margin that
    leaves the data, has no bound and keeps everything on that side. A group without
    numbers has no ranks.
    """
    rows = F.count("_value").alias("_rows")
    if accuracy is None:
        lows = highs = [None] * len(probabilities)
        sketch = values.groupBy(*by).agg(rows)
    else:
        margin = 2.0 / accuracy
        lows = [p - margin if p > margin else None for p in probabilities]
        highs = [p + margin if p + margin < 1.0 else None for p in probabilities]
        asked = [p for p in (*lows, *highs) if p is not None]
        sketch = values.groupBy(*by).agg(rows, F.percentile_approx("_value", asked, accuracy).alias("_sketch"))
    found = iter(range(2 * len(probabilities)))

    def bound(probability: float | None) -> Column:
        if probability is None:
            return F.lit(None).cast("double")
        return F.when(F.col("_rows") >= 4 * accuracy, F.col("_sketch")[next(found)])

    return _entries(sketch, by, probabilities, [bound(p) for p in lows], [bound(p) for p in highs])


def _entries(sketch: DataFrame, by: Sequence[str], probabilities: Sequence[float], lows: list[Column], highs: list[Column]) -> DataFrame:
    """Bounds and ranks of each probability, from a group's ``_rows``."""
    entries = []
    for i, p in enumerate(probabilities):
        position = F.lit(float(p)) * (F.col("_rows") - 1)
        lower = F.floor(position)
        ranks = F.array(
            F.struct(lower.alias("_at"), (lower + 1 - position).alias("_weight")),
            F.struct((lower + 1).alias("_at"), (position - lower).alias("_weight")),
        )
        entries.append(
            F.struct(
                F.lit(i).alias("_p"),
                lows[i].alias("_low"),
                highs[i].alias("_high"),
                F.filter(ranks, lambda rank: (rank["_at"] >= 0) & (rank["_weight"] > 0)).alias("_ranks"),
            )
        )
    return sketch.select(*by, F.array(*entries).alias("_brackets"))
