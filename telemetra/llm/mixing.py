"""Mixing sources to target weights by entropy balancing.

Of all document rates that meet each group's token target, take those nearest to the prior in
Kullback-Leibler divergence, tokens being the measure and ``cap`` the highest rate. Their dual is
convex with one multiplier for each group, and a document's rate is
``min(cap, prior * exp(multiplier of its group))``. Newton's method runs distributed: an iteration joins
the multipliers to the table of (group, prior) with its summed tokens and adds up gradient and
Hessian, which is diagonal as groups are disjoint; only the largest residual goes to the driver.

Rates then become copies: a document is taken ``floor(rate)`` times whole, and the fractions by
sequential Poisson sampling: documents of a group in the order of (hash of the id / fraction)
are taken once more until the target is met, so that the last one is cut short. The
running sums come from slices of that order, cut by its own quantiles and by row where rows are alike: neither a
hot group nor ids that are NULL or repeat come into one task.

NULL and empty texts have size 0 and are never taken. NULL is a group of its own, last in
order. Ids that repeat or are NULL are told apart by size; equal rows are interchangeable. Multipliers that don't settle
in ``MOST_STEPS`` steps raise an error.
Empty tables give empty results; other columns aren't used. DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from telemetra.operators.scale import BROADCAST_GROUPS
from telemetra.sources.staging import stage, stage_in_order

WORD = r"[^\x20\x09-\x0D]+"
MOST_STEPS = 100
TOLERANCE = 1e-10


def words_in(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def of_sources(rows: DataFrame, sources: int) -> DataFrame:
    """``rows``, about one for each of the counted ``sources``, to be joined to those of documents: broadcast if few.

    Left to itself, Spark broadcasts the documents' side, which it takes for as small as its compressed file.
    """
    return F.broadcast(rows) if sources <= BROADCAST_GROUPS else rows.hint("merge")


def targets_by_weight(sizes: DataFrame, weights: Sequence[int], share: float, cap: float) -> DataFrame:
    """``source``, ``source_size``, ``target``: weights repeat over the sources by code point, NULL last.

    The sources share ``share`` of all sizes by weight; none exceeds ``cap`` times its size, the excess
    going to the others by weight. That is one level for all that stay below: sources in the
    order of size by weight are capped as long as the level of the rest is above.
    One row for each source, so one window over all of them is small.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1
    weighed = by_source.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), F.pmod(place, F.lit(len(weights))) + 1))
    order = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").isNull(), "source")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy()
    level = (share * F.sum("source_size").over(whole) - cap * F.coalesce(F.sum("source_size").over(before), F.lit(0))) / F.sum("weight").over(after)
    marked = weighed.withColumn("capped", level >= cap * F.col("source_size") / F.col("weight"))
    capped = F.sum(F.when(F.col("capped"), F.col("source_size")).otherwise(0)).over(whole)
    free = F.sum(F.when(F.col("capped"), 0).otherwise(F.col("weight"))).over(whole)
    shared = F.col("weight") * ((share * F.sum("source_size").over(whole) - cap * capped) / free)
    target = F.when(F.col("capped"), cap * F.col("source_size")).otherwise(shared)
    return marked.select("source", "source_size", target.cast("double").alias("target"))


def balance(cells: DataFrame, targets: DataFrame, cap: float) -> DataFrame:
    """The multiplier of each group. ``cells``: ``source``, ``prior``, ``size`` (added up); ``targets``: ``source``, ``target``.

    A Newton step that leaves the interval known to hold the multiplier is replaced by its middle.
    """
    sources = targets.count()
    named = of_sources(targets.withColumnRenamed("source", "s"), sources)
    highest = F.log(F.lit(cap) / F.min("prior"))  # from here on all rates are at the cap
    state = cells.join(named, F.col("source").eqNullSafe(F.col("s"))).groupBy("source", "target").agg(
        F.lit(0.0).alias("multiplier"), F.lit(-60.0).alias("low"), highest.alias("high")
    )
    state = stage(state.withColumn("multiplier", F.least(F.lit(0.0), F.col("high"))))
    for _ in range(MOST_STEPS):
        raw = F.col("prior") * F.exp("multiplier")
        joined = cells.withColumnRenamed("source", "s").join(of_sources(state, sources), F.col("s").eqNullSafe(F.col("source"))).withColumn("raw", raw)
        sums = joined.groupBy("source", "target", "multiplier", "low", "high").agg(
            F.sum(F.col("size") * F.least("raw", F.lit(cap))).alias("taken"),
            F.sum(F.when(F.col("raw") < cap, F.col("size") * F.col("raw")).otherwise(0.0)).alias("slope"),
        )
        short = F.col("taken") < F.col("target")
        at = sums.withColumn("low", F.when(short, F.col("multiplier")).otherwise(F.col("low"))).withColumn(
            "high", F.when(short, F.col("high")).otherwise(F.col("multiplier"))
        )
        newton = F.when(F.col("slope") > 0, F.col("multiplier") + (F.col("target") - F.col("taken")) / F.col("slope"))
        newton = F.when(short, F.least(newton, F.col("high"))).otherwise(newton)
        middle = (F.col("low") + F.col("high")) / 2
        following = F.when(newton.between(F.col("low"), F.col("high")), newton).otherwise(middle)
        off = F.abs(F.col("target") - F.col("taken")) / F.greatest("target", F.lit(1.0))
        # A target above what the cap allows leaves all at the cap.
        done = (off <= TOLERANCE) | (short & (F.col("slope") == 0))
        state = stage(at.select("source", "target", F.when(done, F.col("multiplier")).otherwise(following).alias("multiplier"), "low", "high", done.alias("done")))
        if state.filter("NOT done").isEmpty():
            break
        state = state.drop("done")
    else:
        raise RuntimeError("multipliers did not settle")
    return state.select("source", "multiplier")


def mix(
    docs: DataFrame,
    weights: Sequence[int] = (5, 2, 1),
    share: float = 1.5,
    cap: float = 2.0,
    prior: str | None = None,
) -> DataFrame:
    """``doc_id``, ``size``, ``source_size``, ``target`` (both of the source), ``rate`` and ``taken`` (words, with repeats).

    ``prior`` names a column of positive base rates, 1 if not given.
    """
    base = F.col(prior).cast("double") if prior else F.lit(1.0)
    sizes = stage(docs.select("doc_id", "source", words_in(F.col("text")).alias("size"), base.alias("prior")))
    targets = stage(targets_by_weight(sizes, weights, share, cap))
    sources = targets.count()
    cells = stage(sizes.filter("size > 0").groupBy("source", "prior").agg(F.sum("size").alias("size")))
    multipliers = balance(cells, targets.filter("source_size > 0 AND target > 0"), cap)
    groups = targets.alias("t").join(multipliers.alias("m"), F.col("t.source").eqNullSafe(F.col("m.source")), "left").select("t.*", "m.multiplier")
    rated = sizes.withColumnRenamed("source", "s").join(of_sources(groups, sources), F.col("s").eqNullSafe(F.col("source"))).drop("s")
    rate = F.when((F.col("size") == 0) | F.col("multiplier").isNull(), 0.0).otherwise(F.least(F.lit(cap), F.col("prior") * F.exp("multiplier")))
    # A rate a hair below a whole number, by rounding of the exponential, is that number.
    rated = rated.withColumn("rate", rate).withColumn("whole", F.floor(F.col("rate") + 1e-9).cast("long"))
    fraction = F.when(F.col("size") > 0, F.greatest(F.col("rate") - F.col("whole"), F.lit(0.0))).otherwise(0.0)
    number = F.conv(F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), 1, 12), 16, 10).cast("double") / float(1 << 48)
    key = F.when(fraction > 1e-9, number / fraction)
    placed = stage(rated.withColumn("key", key).select("doc_id", "size", "source", "source_size", "target", "rate", "whole", "key"))

    # What is still to be taken of each group, and how much of it the slices before cover.
    opened = placed.groupBy("source").agg(F.max("target").alias("goal"), F.sum(F.col("whole") * F.col("size")).alias("fixed"))
    opened = opened.select(F.col("source").alias("s"), (F.round("goal").cast("long") - F.col("fixed")).alias("open"))
    rows = placed.filter("key IS NOT NULL").withColumn("_number", F.monotonically_increasing_id())  # of a written table: the same whenever it is read
    order = ["key", "doc_id", "size", "_number"]
    sliced = stage_in_order(rows, ["source", *order])
    per_slice = sliced.groupBy("source", "_part").agg(F.sum("size").alias("inside"))
    ahead = Window.partitionBy("source").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_slice.select(F.col("source").alias("s"), F.col("_part").alias("p"), F.coalesce(F.sum("inside").over(ahead), F.lit(0)).alias("start"))
    starts = starts.join(opened.withColumnRenamed("s", "g"), F.col("s").eqNullSafe(F.col("g"))).drop("g")  # a row for each slice and group in it
    joined = sliced.join(of_sources(starts, sources), (F.col("_part") == F.col("p")) & F.col("source").eqNullSafe(F.col("s")))
    in_slice = Window.partitionBy("_part", "source").orderBy("_row").rowsBetween(Window.unboundedPreceding, -1)
    sampled = joined.withColumn("before", F.col("start") + F.coalesce(F.sum("size").over(in_slice), F.lit(0)))
    more = F.greatest(F.lit(0), F.least(F.col("size"), F.col("open") - F.col("before")))
    out = ["doc_id", "size", "source_size", "target", "rate"]
    taken = sampled.select(*out, (F.col("whole") * F.col("size") + more).alias("taken"))
    rest = placed.filter("key IS NULL").select(*out, (F.col("whole") * F.col("size")).alias("taken"))
    return taken.unionByName(rest)
