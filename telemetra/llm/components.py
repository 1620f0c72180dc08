"""Connected components of links by alternating star operations; nothing is gathered on the driver.

Each round, every node's larger neighbours are linked to its smallest neighbour, then its smaller
ones; the links of a component end as a star around its smallest node. Rounds grow with the
logarithm of a component's size. Both steps are aggregations and equi-joins; the written
tables of a round cut the lineage. A node with very many neighbours is handled by the join on
it, which adaptive execution divides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from telemetra.sources.staging import stage

MOST_ROUNDS = 60


def _both_ways(links: DataFrame) -> DataFrame:
    turned = F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")), F.struct(F.col("b").alias("u"), F.col("a").alias("v")))
    return links.select(F.explode(turned).alias("e")).select("e.u", "e.v")


def _large_star(links: DataFrame) -> DataFrame:
    pairs = _both_ways(links)
    least = pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return pairs.filter("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """``links`` point from the larger (a) to the smaller (b)."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    joined = links.join(least, "a")
    to_least = joined.filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return to_least.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def connected(links: DataFrame) -> DataFrame:
    """(``node``, ``group``): every node of a link (``a``, ``b``) and the smallest node it is connected with."""
    links = stage(links.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    for _ in range(MOST_ROUNDS):
        # A star: no node points to two others, and none that is pointed to points on.
        state = links.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("a").alias("sources")).first()
        if state["n"] == state["sources"] and links.join(links.select(F.col("a").alias("b")), "b", "left_semi").isEmpty():
            break
        links = stage(_small_star(_large_star(links)))
    else:
        raise RuntimeError("components did not settle")
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("group")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("group")).unionByName(roots)
