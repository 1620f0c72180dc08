"""SimHash near-duplicates: fingerprints, links within a Hamming distance, connected groups.

The search is the generalised pigeonhole principle. The 64 bits are divided into parts, part i
with a threshold t_i of its own (-1: unused). If the thresholds add up to ``distance - parts + 1``,
two fingerprints within ``distance`` are within t_i in some part i, so probing every part's
exact index with all keys within t_i finds every such pair; each is then verified on all bits.
Correlated bits share a part, and dynamic programming picks the thresholds of least estimated
probes and candidates; so is the number of parts, which falls as fingerprints grow in number: three for
some 1e5, two from some 1e8 on, where keys of 32 bits keep candidates near linear. Statistics cover all
fingerprints; they steer cost, never results.

NULL and empty texts have fingerprint zero and are linked like any other. Equal texts and
repeated rows share a fingerprint, so copies meet in one row before any search. Rows with a NULL
id take part; a group's id is the smallest id in it, NULL if it has none. Empty tables give
empty results. Columns of the input named like an added one are replaced.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from telemetra.llm.common import LOWER_ASCII, map_texts
from telemetra.llm.components import connected
from telemetra.operators.scale import BROADCAST_GROUPS
from telemetra.sources.staging import stage

BITS = 64
SEED = 42
#: More parts have keys of 16 bits or fewer, in which bits that go together gather too many fingerprints.
MOST_PARTS = 3
#: An index bucket with more fingerprints than this is searched between groups only, not between all pairs.
DENSE_BUCKET = 64


def fingerprint_of(text: bytes | None, shingle: int) -> int:
    words = (text or b"").translate(LOWER_ASCII).split()
    if not words:
        return 0
    joined = b" ".join(words)
    width = min(shingle, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - width + 1]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts.tolist(), ends[width - 1 :].tolist())], np.uint64)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        block = hashes[at : at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4, keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``simhash`` (LONG, the 64 bits) of the whole text's word shingles."""

    def begin():
        return lambda texts: {"simhash": pa.array(np.array([fingerprint_of(t, shingle) for t in texts], np.uint64).view(np.int64))}

    return map_texts(docs, begin, "simhash LONG", keep=keep, as_bytes=True)


def as_hex(fingerprint: Column) -> Column:
    return F.lpad(F.lower(F.hex(fingerprint)), 16, "0")


def distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def bit_statistics(distinct: DataFrame) -> tuple[int, np.ndarray, np.ndarray]:
    """Count, share of ones for each bit, and correlations of bits, over all fingerprints."""

    def sums(batches):
        total, n = np.zeros((BITS, BITS)), 0
        for batch in batches:
            words = batch.column(0).to_numpy(zero_copy_only=False).astype("<i8").view(np.uint8).reshape(-1, 8)
            for at in range(0, len(words), 1 << 14):
                x = np.unpackbits(words[at : at + (1 << 14)], axis=1, bitorder="little").astype(np.float32)
                total += x.T @ x
                n += len(x)
        values = np.append(total.ravel(), n)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values))), pa.array(values)], names=["k", "v"])

    rows = distinct.select("simhash").mapInArrow(sums, "k LONG, v DOUBLE").groupBy("k").agg(F.sum("v").alias("v")).collect()
    values = np.zeros(BITS * BITS + 1)
    for row in rows:
        values[row["k"]] = row["v"]
    n = int(values[-1])
    both = values[:-1].reshape(BITS, BITS) / max(n, 1)
    ones = np.diag(both).copy()
    spread = np.sqrt(np.maximum(ones * (1 - ones), 1e-9))
    return n, ones, (both - np.outer(ones, ones)) / np.outer(spread, spread)


def group_bits(correlation: np.ndarray, parts: int) -> list[list[int]]:
    """Parts of nearly equal size, each grown by the free bit that its bits correlate with most."""
    strength = np.abs(correlation)
    np.fill_diagonal(strength, 0)
    free, groups = set(range(BITS)), []
    for i in range(parts):
        size = BITS // parts + (i < BITS % parts)
        rest = sorted(free)
        group = [max(rest, key=lambda b: (strength[b, rest].max(), -b))]
        while len(group) < size:
            group.append(max(sorted(free - set(group)), key=lambda b: (strength[b, group].sum(), -b)))
        groups.append(sorted(group))
        free -= set(group)
    return groups


def allocate(cost: list[list[float]], total: int) -> list[int]:
    """Thresholds from -1 that add up to ``total`` at the least cost; ``cost[i][t + 1]``."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for row in cost:
        following: dict[int, tuple[float, list[int]]] = {}
        for used, (spent, chosen) in best.items():
            for t, c in enumerate(row, start=-1):
                candidate = (spent + c, chosen + [t])
                if used + t not in following or candidate < following[used + t]:
                    following[used + t] = candidate
        best = following
    return best[total][1]


def estimate(n: int, ones: np.ndarray, group: list[int], same: int | None, most: int) -> list[float]:
    """Probes plus candidates of a part for thresholds -1..most: independent bits, scaled to the pairs counted as equal, if they are."""
    pairs = n * (n - 1) / 2
    chance = np.zeros(most + 1)
    chance[0] = 1.0
    for p in 2 * ones[group] * (1 - ones[group]):
        chance[1:] = chance[1:] * (1 - p) + chance[:-1] * p
        chance[0] *= 1 - p
    scale = 1.0 if same is None else (same + 1) / (pairs * chance[0] + 1)
    within = np.minimum(np.cumsum(chance) * pairs * scale, pairs)
    probes = np.cumsum([comb(len(group), t) for t in range(most + 1)]) * n
    return [0.0, *(within + probes).tolist()]


def signed(value: int) -> int:
    """The 64 bits as Spark's LONG."""
    return (value + (1 << BITS - 1)) % (1 << BITS) - (1 << BITS - 1)


def choose_parts(n: int, ones: np.ndarray, correlation: np.ndarray, within: int) -> int:
    """The number of parts with the least estimated probes and candidates of ``n`` fingerprints.

    Few parts have long keys, which many fingerprints need, and wide thresholds, which cost probes; more parts the reverse.
    """

    def least_cost(parts: int) -> float:
        groups = group_bits(correlation, parts)
        cost = [estimate(n, ones, g, None, within) for g in groups]
        return sum(c[t + 1] for c, t in zip(cost, allocate(cost, within - parts + 1)))

    return min(range(1, min(within + 1, MOST_PARTS) + 1), key=least_cost)


def plan_search(distinct: DataFrame, within: int, parts: int | None) -> list[tuple[int, list[int]]]:
    """For each part in use its mask, and the masks of up to t_i bits to flip."""
    n, ones, correlation = bit_statistics(distinct)
    parts = choose_parts(n, ones, correlation, within) if parts is None else parts
    groups = group_bits(correlation, parts)
    masks = [sum(1 << b for b in g) for g in groups]
    keyed = distinct.select(F.explode(keys(masks)).alias("k")).select("k.*").groupBy("part", "key").agg(F.count(F.lit(1)).alias("n"))
    pairs = keyed.groupBy("part").agg(F.sum(F.expr("n * (n - 1) div 2")).alias("pairs")).collect()
    same = {row["part"]: int(row["pairs"]) for row in pairs}
    cost = [estimate(n, ones, g, same.get(i, 0), within) for i, g in enumerate(groups)]
    thresholds = allocate(cost, within - parts + 1)
    flips = [[signed(sum(1 << b for b in some)) for t in range(limit + 1) for some in combinations(g, t)] for g, limit in zip(groups, thresholds)]
    return [(signed(m), f) for m, f, t in zip(masks, flips, thresholds) if t >= 0]


def keys(masks: list[int]) -> Column:
    return F.array(*[F.struct(F.lit(i).alias("part"), F.col("simhash").bitwiseAND(F.lit(signed(m))).alias("key")) for i, m in enumerate(masks)])


def probes(fingerprint: Column, search: list[tuple[int, list[int]]]) -> Column:
    """Every bucket to look into for a fingerprint: its key in each part, with each set of bits flipped."""

    def of_part(part: int, mask: int, flips: list[int]) -> Column:
        key = fingerprint.bitwiseAND(F.lit(mask))
        return F.transform(F.lit(flips), lambda flip: F.struct(F.lit(part).alias("part"), key.bitwiseXOR(flip).alias("key")))

    return F.concat(*[of_part(i, mask, flips) for i, (mask, flips) in enumerate(search)])


def links(distinct: DataFrame, within: int, parts: int | None = None) -> DataFrame:
    """Pairs (``a``, ``b``) of fingerprints that connect all that are within the distance.

    ``distinct`` has one row for each ``simhash`` and is written out. Every pair across ordinary
    buckets is verified and returned. A bucket of more than ``DENSE_BUCKET`` fingerprints first
    links its members to a few of them (its centres); the searched pairs are then those of
    different groups. The groups stay the same as with all pairs, without listing them.

    Spark takes an exploded table for as small as the one it came from, and where no bucket is dense, adaptive execution
    sees nothing else of the search's sides. So no exploded table is left to be broadcast by its estimate.
    """
    search = plan_search(distinct, within, parts)
    index = distinct.select("simhash", F.explode(keys([m for m, _ in search])).alias("k")).select("k.part", "k.key", "simhash")
    near = distance(F.col("a"), F.col("b")) <= within

    # Centres: of each dense bucket the members first in some orders of hashes.
    orders = [F.min(F.struct(F.xxhash64("simhash", F.lit(seed)).alias("h"), F.col("simhash").alias("b"))) for seed in range(4)]
    dense = (
        index.groupBy("part", "key")
        .agg(F.count(F.lit(1)).alias("n"), F.array(*orders).alias("centres"))
        .filter(F.col("n") > DENSE_BUCKET)
        .select("part", "key", F.explode(F.array_distinct("centres.b")).alias("b"))
    )
    dense = stage(dense)
    centres = F.broadcast(dense) if dense.count() <= BROADCAST_GROUPS else dense.hint("merge")
    starred = stage(index.join(centres, ["part", "key"]).select(F.col("simhash").alias("a"), "b").filter(near & (F.col("a") != F.col("b"))).distinct())
    known = stage(connected(starred))  # node, group; fingerprints that aren't there are groups of one

    own = stage(distinct.join(known, distinct["simhash"] == known["node"], "left").select("simhash", F.coalesce("group", "simhash").alias("group")))
    held = own.select("group", "simhash", F.explode(keys([m for m, _ in search])).alias("k")).select("k.part", "k.key", F.col("simhash").alias("b"), F.col("group").alias("gb"))
    # In a dense bucket, members of its largest group look for members of other groups only.
    largest = stage(
        held.join(dense.select("part", "key").distinct(), ["part", "key"], "left_semi")
        .groupBy("part", "key", "gb")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("part", "key")
        .agg(F.max_by("gb", F.struct("n", "gb")).alias("largest"))
    )
    # A row for all, and one more in the list of others of a dense bucket.
    lists = F.when(F.col("gb") != F.col("largest"), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    held = held.join(largest, ["part", "key"], "left").select("part", "key", "b", "gb", F.explode(lists).alias("list"))
    probing = (
        own.select("simhash", "group", F.explode(probes(F.col("simhash"), search)).alias("k"))
        .select("k.part", "k.key", F.col("simhash").alias("a"), F.col("group").alias("ga"))
        .join(largest, ["part", "key"], "left")
        .select("part", "key", "a", "ga", F.when(F.col("ga") == F.col("largest"), 1).otherwise(0).alias("list"))
    )
    found = probing.join(held.hint("merge"), ["part", "key", "list"]).filter(near & (F.col("ga") != F.col("gb")))
    return starred.unionByName(found.select("a", "b"))


def near_duplicates(docs: DataFrame, shingle: int = 4, within: int = 4, parts: int | None = None) -> DataFrame:
    """``doc_id``, ``text_hash``, ``simhash``, ``group`` and ``component_id`` (smallest id of the group), one row per document."""
    hashed = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    narrow = stage(fingerprints(hashed, shingle, keep=["doc_id", "text_hash"]))
    distinct = stage(narrow.groupBy("simhash").agg(F.min("doc_id").alias("least")))
    groups = stage(connected(links(distinct, within, parts)))
    member = distinct.join(groups, distinct["simhash"] == groups["node"], "left").select("simhash", "least", F.coalesce("group", "simhash").alias("group"))
    smallest = member.groupBy("group").agg(F.min("least").alias("component_id"))
    classes = member.join(smallest, "group").select("simhash", "group", "component_id")
    return narrow.join(classes, "simhash")


def keep_first(docs: DataFrame, shingle: int = 4, within: int = 4, parts: int | None = None) -> DataFrame:
    """``docs`` with one row of each group: that of the smallest id, of the smallest text hash if the id repeats; NULL ids come last."""
    found = near_duplicates(docs, shingle, within, parts)
    place = [F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id"), F.col("text_hash")]
    alike = found.groupBy("group", *place).agg(F.count(F.lit(1)).alias("copies"))
    first = alike.groupBy("group").agg(F.min(F.struct("unnamed", "doc_id", "text_hash", "copies")).alias("f"))
    kept = stage(first.select(F.col("f.doc_id").alias("__id"), F.col("f.text_hash").alias("__hash"), F.col("f.copies").alias("copies")))
    hashed = docs.withColumn("__text_hash", F.xxhash64("text"))
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__text_hash") == F.col("__hash"))
    out = hashed.join(kept, same, "left_semi")
    if not kept.filter("copies > 1").isEmpty():
        out = out.dropDuplicates(["doc_id", "__text_hash"])
    return out.drop("__text_hash")
