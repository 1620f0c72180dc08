"""URL filter: a blocked Bloom filter of listed entries, then an exact hash join.

An entry is a host and the start of a path with a verdict; it covers its host, all subdomains, and
every path that starts so. A URL is turned into its possible entries: each suffix of its host
with each start of its path whose length some entry has. Those go through the filter, a table of
blocks of ``WORDS`` times 64 bits keyed by block number and broadcast (its size is bounded by
``MOST_BLOCKS``; a longer list only makes more false hits), and what passes meets the list itself
in an equi-join. The longest entry wins; of equally long ones, the longer host, then the later text.

Each distinct URL is judged once and joined back, so a hot URL or host is one row until then.
NULL URLs and those without ``://`` have an empty host and path and no entry. Without an entry
the verdict is ``allow``, for only listed URLs are blocked. Repeated pages are all returned;
empty tables give empty results; repeated entries count once. Columns of the pages
named like an added one are replaced. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

WORDS = 8
BITS_PER_ENTRY = 16
BITS_SET = 6
#: Blocks of 64 bytes: 32 MB, which an executor can hold.
MOST_BLOCKS = 1 << 19
_SEED_BLOCK, _SEED_BITS = 11, 101


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(_SEED_BLOCK)), F.lit(blocks)).cast("int")


def _masks(key: Column) -> list[Column]:
    """The bits of a key in each word of its block."""
    bits = [F.pmod(F.xxhash64(key, F.lit(_SEED_BITS + i)), F.lit(WORDS * 64)).cast("int") for i in range(BITS_SET)]
    none = F.lit(0).cast("long")

    def of_word(word: int) -> Column:
        mask = none
        for bit in bits:
            shifted = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(bit, F.lit(64)))
            mask = mask.bitwiseOR(F.when(F.floor(bit / 64) == word, shifted).otherwise(none))
        return mask

    return [of_word(w) for w in range(WORDS)]


def bloom(keys: DataFrame, blocks: int) -> DataFrame:
    """Blocked Bloom filter of the column ``key``: ``block`` and the words ``w0`` to ``w7``."""
    masked = keys.select(_block(F.col("key"), blocks).alias("block"), *[m.alias(f"w{i}") for i, m in enumerate(_masks(F.col("key")))])
    return masked.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)])


def judge(pages: DataFrame, entries: DataFrame, url: str = "url") -> DataFrame:
    """Pages with ``host``, ``path``, ``rule`` (host and path of the entry that fits, else NULL) and ``verdict``.

    ``entries``: ``host``, ``path``, ``verdict``.
    """
    listed = (
        entries.filter("host IS NOT NULL AND verdict IS NOT NULL")
        .select("host", F.coalesce("path", F.lit("")).alias("path"), "verdict")
        .groupBy("host", "path")
        .agg(F.max("verdict").alias("verdict"))  # contradicting repeats: block
        .select(F.concat_ws("\n", "host", "path").alias("key"), F.length("host").alias("host_length"), F.concat("host", "path").alias("rule"), "verdict", F.length("path").alias("path_length"))
    )
    facts = listed.agg(F.count(F.lit(1)).alias("n"), F.collect_set("path_length").alias("lengths")).first()  # a few lengths of paths
    blocks = min(max(-(-facts["n"] * BITS_PER_ENTRY // (WORDS * 64)), 1), MOST_BLOCKS)
    lengths = sorted(facts["lengths"])

    kept = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    parsed = pages.select(*kept, host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    distinct = parsed.filter("host != ''").select("host", "path").distinct()
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    starts = F.filter(F.array(*[F.when(F.length("path") >= n, F.substring(F.col("path"), 1, n)) for n in lengths]), lambda s: s.isNotNull()) if lengths else F.array().cast("array<string>")
    possible = (
        distinct.select("host", "path", F.explode(suffixes).alias("suffix"), starts.alias("starts"))
        .select("host", "path", "suffix", F.explode("starts").alias("start"))
        .select("host", "path", F.concat_ws("\n", "suffix", "start").alias("key"))
        .withColumn("block", _block(F.col("key"), blocks))
    )
    passes = [F.col(f"w{i}").bitwiseAND(m) == m for i, m in enumerate(_masks(F.col("key")))]
    hits = possible.join(F.broadcast(bloom(listed, blocks)), "block")
    for test in passes:
        hits = hits.filter(test)
    best = (
        hits.select("host", "path", "key")
        .join(listed, "key")
        .groupBy("host", "path")
        .agg(F.max(F.struct(F.length("rule").alias("length"), "host_length", "rule", "verdict")).alias("best"))
        .select("host", "path", F.col("best.rule").alias("rule"), F.col("best.verdict").alias("verdict"))
    )
    # rows without a host meet nothing: they are dealt out by where they were read, not to one task
    apart = F.when(F.col("host") == "", F.spark_partition_id() + 1).otherwise(0)
    dealt = parsed.withColumn("__apart__", apart)
    return dealt.join(best.withColumn("__apart__", F.lit(0)), ["__apart__", "host", "path"], "left").select(*kept, "host", "path", "rule", F.coalesce("verdict", F.lit("allow")).alias("verdict"))
