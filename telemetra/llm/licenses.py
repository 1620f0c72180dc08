"""License scan: MinHash bands over overlapping text windows, then exact shingle containment.

Words are runs of ASCII letters and digits, lower-cased, and of non-ASCII characters; a shingle is
``SHINGLE`` consecutive words, of a template of fewer words all of them. A template of n shingles belongs to the scale B, the power of two
with B/2 < n <= B. At scale B a text is read in windows of 2B shingles that start every B, so
whatever B shingles in a row lie in one window. A window and a template that share 0.8 of the template's
shingles have a Jaccard similarity of at least 0.8n / (2B + 0.2n) > 0.19; with ``BANDS`` bands of one
minimum each they meet in a band with probability above 1 - 0.81^BANDS (for 64: 1 - 1.4e-6; a whole
template, above 1 - 1e-8). What meets is verified once, however many bands it meets in: exact share of the template's distinct
shingles in the window.

A minimum is over ``shingle hash XOR constant``, the constants spread over the leading bits. A band can only agree on a
shingle that both sides have; so positions whose shingle is in no template make no window, which
changes nothing in what bands retrieve. Whether one is in some template is asked of a Bloom filter of at most ``MOST_BITS`` bits, so
the corpus is scanned once whatever the list; a longer list only lets more windows through.
Bands travel without their windows, which are fetched for the pairs to be verified.

NULL, empty and short texts match nothing but shorter templates; templates without words are never
found. Repeated documents (same id) and repeated templates count once. Empty tables give empty
results. Extra columns aren't used. A text is worked on whole, in one task. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from telemetra.llm.common import let
from telemetra.llm.license_texts import NOTICES, TEXTS
from telemetra.operators.scale import BROADCAST_GROUPS
from telemetra.sources.staging import stage

SHINGLE = 5
LEAST_CONTAINMENT = 0.8
BANDS = 64
#: Bits of the filter of shingles, which tasks get as a literal of half a megabyte at most.
MOST_BITS, BITS_PER_SHINGLE, BITS_SET = 1 << 22, 256, 4


def notices(spark: SparkSession) -> DataFrame:
    """The texts and notices of ``license_texts``."""
    rows = [F.struct(F.lit(name).alias("license_id"), F.lit(text).alias("text")) for name, text in sorted({**NOTICES, **TEXTS}.items())]
    return spark.range(1).select(F.inline(F.array(*rows)))


def words(text: Column) -> Column:
    plain = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.filter(F.split(plain, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), lambda w: w != "")


def shingles(text: Column, width: int = SHINGLE) -> Column:
    """Hashes of the word shingles in order; empty for fewer words."""

    def of_words(w: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(w) - width)
        hashes = F.transform(places, lambda i: F.xxhash64(*[w[i + k] for k in range(width)]))
        return F.when(F.size(w) >= width, hashes).otherwise(F.array().cast("array<bigint>"))

    return let(words(text), of_words)


def band_values(hashes: Column) -> Column:
    """The least of ``hash XOR constant`` for each band, with the band's number in front."""

    def of_band(band: int) -> Column:
        constant = ((band << 58) ^ (band * 0x9E3779B97F4A7C15 & ((1 << 58) - 1))) % (1 << 64)
        constant -= (1 << 64) if constant >> 63 else 0
        return F.array_min(F.transform(hashes, lambda h: h.bitwiseXOR(F.lit(constant))))

    return F.array(*[F.struct(F.lit(b).alias("band"), of_band(b).alias("value")) for b in range(BANDS)])


def prepared(templates: DataFrame) -> DataFrame:
    """``template`` (number), ``license_id``, ``width`` and distinct ``shingles`` with their number, ``scale``."""
    split = templates.filter("license_id IS NOT NULL").select("license_id", "text", F.least(F.size(words(F.col("text"))), F.lit(SHINGLE)).alias("width"))
    of_width = F.coalesce(*[F.when(F.col("width") == w, shingles(F.col("text"), w)) for w in range(1, SHINGLE + 1)])
    split = split.filter("width > 0").select("license_id", "width", F.array_distinct(of_width).alias("shingles")).distinct()
    split = split.withColumn("n", F.size("shingles")).withColumn("template", F.xxhash64("license_id", "width", "shingles"))
    return split.withColumn("scale", F.expr("CASE WHEN n = 1 THEN 1 ELSE shiftleft(1, length(bin(n - 1))) END"))


def _places(hash_: Column, bits: int) -> list[tuple[Column, Column]]:
    """The words of the filter and the bits in them that a hash sets."""
    places = [F.pmod(F.xxhash64(hash_, F.lit(seed)), F.lit(bits)).cast("int") for seed in range(BITS_SET)]
    return [(F.shiftright(p, 6), F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(p, F.lit(64)))) for p in places]


def _filter_of(ready: DataFrame) -> list[int]:
    """Bloom filter of all shingles of the templates, as 64-bit words; it is made by Spark, and its size is bounded."""
    total = ready.agg(F.sum("n")).first()[0] or 0
    bits = min(max(1 << max(total * BITS_PER_SHINGLE - 1, 63).bit_length(), 64), MOST_BITS)
    hashes = ready.select(F.explode("shingles").alias("h"))
    placed = hashes.select(F.explode(F.array(*[F.struct(w.alias("word"), b.alias("bit")) for w, b in _places(F.col("h"), bits)])).alias("p"))
    found = [0] * (bits // 64)
    for row in placed.groupBy("p.word").agg(F.bit_or("p.bit").alias("bits")).collect():
        found[row["word"]] = row["bits"]
    return found


def scan(docs: DataFrame, templates: DataFrame) -> DataFrame:
    """One row for each document and license found: ``n_windows`` that hold it, the best ``containment``, the first ``position`` (word number)."""
    ready = stage(prepared(templates))
    kinds = sorted(tuple(r) for r in ready.select("width", "scale").distinct().collect())  # few: widths and powers of two
    widths = sorted({w for w, _ in kinds})
    held_bits = _filter_of(ready)
    listed = F.expr(f"cast(split('{','.join(map(str, held_bits))}', ',') AS ARRAY<BIGINT>)")

    def maybe_listed(h: Column) -> Column:
        tests = [F.get(listed, word).bitwiseAND(bit) != 0 for word, bit in _places(h, 64 * len(held_bits))]
        whole = tests[0]
        for test in tests[1:]:
            whole = whole & test
        return whole

    hashed = docs.select("doc_id", *[shingles(F.col("text"), w).alias(f"s{w}") for w in widths])
    at = [F.filter(F.transform(f"s{w}", lambda h, i: F.when(maybe_listed(h), i)), lambda i: i.isNotNull()).alias(f"at{w}") for w in widths]
    some = F.greatest(F.lit(0), *[F.size(f"at{w}") for w in widths]) if widths else F.lit(0)
    hashed = stage(hashed.select("*", *at).filter(some > 0).withColumn("row", F.monotonically_increasing_id()))

    # Starts of all windows that hold one of these positions, of each width and scale.
    starts = [
        F.transform(
            F.array_distinct(F.flatten(F.transform(f"at{width}", lambda i: F.array(F.floor(i / scale), F.floor(i / scale) - 1)))),
            lambda w: F.struct(F.lit(width).alias("width"), F.lit(scale).alias("scale"), (w * scale).cast("int").alias("start")),
        )
        for width, scale in kinds
    ]
    none = F.array().cast("array<struct<width:int,scale:int,start:int>>")
    of_width = F.coalesce(*[F.when(F.col("width") == w, F.col(f"s{w}")) for w in widths]) if widths else F.array().cast("array<bigint>")
    inside = F.slice(of_width, F.col("start") + 1, 2 * F.col("scale"))
    windows = hashed.select("row", *[f"s{w}" for w in widths], F.inline(F.concat(*starts) if starts else none)).filter("start >= 0")
    bands = windows.select("row", "width", "scale", "start", F.inline(band_values(inside)))
    wanted = ready.select("template", "width", "scale", F.inline(band_values(F.col("shingles"))))
    if ready.count() * BANDS <= BROADCAST_GROUPS:
        wanted = F.broadcast(wanted)
    met = bands.join(wanted, ["width", "scale", "band", "value"]).select("row", "template", "start").distinct()

    pairs = met.join(ready, "template").join(hashed.select("row", "doc_id", *[f"s{w}" for w in widths]), "row")
    pairs = pairs.select("doc_id", "license_id", "template", "start", "n", "shingles", inside.alias("held"))
    share = F.size(F.array_intersect("held", "shingles")) / F.col("n")
    shared = F.filter(F.transform("held", lambda h, i: F.when(F.array_contains("shingles", h), i)), lambda i: i.isNotNull())
    position = (F.col("start") + F.array_min(shared)).cast("long")
    found = pairs.select("doc_id", "license_id", "template", "start", share.alias("containment"), position.alias("position"))
    return (
        found.filter(F.col("containment") >= LEAST_CONTAINMENT)
        .groupBy("doc_id", "license_id")
        .agg(F.count_distinct("template", "start").alias("n_windows"), F.max("containment").alias("containment"), F.min("position").alias("position"))
    )
