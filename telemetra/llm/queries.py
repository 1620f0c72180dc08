"""The operators as queries over the given tables, with the SQL that must give the same rows."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from telemetra.llm import (
    decontaminate,
    hidden_markov,
    langid,
    license_texts,
    licenses,
    mixing,
    order_minhash,
    quality,
    simhash,
    spelling,
    token_counts,
    toxicity,
    url_filter,
    vector_codes,
)
from telemetra.llm.common import remainder, table, tokenizer_path
from telemetra.operators.scale import join_groups
from telemetra.sources.staging import stage

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return register


def held_out(modulus: int, value: int):
    """Whether the crc32 of the id leaves the remainder; false for a NULL id."""
    return F.coalesce(remainder(F.col("doc_id"), modulus) == value, F.lit(False))


WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

LEAKS_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all({LOWER.format("text")}, '{WORDS}'), []) AS w FROM documents),
b AS (SELECT DISTINCT item_id, w, least(len(w), 10) AS n FROM
  (SELECT item_id, regexp_extract_all({LOWER.format("text")}, '{WORDS}') AS w FROM benchmark) WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, n, array_to_string(w[i : i + n - 1], ' ') AS gram
  FROM (SELECT item_id, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM b)),
grams AS (SELECT r, n, i, array_to_string(w[i : i + n - 1], ' ') AS gram
  FROM (SELECT r, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM windows))),
hits AS (SELECT r, item_id, i, n FROM grams JOIN windows USING (n, gram)),
marked AS (SELECT r, count(DISTINCT word) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS word FROM hits) GROUP BY r),
named AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM hits WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN marked USING (r) LEFT JOIN named USING (r)"""


@query("op1_decontaminate", LEAKS_SQL)
def op1(spark, sf_dir):
    """Words of benchmark windows in every document."""
    found = decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return decontaminate.digest(found)


@query("op2_simhash_near_duplicates")
def op2(spark, sf_dir):
    """Fingerprint and group of near copies of every document."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.as_hex(F.col("simhash")).alias("fingerprint"), "component_id")


@query("op3_quality")
def op3(spark, sf_dir):
    """Quality of every document, learnt from the labels that aren't held out."""
    docs, held = table(spark, sf_dir, "documents"), held_out(4, 2)
    trees = quality.train(docs, table(spark, sf_dir, "labels").filter(~held))
    return quality.score(docs.withColumn("held_out", held), trees, keep=["doc_id", "held_out"])


@query("op4_token_counts")
def op4(spark, sf_dir):
    """Tokens of every document."""
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


@query("op5_toxicity")
def op5(spark, sf_dir):
    """Toxicity of every document, learnt from the labels that aren't held out."""
    docs, held = table(spark, sf_dir, "documents"), held_out(5, 0)
    net = toxicity.train(docs, table(spark, sf_dir, "labels").filter(~held))
    return toxicity.score(docs.withColumn("held_out", held), net, keep=["doc_id", "held_out"])


MIX_SQL = r"""
WITH sizes AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size FROM documents),
sources AS (SELECT source, CAST(sum(size) AS BIGINT) AS s, (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 AS place FROM sizes GROUP BY source),
weighed AS (SELECT source, s, CASE place WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w FROM sources),
levels AS (SELECT *, (1.5::DOUBLE * sum(s) OVER () - 2.0::DOUBLE * coalesce(sum(s) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) >= 2.0::DOUBLE * s / w AS capped
  FROM weighed WINDOW o AS (ORDER BY s / w, source IS NULL, source)),
targets AS (SELECT source, s, CASE WHEN capped THEN 2.0::DOUBLE * s ELSE w * ((1.5::DOUBLE * sum(s) OVER () - 2.0::DOUBLE * sum(CASE WHEN capped THEN s ELSE 0 END) OVER ())
    / sum(CASE WHEN capped THEN 0 ELSE w END) OVER ()) END AS target FROM levels),
joined AS (SELECT doc_id, size, s, target, targets.source, CASE WHEN s = 0 THEN 0 ELSE CAST(floor(target / s + 1e-9) AS BIGINT) END AS whole,
    CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 12) AS BIGINT) AS place
  FROM sizes JOIN targets ON sizes.source IS NOT DISTINCT FROM targets.source),
running AS (SELECT *, CAST(round(target) AS BIGINT) - whole * s AS open,
    coalesce(sum(size) OVER (PARTITION BY source ORDER BY size = 0, place, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM joined)
SELECT doc_id, CAST(size AS BIGINT) AS size, s AS source_size, target,
  CAST(whole * size + CASE WHEN whole >= 2 THEN 0 ELSE greatest(0, least(size, open - before)) END AS BIGINT) AS taken FROM running"""


@query("op6_mix_sources", MIX_SQL)
def op6(spark, sf_dir):
    """Words taken from every document for a mixture of sources."""
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query("op7_language")
def op7(spark, sf_dir):
    """Language of every document, learnt from those not held out."""
    docs, held = table(spark, sf_dir, "documents"), held_out(4, 2)
    model = langid.train(docs.filter(~held))
    return langid.predict(docs.withColumn("held_out", held), model, keep=["doc_id", "held_out"])


_NOTICES = ", ".join("('{}', '{}')".format(name, text.replace("'", "''")) for name, text in sorted({**license_texts.NOTICES, **license_texts.TEXTS}.items()))
LICENSE_SQL = f"""
WITH notices(license_id, text) AS (VALUES {_NOTICES}),
t AS (SELECT license_id, w, least(len(w), 5) AS width FROM (SELECT license_id, regexp_extract_all({LOWER.format("text")}, '{WORDS}') AS w FROM notices)),
wanted AS (SELECT DISTINCT license_id, width, array_to_string(w[i : i + width - 1], ' ') AS gram FROM (SELECT license_id, w, width, unnest(range(1, len(w) - width + 2)) AS i FROM t)),
scales AS (SELECT license_id, count(*) AS n, CAST(2 ** ceil(log2(count(*))) AS BIGINT) AS scale FROM wanted GROUP BY license_id),
d AS (SELECT doc_id, width, regexp_extract_all({LOWER.format("text")}, '{WORDS}') AS w FROM documents, (SELECT DISTINCT width FROM t)),
grams AS (SELECT doc_id, width, i - 1 AS pos, array_to_string(w[i : i + width - 1], ' ') AS gram FROM (SELECT doc_id, width, w, unnest(range(1, len(w) - width + 2)) AS i FROM d)),
placed AS (SELECT doc_id, license_id, n, scale, pos, gram FROM grams JOIN wanted USING (width, gram) JOIN scales USING (license_id)),
windows AS (SELECT *, (pos // scale - part) * scale AS start FROM placed, (VALUES (0), (1)) AS parts(part)),
shares AS (SELECT doc_id, license_id, start, count(DISTINCT gram) / CAST(any_value(n) AS DOUBLE) AS containment, min(pos) AS position
  FROM windows WHERE start >= 0 GROUP BY doc_id, license_id, start)
SELECT doc_id, license_id, count(*) AS n_windows, max(containment) AS containment, CAST(min(position) AS BIGINT) AS position
FROM shares WHERE containment >= 0.8 GROUP BY doc_id, license_id"""


@query("op8_license_scan", LICENSE_SQL)
def op8(spark, sf_dir):
    """License notices in every document."""
    return licenses.scan(table(spark, sf_dir, "documents"), licenses.notices(spark))


# Host, path and verdict of the rules.
URL_RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)

URL_SQL = f"""
WITH rules(rule_host, rule_path, verdict) AS (VALUES {", ".join(map(str, URL_RULES))}),
parsed AS (SELECT row_number() OVER () AS r, page_id, CASE WHEN contains(coalesce(url, ''), '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
split AS (SELECT r, page_id, {LOWER.format("regexp_extract(rest, '^[^/?#]*')")} AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM parsed),
best AS (SELECT r, arg_max(rule_host || rule_path, (length(rule_host || rule_path), length(rule_host))) AS rule, arg_max(verdict, (length(rule_host || rule_path), length(rule_host))) AS verdict
  FROM split JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY r)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM split LEFT JOIN best USING (r)"""


@query("op9_url_filter", URL_SQL)
def op9(spark, sf_dir):
    """Verdict on the URL of every page."""
    rules = [F.struct(*[F.lit(v).alias(n) for n, v in zip(("host", "path", "verdict"), rule)]) for rule in URL_RULES]
    rules = spark.range(1).select(F.inline(F.array(*rules)))
    return url_filter.judge(table(spark, sf_dir, "pages").select("page_id", "url"), rules).drop("url")


@query("op10_order_minhash")
def op10(spark, sf_dir):
    """Fingerprints of every document, an edited copy and the next document."""
    return order_minhash.fingerprints_with_edits(table(spark, sf_dir, "documents"))


def without_a_letter(doc_id: str, word: bytes) -> bytes:
    """The word, or for one in 97 the word without the letter that a hash of document and word names."""
    h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), zlib.crc32(f"{doc_id}:".encode()))
    if h % 97:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1 :]


@query("op11_spelling_variants")
def op11(spark, sf_dir):
    """Every word of all documents, with its near words' number, its form and root."""
    return spelling.with_forms(spelling.count_words(table(spark, sf_dir, "documents"), edit=without_a_letter))


def _codes_sql(parts: int, entries: int, rounds: int) -> str:
    near = "SELECT r, part, arg_min(entry, (d, entry)) AS entry, min(d) AS d FROM (SELECT r, part, entry, sum((x - c) * (x - c)) AS d FROM parts JOIN book{k} USING (part, pos) GROUP BY r, part, entry) GROUP BY r, part"
    means = "SELECT part, entry, pos, CAST(floor(sum(x) / count(*)) AS BIGINT) AS m FROM parts JOIN near{k} USING (r, part) GROUP BY part, entry, pos"
    steps = [
        f"near{k} AS MATERIALIZED ({near.format(k=k)}),\nbook{k + 1} AS MATERIALIZED (SELECT part, entry, pos, coalesce(m, c) AS c FROM book{k} LEFT JOIN ({means.format(k=k)}) USING (part, entry, pos))"
        for k in range(rounds)
    ]
    return f"""
WITH kept AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r, vec_id, label, embedding FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (SELECT r, (i - 1) // (n // {parts}) AS part, (i - 1) % (n // {parts}) AS pos, CAST(floor({vector_codes.SCALE} * CAST(embedding[i] AS DOUBLE)) AS BIGINT) AS x
  FROM (SELECT r, embedding, len(embedding) AS n, unnest(range(1, len(embedding) + 1)) AS i FROM kept)),
book0 AS MATERIALIZED (SELECT part, r - 1 AS entry, pos, x AS c FROM parts WHERE r <= {entries}),
{("," + chr(10)).join(steps)},
last AS MATERIALIZED ({near.format(k=rounds)}),
coded AS (SELECT r, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM last GROUP BY r),
rows AS (SELECT vec_id, label, code, error FROM kept JOIN coded USING (r)),
labels_of AS (SELECT label, CAST(sum(error) AS BIGINT) AS label_error FROM rows GROUP BY label)
SELECT vec_id, code, error, label_error, (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY part, entry, pos)) FROM book{rounds}) AS codebooks_sha256
FROM rows JOIN labels_of ON rows.label IS NOT DISTINCT FROM labels_of.label"""


@query("op12_vector_codes", _codes_sql(vector_codes.PARTS, vector_codes.ENTRIES, vector_codes.ROUNDS))
def op12(spark, sf_dir):
    """Codes of all vectors, with their errors and those of their labels."""
    vectors = table(spark, sf_dir, "embeddings")
    books = vector_codes.train(vectors)
    coded = stage(vector_codes.encode(vectors, books, keep=["vec_id", "label"]))
    sums = stage(coded.groupBy("label").agg(F.sum("error").alias("label_error")))
    whole = join_groups(coded, sums, ["label"], sums.count())
    return whole.select("vec_id", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))


@query("op13_language_model")
def op13(spark, sf_dir):
    """Log-probability of every document by the hidden Markov model and by frequencies, learnt from those not held out."""
    held = held_out(7, 2)
    return hidden_markov.language_scores(table(spark, sf_dir, "documents").withColumn("held_out", held), ~held, keep=["doc_id", "held_out"])
