"""Token counts: pieces are counted once per distinct pre-token and summed over documents by a join.

1. Every whole text is cut into pre-tokens by the tokenizer's own normaliser and pre-tokenizer;
   tasks add up how often each occurs, and a shuffle makes one row of each distinct pre-token.
2. The model splits each distinct pre-token once; only the number of its pieces is kept.
3. Each document's pre-token frequencies meet those numbers and are added up: the ``HEAD`` most
   frequent pre-tokens (a fixed bound on entries; of those of over ``KEY_LENGTH`` characters the
   SHA-256 stands for them) by a broadcast map, before
   the shuffle, all others by an equi-join on the pre-token. Hot pre-tokens, long ones too, are thus never
   shuffled, and no ids are made.

Special strings inside texts are one token each, which is the library's default. NULL
texts count as empty: 0 bytes, 0 tokens. Repeated rows are all returned, each with its own
count. Empty tables give empty results. Of the input the id and the text are read; other columns, clashing names
too, are neither used nor returned.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from telemetra.llm.common import pieces
from telemetra.sources.staging import stage

HEAD = 1 << 17
KEY_LENGTH = 64
#: Words whose pre-tokens a task remembers; distinct words it adds up before it hands them on.
REMEMBERED, HELD = 250_000, 400_000
#: The first combining mark.
PLAIN_BELOW = "\u0300"


class Cutter:
    """Pre-tokens of texts, by the parts of the tokenizer."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        special = self.tokenizer.get_added_tokens_decoder().values()
        if any(t.lstrip or t.rstrip or t.single_word or t.normalized for t in special):
            raise ValueError("added tokens that strip, match whole words or match normalised text aren't supported")
        found = sorted((t.content for t in special), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, found))) if found else None
        self.pattern = plain_pattern(json.loads(self.tokenizer.to_str()))

    def pre_tokens(self, text: str) -> tuple[str, ...]:
        """In normalised text, not in the alphabet of bytes."""
        plain = self.normal(text)
        return tuple(plain[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(plain))

    def normal(self, text: str) -> str:
        normaliser = self.tokenizer.normalizer
        return normaliser.normalize_str(text) if normaliser else text

    def pieces(self, pre_token: str) -> int:
        tokenize = self.tokenizer.model.tokenize
        return sum(len(tokenize(p)) for p, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(pre_token))

    def words(self, text: str | None) -> tuple[int, list[str], tuple[str, ...]]:
        """Special strings in a text; its words; or, for a text whose white space Python sees otherwise, its pre-tokens."""
        if not text:
            return 0, [], ()
        specials = 0
        if self.special is not None:
            parts = self.special.split(text)
            if len(parts) > 1:
                specials, text = len(parts) - 1, "\n".join(parts)  # white space parts pre-tokens as the special did
        if any(c in text for c in "\x1c\x1d\x1e\x1f"):
            return specials, [], self.pre_tokens(text)
        return specials, text.split(), ()

    def cut(self, words: list[str]) -> list[tuple[str, ...]]:
        """The pre-tokens of each word; white space keeps words apart."""
        if self.pattern is None:
            return [self.pre_tokens(w) for w in words]
        found = []
        for word in words:
            if word.isascii() or max(word) < PLAIN_BELOW:
                lower = word.lower()
                found.append((lower,) if lower.isalpha() else tuple(self.pattern.findall(lower)))
            else:
                found.append(self.pre_tokens(word))
        return found


def plain_pattern(settings: dict) -> regex.Pattern | None:
    """The pattern of pre-tokens, if they are its matches in the composed, lower-cased text; else None.

    Below ``PLAIN_BELOW`` all text is composed and no letter's lower case hangs on its neighbours, so that the standard
    library does what the tokenizer does, only faster; other words go through the tokenizer.
    """
    steps = (settings["normalizer"] or {}).get("normalizers", [])
    parts = (settings["pre_tokenizer"] or {}).get("pretokenizers", [])
    spaces = {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}
    if steps != [{"type": "NFC"}, spaces, {"type": "Lowercase"}] or [p["type"] for p in parts] != ["Split", "ByteLevel"]:
        return None
    split, to_bytes = parts
    if split["behavior"] != "Removed" or not split["invert"] or "Regex" not in split["pattern"] or to_bytes["use_regex"] or to_bytes["add_prefix_space"]:
        return None
    return regex.compile(split["pattern"]["Regex"])


_cutters: dict[str, Cutter] = {}


def cutter(path: str) -> Cutter:
    if path not in _cutters:
        _cutters[path] = Cutter(path)
    return _cutters[path]


def key_of(pre_token: str) -> str:
    """The pre-token, or for a long one a string that is longer than any kept as it is."""
    return pre_token if len(pre_token) <= KEY_LENGTH else f"#{hashlib.sha256(pre_token.encode()).hexdigest()}"


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield from pieces(batch, "text")


def vocabulary(docs: DataFrame, path: str) -> DataFrame:
    """Every distinct pre-token's ``key`` with ``n`` (occurrences in all texts) and ``pieces`` (tokens it becomes)."""

    def out(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["pre_token", "n"])

    def frequencies(batches):
        cut, words, total = cutter(path), Counter(), Counter()

        def hand_on():
            for tokens, n in zip(cut.cut(list(words)), words.values()):
                for p in tokens:
                    total[p] += n
            result = out(total)
            words.clear(), total.clear()
            return result

        for piece in _texts(batches):
            for text in piece.column("text").to_pylist():
                _, some, others = cut.words(text)
                words.update(some)
                total.update(others)
            if len(words) >= HELD:
                yield hand_on()
        yield hand_on()

    def split(batches):
        cut = cutter(path)
        for batch in batches:
            distinct = batch.column("pre_token").to_pylist()
            arrays = [pa.array([key_of(p) for p in distinct], pa.string()), batch.column("n"), pa.array([cut.pieces(p) for p in distinct], pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=["key", "n", "pieces"])

    distinct = docs.select(F.col("text").cast("string")).mapInArrow(frequencies, "pre_token STRING, n LONG").groupBy("pre_token").agg(F.sum("n").alias("n"))
    return distinct.mapInArrow(split, "key STRING, n LONG, pieces LONG")


def most_frequent(counted: DataFrame) -> DataFrame:
    """At most ``HEAD`` pre-tokens: all whose class of ``n`` (eighths of powers of two) is among the highest that fit."""
    level = F.floor(F.log2("n") * 8)
    room, least = HEAD, None
    for row in counted.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect():  # a few hundred classes
        if row["count"] > room:
            break
        room, least = room - row["count"], row["level"]
    return counted.filter(F.lit(False) if least is None else level >= least).select("key", "pieces")


def count_tokens(docs: DataFrame, path: str, limit: int = 2048, id_column: str = "doc_id") -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_tokens`` and ``over_limit``, one row per document."""
    spark = docs.sparkSession
    pieces_of = stage(vocabulary(docs, path))
    head = most_frequent(pieces_of).toPandas()
    shared = spark.sparkContext.broadcast(dict(zip(head["key"].tolist(), head["pieces"].tolist())))
    kind = docs.schema[id_column].dataType.simpleString()

    def frequencies(batches):
        """A row for each document, with the tokens known here, and one for each other pre-token of it."""
        cut, head = cutter(path), shared.value
        known: dict[str, tuple[int, tuple[str, ...]]] = {}  # word: tokens of its common pre-tokens, its other pre-tokens

        def learn(words: list[str]) -> None:
            for word, tokens in zip(words, cut.cut(words)):
                tokens = [key_of(p) for p in tokens]
                known[word] = sum(head.get(p, 0) for p in tokens), tuple(p for p in tokens if p not in head)

        for piece in _texts(batches):
            texts = [cut.words(text) for text in piece.column("text").to_pylist()]
            counted = [Counter(words) for _, words, _ in texts]
            if len(known) > REMEMBERED:
                known.clear()
            learn(list({w for counts in counted for w in counts if w not in known}))
            rows, tokens, rest, times = [], [], [], []
            for i, ((specials, _, others), counts) in enumerate(zip(texts, counted)):
                here, unknown = specials, Counter()
                for word, n in counts.items():
                    size, other = known[word]
                    here += size * n
                    for p in other:
                        unknown[p] += n
                for p in map(key_of, others):
                    if p in head:
                        here += head[p]
                    else:
                        unknown[p] += 1
                rows += [i] * (len(unknown) + 1)
                tokens += [here] + [None] * len(unknown)
                rest += [None, *unknown]
                times += [None, *unknown.values()]
            at = pa.array(np.array(rows, np.int64))
            kept = [piece.column(c).take(at) for c in ("doc_id", "row_hash", "n_bytes")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(tokens, pa.int64()), pa.array(rest, pa.string()), pa.array(times, pa.int64())],
                names=["doc_id", "row_hash", "n_bytes", "tokens", "key", "times"],
            )

    rows = docs.select(
        F.col(id_column).alias("doc_id"),
        F.xxhash64("text").alias("row_hash"),
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        F.col("text").cast("string").alias("text"),
    ).mapInArrow(frequencies, f"doc_id {kind}, row_hash LONG, n_bytes LONG, tokens LONG, key STRING, times LONG")
    rows = stage(rows)
    key = ["doc_id", "row_hash", "n_bytes"]
    others = rows.filter("key IS NOT NULL").select(*key, "key", "times").join(pieces_of.select("key", "pieces"), "key")
    known = rows.filter("key IS NULL").select(*key, "tokens", F.lit(1).alias("copies"))
    total = known.unionByName(others.select(*key, (F.col("times") * F.col("pieces")).alias("tokens"), F.lit(0).alias("copies")))
    # Rows alike in id and text add up together: each has its share.
    summed = total.groupBy(*key).agg(F.sum("tokens").alias("tokens"), F.sum("copies").alias("copies"))
    each = summed.withColumn("n_tokens", F.expr("tokens div copies")).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    return each.select(F.col("doc_id").alias(id_column), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
