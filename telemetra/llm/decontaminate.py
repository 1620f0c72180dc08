"""Benchmark decontamination: one Aho-Corasick automaton over the word windows of all items.

Texts are normalised byte for byte (A-Z lower-cased, other ASCII signs made spaces, runs of
spaces one space), so that an offset in the normalised text is that of a word, and a word that
of its bytes in the original. A window is ``window`` consecutive words of an item; a shorter item
is one window. Each text is scanned once, whole.

The automaton goes to the executors; its size is checked: items beyond ``MOST_PATTERN_BYTES`` of
windows are scanned in several blocks, each with an automaton of its own, and their findings
are united. NULL and empty texts have no words; items without words have no windows. An item
with a NULL id marks words but isn't named. Repeated items count once, repeated documents are
judged each by itself, empty tables give empty results or no findings. Columns of the
documents named like an added one are replaced.
"""

from __future__ import annotations

from uuid import uuid4

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from telemetra.llm.common import WORDS_ONLY, map_texts
from telemetra.sources.staging import stage

#: Bytes of all windows in one automaton; a window of ten words has about 70.
MOST_PATTERN_BYTES = 24 << 20
FOUND = "n_words LONG, ranges ARRAY<STRUCT<first: LONG, last: LONG>>, spans ARRAY<STRUCT<start: LONG, end: LONG>>, items ARRAY<STRING>"
_automata: dict[str, ahocorasick.Automaton] = {}


def windows_of(text: bytes | None, window: int) -> set[str]:
    words = (text or b"").translate(WORDS_ONLY).split()
    last = max(len(words) - window, 0)
    return {f" {b' '.join(words[i : i + window]).decode('latin-1')} " for i in range(last + 1)} if words else set()


def build(items: list[tuple[str | None, bytes | None]], window: int) -> ahocorasick.Automaton:
    owners: dict[str, set[str]] = {}
    for item, text in items:
        for pattern in windows_of(text, window):
            owners.setdefault(pattern, set()).update([] if item is None else [item])
    automaton = ahocorasick.Automaton()
    for pattern, names in owners.items():
        automaton.add_word(pattern, (len(pattern), names))
    automaton.make_automaton()
    return automaton


def scan(text: bytes | None, automaton: ahocorasick.Automaton) -> tuple[int, list, list, list]:
    """Number of words; hit ranges of words (0-based, both ends inside); the same in code points of the original (end outside); items."""
    plain = (text or b"").translate(WORDS_ONLY)
    words = plain.split()
    if not words or automaton.kind != ahocorasick.AHOCORASICK:
        return len(words), [], [], []
    normal = f" {b' '.join(words).decode('latin-1')} "
    found = [(end - size + 1, end, names) for end, (size, names) in automaton.iter(normal)]
    if not found:
        return len(words), [], [], []
    gaps = np.flatnonzero(np.frombuffer(normal.encode("latin-1"), np.uint8) == 32)
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, np.searchsorted(gaps, [f[0] for f in found]), 1)
    np.add.at(change, np.searchsorted(gaps, [f[1] for f in found]), -1)
    hit = np.concatenate(([0], np.cumsum(change[:-1]) > 0, [0])).astype(np.int8)
    first, last = np.flatnonzero(np.diff(hit) == 1), np.flatnonzero(np.diff(hit) == -1) - 1
    inside = np.concatenate(([0], np.frombuffer(plain, np.uint8) != 32, [0])).astype(np.int8)
    starts, ends = np.flatnonzero(np.diff(inside) == 1), np.flatnonzero(np.diff(inside) == -1)
    points = np.concatenate(([0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)))  # code points before a byte
    spans = zip(points[starts[first]].tolist(), points[ends[last]].tolist())
    return len(words), list(zip(first.tolist(), last.tolist())), list(spans), sorted(set().union(*(f[2] for f in found)))


def _scan_all(docs: DataFrame, items: list, window: int, keep: list[str] | None) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(items)
    name = uuid4().hex

    def begin():
        automaton = _automata.get(name)  # a worker builds it once, not in each task
        if automaton is None:
            _automata.clear()
            automaton = _automata[name] = build(shared.value, window)

        def compute(texts):
            found = [scan(t, automaton) for t in texts]
            pairs = lambda at, a, b: pa.array([[{a: x, b: y} for x, y in f[at]] for f in found], pa.list_(pa.struct([(a, pa.int64()), (b, pa.int64())])))
            return {
                "n_words": pa.array([f[0] for f in found], pa.int64()),
                "ranges": pairs(1, "first", "last"),
                "spans": pairs(2, "start", "end"),
                "items": pa.array([f[3] for f in found], pa.list_(pa.string())),
            }

        return compute

    return map_texts(docs, begin, FOUND, keep=keep, as_bytes=True)


def find_leaks(docs: DataFrame, benchmark: DataFrame, window: int = 10, keep: list[str] | None = None) -> DataFrame:
    """Documents with ``n_words``, ``n_hit`` (words inside windows), ``spans`` (hit code points) and ``items`` (ids as text)."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("binary").alias("text")).filter("text IS NOT NULL").distinct()
    size = items.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    blocks = -(-size * window // MOST_PATTERN_BYTES) or 1
    out_columns = [c for c in (keep or docs.columns) if c not in ("n_words", "n_hit", "spans", "items")]
    found = docs
    for block in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("text"), F.lit(blocks)) == block)
        rows = [(row["item"], bytes(row["text"])) for row in part.collect()]  # bounded by MOST_PATTERN_BYTES
        carried = out_columns if block + 1 == blocks else sorted({*out_columns, "text"})
        before = [c for c in found.columns if c.startswith("__before")]
        found = _scan_all(found, rows, window, [*carried, *before])
        if before:
            joined = {c: F.concat(F.col("__before").getField(c), F.col(c)) for c in ("ranges", "spans", "items")}
            found = found.withColumns(joined).drop("__before")
        if block + 1 < blocks:
            found = stage(found.withColumn("__before", F.struct("ranges", "spans", "items")).drop("n_words", "ranges", "spans", "items"))
    hit = F.array_distinct(F.flatten(F.transform("ranges", lambda r: F.sequence(r["first"], r["last"]))))
    return found.select(
        *out_columns,
        "n_words",
        F.size(hit).cast("long").alias("n_hit"),
        F.array_sort(F.array_distinct("spans")).alias("spans"),
        F.array_sort(F.array_distinct("items")).alias("items"),
    )


def digest(found: DataFrame) -> DataFrame:
    """The findings as numbers and a digest of the item ids, one row per document."""
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
