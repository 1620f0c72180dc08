"""Spelling variants: words that differ by one letter, and the form each of them probably stands for.

1. ``count_words``: tasks add up the maximal runs of Latin letters of whole texts, a shuffle makes one row of each word.
2. ``near_words``: two words that differ by one inserted, deleted or replaced letter have letter counts at a squared
   distance of at most two, and lengths at most one apart. Words lie in blocks: of one length, and in it of
   equal numbers of letters of a few classes (a coarser letter count, which moves by one letter at most in the
   same way). Every block meets itself and the adjacent ones; the letter counts of two blocks are multiplied
   (a Gram matrix), which gives all squared distances at once. Pairs at most two apart are kept, and their
   edit is verified letter by letter. A block that is larger than ``BLOCK_WORDS`` or ``BLOCK_LETTERS`` is
   divided, and its pieces meet each other; nothing is cut off.
3. ``with_forms``: a word's form is the most frequent of its near words, if that is frequent enough; following
   forms leads to its root. Frequencies at least grow from form to form, so doubling the steps ends.

The number of classes follows the number of words; it decides which blocks exist, never which pairs are found.
NULL and empty texts have no words, a NULL id counts as empty where an edit asks for it, repeated rows count each time, and empty
tables give empty results. Very long runs are words like others. Other columns are not looked at.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from telemetra.llm.common import pieces
from telemetra.sources.staging import stage

LEAST_LETTERS, LEAST_COUNT, TIMES = 5, 3, 2
#: Words and letters of a block's piece, about.
BLOCK_WORDS, BLOCK_LETTERS = 1024, 1 << 18
#: Distinct words, and their bytes, that a task adds up before it hands them on.
HELD, HELD_BYTES = 400_000, 32 << 20
#: Letters as Latin-1 bytes, A-Z lower-cased; everything else a space.
RUNS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256))
LETTERS = np.r_[97:123, 0xC0:0x100]
#: Longest words whose squared letter counts 32-bit floats hold exactly.
SINGLE = 2000

#: Takes a document's id as text and a word (Latin-1), returns the word that counts in its place.
Edit = Callable[[str, bytes], bytes]


def count_words(
    docs: DataFrame,
    least_letters: int = LEAST_LETTERS,
    least_count: int = LEAST_COUNT,
    edit: Edit | None = None,
    id_column: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``word`` and its number of occurrences ``n``; words of too few letters or occurrences are left out.

    ``edit`` may change or shorten a document's words before they count, never lengthen them.
    """
    source = docs.select(F.col(f"`{id_column}`").cast("string").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, int] = {}
        size = 0

        def hand_on() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in held], pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            for piece in pieces(batch, "text"):
                for name, whole in zip(piece.column("id").to_pylist(), piece.column("text").to_pylist()):
                    runs = (whole or "").encode("latin-1", "replace").translate(RUNS).split()
                    for word, n in Counter([w for w in runs if len(w) >= least_letters]).items():
                        if edit is not None:
                            word = edit(name or "", word)
                            if len(word) < least_letters:
                                continue
                        before = held.get(word)
                        if before is None:
                            size += len(word)
                            held[word] = n
                        else:
                            held[word] = before + n
                    if len(held) >= HELD or size >= HELD_BYTES:
                        yield hand_on()
                        held.clear()
                        size = 0
        yield hand_on()

    counted = source.mapInArrow(add_up, "word STRING, n LONG").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= least_count)


def letter_classes(words: DataFrame, classes: int) -> list[str]:
    """The letters dealt to classes of about equal frequency; at most one row for each letter comes to the driver."""
    letters = words.select(F.explode(F.split("word", "")).alias("letter")).where("letter != ''").groupBy("letter").count().collect()
    dealt, load = [""] * classes, [0] * classes
    for letter, n in sorted(letters, key=lambda r: (-r["count"], r["letter"])):
        least = load.index(min(load))
        dealt[least] += letter
        load[least] += n
    return dealt


def _cell(word: Column, classes: list[str]) -> Column:
    """How many letters of each class."""
    return F.array(*[F.length(word) - F.length(F.translate(word, c, "")) if c else F.lit(0) for c in classes])


def blocks(words: DataFrame, classes: list[str]) -> DataFrame:
    """A row for each piece of a block: its cell, number, length of words, letters one after the other, and counts."""
    cells = stage(words.select("word", "n", _cell(F.col("word"), classes).alias("cell")))
    length = F.aggregate("cell", F.lit(0), lambda a, x: a + x)
    rows = F.greatest(F.lit(1), F.least(F.lit(BLOCK_WORDS), F.floor(F.lit(BLOCK_LETTERS) / length)))
    sizes = cells.groupBy("cell").agg(F.count(F.lit(1)).alias("size")).select("cell", F.ceil(F.col("size") / rows).alias("pieces"))
    placed = cells.join(sizes, "cell").withColumn("piece", F.pmod(F.xxhash64("word"), F.col("pieces")))
    members = F.sort_array(F.collect_list(F.struct("word", "n")))
    gathered = placed.groupBy("cell", "piece").agg(members.alias("m"))
    return gathered.select(
        "cell", "piece", length.alias("length"), F.array_join(F.transform("m", lambda e: e["word"]), "").alias("letters"), F.transform("m", lambda e: e["n"]).alias("counts")
    )


def _adjacent(cell: Column, classes: int) -> Column:
    """Cells that a block visits: its own, those with one letter moved to a later class, those with one letter more."""
    moves = [[]] + [[(i, 1), (j, -1)] for i in range(classes) for j in range(i)] + [[(i, 1)] for i in range(classes)]
    target = lambda move: F.array(*[cell[i] + dict(move).get(i, 0) for i in range(classes)])
    return F.array(*[target(m) for m in moves])


def _rows(letters: str, length: int) -> np.ndarray:
    return np.frombuffer(letters.encode("latin-1"), np.uint8).reshape(-1, length)


def _letter_counts(rows: np.ndarray) -> np.ndarray:
    flat = rows + np.arange(len(rows))[:, None] * 256
    kind = np.float32 if rows.shape[1] <= SINGLE else np.float64
    return np.bincount(flat.ravel(), minlength=256 * len(rows)).reshape(-1, 256)[:, LETTERS].astype(kind)


def near_pairs(own: np.ndarray, other: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the pairs of rows that differ by one edit; words of ``other`` are as long, or one shorter."""
    a, b = _letter_counts(own), _letter_counts(other)
    squared = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1) - 2 * (a @ b.T)
    i, j = np.nonzero(squared <= 2)
    if same:
        i, j = i[i < j], j[i < j]
    long, short = own[i], other[j]
    if own.shape[1] == other.shape[1]:
        edited = (long != short).sum(axis=1) == 1
    else:
        start = np.logical_and.accumulate(long[:, :-1] == short, axis=1).sum(axis=1)
        end = np.logical_and.accumulate((long[:, 1:] == short)[:, ::-1], axis=1).sum(axis=1)
        edited = start + end >= short.shape[1]
    return i[edited], j[edited]


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def texts(rows: np.ndarray) -> list[str]:
        return [r.tobytes().decode("latin-1") for r in rows]

    for batch in batches:
        for row in range(batch.num_rows):
            at = {n: batch.column(n)[row].as_py() for n in ("own_letters", "own_length", "letters", "length", "same")}
            own, other = _rows(at["own_letters"], at["own_length"]), _rows(at["letters"], at["length"])
            i, j = near_pairs(own, other, at["same"])
            if len(i):
                own_counts, counts = (batch.column(n)[row].values.to_numpy() for n in ("own_counts", "counts"))
                one, two = texts(own[i]), texts(other[j])
                arrays = [pa.array(one + two, pa.string()), pa.array(two + one, pa.string()), pa.array(np.concatenate([counts[j], own_counts[i]]))]
                yield pa.RecordBatch.from_arrays(arrays, names=["word", "near", "near_n"])


def near_words(words: DataFrame) -> DataFrame:
    """``word``, ``near``, ``near_n``: every pair of words one edit apart, both ways."""
    total = words.count()
    classes = letter_classes(words, max(3, min(8, round(math.log10(max(total, 1))) - 1)))
    held = stage(blocks(words, classes))
    visit = F.explode(F.transform(_adjacent(F.col("cell"), len(classes)), lambda t: F.struct(t.alias("target"), (t == F.col("cell")).alias("same"))))
    visits = held.select("piece", "length", "letters", "counts", visit.alias("v")).select("piece", "length", "letters", "counts", "v.target", "v.same")
    own = held.select(*[F.col(c).alias(f"own_{c}") for c in held.columns])
    met = visits.join(own, visits["target"] == own["own_cell"]).where(~F.col("same") | (F.col("own_piece") <= F.col("piece")))
    met = met.withColumn("same", F.col("same") & (F.col("own_piece") == F.col("piece")))
    return met.select("own_letters", "own_length", "own_counts", "letters", "length", "counts", "same").mapInArrow(_near, "word STRING, near STRING, near_n LONG")


def with_forms(words: DataFrame, times: int = TIMES) -> DataFrame:
    """``word``, ``n`` and its ``form``, ``root``, number of near words ``n_near`` and the form's ``form_n``.

    The form is the near word of largest n (ties: smallest in code-point order), if that is ``times`` the word's at
    least, which must be over 1; else NULL. The root is where following forms ends.
    """
    if times < 2:
        raise ValueError("forms must be more frequent than their words")
    words = stage(words.select("word", "n"))
    best = near_words(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    enough = -F.col("best.less") >= times * F.col("n")
    formed = words.join(best, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(enough, F.col("best.near")).alias("form"),
        F.when(enough, -F.col("best.less")).alias("form_n"),
    )
    formed = stage(formed)
    steps = formed.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        on = steps.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        steps = stage(steps.join(on, "root", "left").select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")))
        if steps.where("moved").isEmpty():
            break
        steps = steps.drop("moved")
    return formed.join(steps.drop("moved"), "word", "left").select("word", "n", "form", F.coalesce("root", "word").alias("root"), "n_near", "form_n")
