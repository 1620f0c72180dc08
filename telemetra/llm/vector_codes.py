"""Codes of vectors: each part of a vector becomes the index of its nearest codebook entry.

Components are whole numbers, ``floor(scale * x)``, so that every distance, tie and mean is exact. The
codebook of a part position starts as the parts of the vectors with the smallest ids; each round assigns all parts
and puts the floor of the mean of its parts in an entry's place. Ties go to the lower index, entries without parts stay.

Assigning looks at memoised grid cells: a part's components are cut into coarse cells, and for the
box of a cell an entry is ruled out if its least distance from the box is beyond the greatest distance of some
other entry, as then no point of the box is nearest to it. Tasks keep the entries left for the cells
they have met (``REMEMBERED`` of each part, then they begin anew), and only those entries
are compared exactly. Rounds return sums and counts for each entry: the driver holds the codebooks only.

Rows are dropped whose vector is NULL or empty, has NULL or non-finite components, or another length than the kept
vector with the smallest id (NULL ids come last; among equal ids the lesser vector first). Repeated rows all count
and are all returned; fewer vectors than entries give as many entries as there are. Empty tables give
empty results. Input columns named like a result's give way to it. A length that the number of parts does not
divide raises ValueError, and so does an error that a LONG can't hold.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Cells of each part that a task remembers.
REMEMBERED = 1 << 14
#: Cells that the entries' spread is cut into, each way.
CELLS = 8
#: Vectors assigned at once.
ROWS = 4096
#: Below this size squared distances of 64-bit numbers can't overflow; beyond, Python's numbers take over.
PLAIN = 1 << 26


class Codebooks(NamedTuple):
    """``entries[part, entry, position]``, and what ``floor`` was taken of."""

    entries: np.ndarray
    scale: int

    def sha256(self) -> str:
        """Hex digest of all components as decimal numbers, joined by commas."""
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def whole_numbers(values: np.ndarray, scale: int) -> np.ndarray:
    """``floor(scale * x)``: 64-bit numbers, or Python's where they are large."""
    values = values.astype(np.float64)
    if np.abs(values).max(initial=0) * scale < PLAIN:
        return np.floor(values * scale).astype(np.int64)
    exact = [int(v) * scale if abs(v) >= 2.0**53 else (int(n) * scale) // d for v in values.ravel() for n, d in [float(v).as_integer_ratio()]]
    return np.array(exact, dtype=object).reshape(values.shape)


def _usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & finite, F.lit(False))


def _kept(vectors: DataFrame, columns: Sequence[str], vector: str) -> DataFrame:
    values = F.col(f"`{vector}`").cast("array<double>")
    return vectors.select(*[F.col(f"`{c}`") for c in columns], values.alias("__vector__")).where(_usable(F.col("__vector__")))


class Cells:
    """Nearest entries of parts, by memoised grid cells."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        self.plain = entries.dtype == np.int64 and np.abs(entries).max(initial=0) < PLAIN
        spread = [int(book.max() - book.min()) if book.size else 0 for book in entries]
        self.width = [max(s // CELLS, 1) for s in spread]
        self.met: list[dict[bytes, bytes]] = [{} for _ in entries]

    def left(self, part: int, cells: np.ndarray) -> np.ndarray:
        """Which entries are left for each of the boxes."""
        low = cells * self.width[part]
        high = low + (self.width[part] - 1)
        book = self.entries[part]
        below, above = low[:, None, :] - book, book - high[:, None, :]
        least = (np.maximum(np.maximum(below, above), 0) ** 2).sum(axis=2)
        most = (np.maximum(-below, -above) ** 2).sum(axis=2)
        return least <= most.min(axis=1)[:, None]

    def remembered(self, part: int, cells: np.ndarray) -> np.ndarray:
        met = self.met[part]
        keys = [c.tobytes() for c in cells]
        new = [i for i, k in enumerate(keys) if k not in met]
        if len(met) + len(new) > REMEMBERED:
            met.clear()
            new = list(range(len(keys)))
        if new:
            met.update(zip([keys[i] for i in new], map(bytes, self.left(part, cells[new]).view(np.uint8))))
        return np.frombuffer(b"".join([met[k] for k in keys]), bool).reshape(len(keys), -1)

    def nearest(self, part: int, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of the nearest entry of each row."""
        book = self.entries[part]
        if not (self.plain and values.dtype == np.int64):
            apart = ((values[:, None, :].astype(object) - book.astype(object)) ** 2).sum(axis=2)
            index = apart.argmin(axis=1)
            return index, apart[np.arange(len(index)), index]
        cells = np.ascontiguousarray(values // self.width[part])
        _, firsts, of = np.unique(cells.view(np.dtype((np.void, cells.itemsize * cells.shape[1]))).ravel(), return_index=True, return_inverse=True)
        row, entry = np.nonzero(self.remembered(part, cells[firsts])[of])
        apart = np.full((len(values), len(book)), np.iinfo(np.int64).max)
        apart[row, entry] = ((values[row] - book[entry]) ** 2).sum(axis=1)
        index = apart.argmin(axis=1)
        return index, apart[np.arange(len(index)), index]


def _blocks(batches: Iterator[pa.RecordBatch], entries: np.ndarray, scale: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Rows of each batch with their whole numbers by part."""
    parts, _, width = entries.shape
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            piece = batch.slice(start, ROWS)
            values = piece.column("__vector__").flatten().to_numpy(zero_copy_only=False)
            yield piece, whole_numbers(values, scale).reshape(-1, parts, width)


def _round(kept: DataFrame, entries: np.ndarray, scale: int) -> np.ndarray:
    """The entries after assigning every part once."""
    parts, count, width = entries.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = Cells(entries)
        total, size = np.zeros((parts, count, width), dtype=object), np.zeros((parts, count), dtype=np.int64)
        for _, values in _blocks(batches, entries, scale):
            for part in range(parts):
                index, _ = cells.nearest(part, values[:, part])
                size[part] += np.bincount(index, minlength=count)
                for entry in np.unique(index):
                    total[part, entry] += values[index == entry, part].sum(axis=0)
        part, entry, position = np.nonzero(np.broadcast_to(size[:, :, None], total.shape))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array((part * count + entry) * width + position, pa.int64()),
                pa.array([Decimal(int(v)) for v in total[part, entry, position]], pa.decimal128(38, 0)),
                pa.array(size[part, entry], pa.int64()),
            ],
            names=["place", "total", "n"],
        )

    found = kept.select("__vector__").mapInArrow(sums, "place LONG, total DECIMAL(38,0), n LONG")
    moved = [int(e) for e in entries.ravel()]
    for row in found.groupBy("place").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect():  # a row for each number in the codebooks
        moved[row["place"]] = int(row["total"]) // row["n"]
    small = max(map(abs, moved), default=0) < PLAIN
    return np.array(moved, dtype=np.int64 if small else object).reshape(entries.shape)


def train(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector: str = "embedding",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> Codebooks:
    """Codebooks of ``entries`` for each of ``parts`` equal parts, from all vectors."""
    kept = _kept(vectors, [id_column], vector)
    order = [F.col(f"`{id_column}`").asc_nulls_last(), F.col("__vector__")]
    first = kept.orderBy(*order).limit(1).collect()
    if not first:
        return Codebooks(np.zeros((parts, 0, 0), dtype=np.int64), scale)
    length = len(first[0]["__vector__"])
    if length % parts:
        raise ValueError(f"{parts} parts don't divide vectors of {length} components")
    kept = kept.where(F.size("__vector__") == length)
    start = np.array([row["__vector__"] for row in kept.orderBy(*order).limit(entries).collect()])
    books = np.ascontiguousarray(whole_numbers(start, scale).reshape(len(start), parts, -1).transpose(1, 0, 2))
    for _ in range(rounds):
        books = _round(kept, books, scale)
    return Codebooks(books, scale)


def encode(vectors: DataFrame, codebooks: Codebooks, vector: str = "embedding", keep: Sequence[str] | None = None) -> DataFrame:
    """``code`` (two hex digits for each part) and ``error`` (summed squared distances) of every kept vector.

    ``keep`` names the columns of ``vectors`` that stay; all but the vector by default.
    """
    entries, scale = codebooks
    parts, count, width = entries.shape
    columns = [c for c in (vectors.columns if keep is None else keep) if c not in (vector, "code", "error")]
    schema = T.StructType([*[vectors.schema[c] for c in columns], T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    kept = _kept(vectors, columns, vector).where(F.size("__vector__") == parts * width)

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = Cells(entries)
        for piece, values in _blocks(batches, entries, scale):
            found = [cells.nearest(part, values[:, part]) for part in range(parts)]
            index = np.stack([i for i, _ in found], axis=1).astype(np.uint8)
            error = sum(e for _, e in found)
            if error.dtype == object and max(error) > np.iinfo(np.int64).max:
                raise ValueError("an error is too large for a LONG")
            text = pa.array([row.tobytes().hex() for row in index])
            yield pa.RecordBatch.from_arrays([*[piece.column(c) for c in columns], text, pa.array(error.tolist(), pa.int64())], names=[*columns, "code", "error"])

    if count > 256:
        raise ValueError("two hex digits hold 256 entries")
    return kept.mapInArrow(codes, schema)
