"""What the operators on documents share."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

#: Bytes of text that a task turns into Python or numpy objects at once.
SLICE_BYTES = 4 << 20
KEPT = "__kept__"

_UPPER, _LOWER = bytes(range(65, 91)), bytes(range(97, 123))
#: A-Z lower-cased, everything else as it is.
LOWER_ASCII = bytes.maketrans(_UPPER, _LOWER)
_OTHER = bytes(b for b in range(128) if not (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122))
#: A-Z lower-cased, every other ASCII character but 0-9 and a-z made a space; lengths stay.
WORDS_ONLY = bytes.maketrans(_OTHER + _UPPER, b" " * len(_OTHER) + _LOWER)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` uses it."""
    return F.transform(F.array(value), body)[0]


def remainder(id_column: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo; NULL for a NULL id."""
    return F.crc32(id_column.cast("string").cast("binary")) % modulus


def with_columns(df: DataFrame, **columns: Column) -> DataFrame:
    """Like ``withColumns``; columns of ``df`` with such a name are replaced."""
    return df.withColumns(columns)


def pieces(batch: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    """The batch cut so that a piece has about ``SLICE_BYTES`` of text, and one row at least."""
    lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    block = np.cumsum(lengths, dtype=np.int64) // SLICE_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), batch.num_rows]
    for start, end in zip(cuts, cuts[1:]):
        if end > start:
            yield batch.slice(start, end - start)


def map_texts(
    docs: DataFrame,
    begin: Callable[[], Callable[[list], dict]],
    added: str,
    keep: Sequence[str] | None = None,
    text: str = "text",
    as_bytes: bool = False,
) -> DataFrame:
    """Columns computed from each row's whole text, in Arrow batches; no shuffle.

    ``begin`` runs once in each task and returns the function that takes a list of texts (str,
    or UTF-8 bytes; None for NULL) and returns the arrays of the columns ``added``, and under
    ``KEPT`` optionally which rows stay. ``keep`` names the columns of ``docs`` that stay (all of
    them by default); those named like an added column give way to it.
    """
    fields = T._parse_datatype_string(added).fields
    names = [f.name for f in fields]
    kept = [c for c in (docs.columns if keep is None else keep) if c not in names]
    source = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`").cast("string").alias("__text__"))
    schema = T.StructType([docs.schema[c] for c in kept] + fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = begin()
        for batch in batches:
            for piece in pieces(batch, "__text__"):
                texts = piece.column("__text__")
                if as_bytes:
                    texts = texts.cast(pa.large_binary() if pa.types.is_large_string(texts.type) else pa.binary())
                new = compute(texts.to_pylist())
                arrays = [piece.column(i) for i in range(len(kept))] + [new[n] for n in names]
                out = pa.RecordBatch.from_arrays(arrays, names=kept + names)
                yield out.filter(pa.array(new[KEPT])) if KEPT in new else out

    return source.mapInArrow(run, schema)


def default_parallelism(spark: SparkSession) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def tokenizer_path(name: str) -> str:
    """Where the named vocabulary file of the installed public tokenizers lies."""
    import public_tokenizers

    return os.fspath(public_tokenizers.path(name))
