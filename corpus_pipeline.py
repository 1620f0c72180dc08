"""A corpus from raw documents to a mixture of sources, in five stages.

Each stage takes all rows its predecessor kept and returns those that it keeps, with the columns
of ``documents``; the last returns how many words the mixture takes of each document. Stages handle NULLs,
empty texts, repeated rows and empty tables as their operators say; a classifier that has nothing to
learn from rejects nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from telemetra.llm import decontaminate, langid, mixing, quality, simhash
from telemetra.llm.common import table
from telemetra.llm.queries import held_out
from telemetra.sources.staging import file_system, hadoop_path, new_folder, passing_tables

#: A language identified less surely than this is rejected, as are texts without letters.
LEAST_SURE = 0.5


def passing(docs: DataFrame, stage: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The rows that ``stage`` keeps, with all columns as they came.

    Other columns than id and text have names of their own meanwhile, which no operator adds or replaces.
    """
    names = {c: c if c in ("doc_id", "text") else f"__column_{i}__" for i, c in enumerate(docs.columns)}
    kept = stage(docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()]))
    return kept.select(*[F.col(n).alias(c) for c, n in names.items()])


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified."""
    model = langid.train(docs.filter(~held_out(4, 2)))
    if not model.languages:
        return docs
    return passing(docs, lambda some: langid.predict(some, model, least_score=LEAST_SURE))


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    trees = quality.train(docs, table(spark, sf_dir, "labels").filter(~held_out(4, 2)))
    if not len(trees.leaf):
        return docs
    return passing(docs, lambda some: quality.score(some, trees).filter("predicted = 1"))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return passing(docs, simhash.keep_first)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    return passing(docs, lambda some: decontaminate.find_leaks(some, table(spark, sf_dir, "benchmark")).filter("n_hit = 0"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words taken from each document for the target weights of the sources."""
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


STAGES = [
    ("language ID", language),
    ("quality classifier", good),
    ("SimHash near-dedup", distinct),
    ("benchmark decontamination", clean),
    ("mixing sources to target weights", mixture),
]

#: Language, quality and fingerprints have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. A stage's working tables and its input go when its result is written."""
    docs, before = table(spark, sf_dir, "documents"), None
    for _, function in STAGES[:-1]:
        path = new_folder(spark, "stage")
        with passing_tables(spark):
            function(spark, docs, sf_dir).write.parquet(path)
        if before is not None:
            file_system(spark, hadoop_path(spark, before)).delete(hadoop_path(spark, before), True)
        docs, before = spark.read.schema(docs.schema).parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)
