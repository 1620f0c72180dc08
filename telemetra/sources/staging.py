"""Tables written to the cluster's shared folder to fix an intermediate result.

A written table survives lost executors and never changes when a stage is run
again, which row positions and partition numbers need.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, functions as F

_CHECKPOINT_SETTING = "spark.checkpoint.dir"
_local_folders: dict[str, str] = {}
_passing: ContextVar[list[str] | None] = ContextVar("passing", default=None)


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a folder of our own only in local mode, where all tasks see it."""
    folder = spark.conf.get(_CHECKPOINT_SETTING, None) or spark.sparkContext.getConf().get(_CHECKPOINT_SETTING)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {_CHECKPOINT_SETTING} to a folder that every executor can reach")
    application = spark.sparkContext.applicationId
    if application not in _local_folders:
        _local_folders[application] = tempfile.mkdtemp(prefix="telemetra-")
    return _local_folders[application]


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid4().hex}"


@contextmanager
def passing_tables(spark: SparkSession) -> Iterator[None]:
    """Delete the tables staged inside the block at its end: for blocks that write their results out."""
    folders: list[str] = []
    token = _passing.set(folders)
    try:
        yield
    finally:
        _passing.reset(token)
        for folder in folders:
            path = hadoop_path(spark, folder)
            file_system(spark, path).delete(path, True)


def hadoop_path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def file_system(spark: SparkSession, path):
    return path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def _table_folder(spark: SparkSession, name: str, keep: bool) -> str:
    folder = new_folder(spark, name)
    folders = _passing.get()
    if folders is not None and not keep:
        folders.append(folder)
    return folder


def stage(df: DataFrame, keep: bool = False) -> DataFrame:
    """Write once, read many times. ``keep`` exempts the table from :func:`passing_tables`."""
    path = _table_folder(df.sparkSession, "table", keep)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_in_order(df: DataFrame, order: Sequence[str], keep: bool = False) -> DataFrame:
    """Globally sorted copy with ``_part`` (sort partition) and ``_row`` (position inside it, from 0)."""
    path = _table_folder(df.sparkSession, "sorted", keep)
    part = F.spark_partition_id()
    (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select(
            "*",
            part.alias("_part"),
            (F.monotonically_increasing_id() - F.shiftleft(part.cast("long"), 33)).alias("_row"),
        )
        .write.parquet(path)
    )
    return df.sparkSession.read.parquet(path)
