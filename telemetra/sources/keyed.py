"""Keyed tables in hash partitions, of which a micro-batch rewrites only those that hold its keys."""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence
from typing import NamedTuple
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from telemetra.sources.staging import file_system, hadoop_path

PARTITIONS = 64
_PARTITION = "_partition"


class Manifest(NamedTuple):
    """Which folder holds each partition after a batch: a line of JSON, put in place by one rename."""

    folders: dict[int, str]
    schema: StructType
    partitions: int
    keys: list[str]


class KeyedTable:
    """A table by key that costs a batch the partitions it changes, not the table.

    Rows lie in ``partitions`` hash partitions of their ``keys``; NULL keys have theirs. A batch writes the
    partitions it changes into a folder of its own and then a manifest, which names the folder of every partition:
    it counts from then on, so a writer that dies changes nothing. A batch builds on the newest manifest before its
    own number, and running it again gives the same table. The manifest before it, and what that
    names, stay for readers that began earlier and for the repeated batch; what no manifest names any more is deleted.
    ``keys`` and ``partitions`` of an existing table are those it was begun with.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str] = (), partitions: int = PARTITIONS):
        self.spark, self.path = spark, path.rstrip("/")
        self.keys, self.partitions = list(keys), partitions

    def read(self, before: int | None = None, only: Iterable[int] | None = None) -> DataFrame | None:
        """The newest version (older than batch ``before``), or of it the partitions ``only``; None if there is none."""
        manifest = self._newest(before)
        if manifest is None:
            return None
        wanted = manifest.folders if only is None else manifest.folders.keys() & set(only)
        folders = [f"{self.path}/{manifest.folders[p]}/{_PARTITION}={p}" for p in sorted(wanted)]
        if not folders:
            return self.spark.createDataFrame([], manifest.schema)
        return self.spark.read.schema(manifest.schema).parquet(*folders)

    def touched(self, df: DataFrame, before: int | None = None) -> list[int]:
        """The partitions that the keys of ``df`` belong to; at most as many numbers as there are partitions."""
        manifest = self._newest(before)
        place = self._place(manifest)
        return sorted(row[0] for row in df.select(place.alias("p")).distinct().collect())

    def write(self, df: DataFrame, batch_id: int, touched: Iterable[int] | None = None) -> None:
        """Put ``df`` in the place of the partitions ``touched``, which must hold all its keys; of the whole table if None."""
        before = self._newest(batch_id)
        folder = f"data/{batch_id}-{uuid4().hex}"
        df.withColumn(_PARTITION, self._place(before)).hint("rebalance", _PARTITION).write.partitionBy(_PARTITION).parquet(f"{self.path}/{folder}")
        written = {int(name.removeprefix(f"{_PARTITION}=")) for name in self._names(folder) if name.startswith(_PARTITION)}
        kept = {} if before is None or touched is None else {p: f for p, f in before.folders.items() if p not in set(touched)}
        if written & kept.keys():
            raise ValueError("rows of partitions that are not replaced")
        keys, partitions = (self.keys, self.partitions) if before is None else (before.keys, before.partitions)
        replaced = self._manifest(batch_id)
        self._commit(batch_id, Manifest({**kept, **{p: folder for p in written}}, df.schema, partitions, keys))
        self._clean(batch_id, [replaced] if replaced else [])

    def _place(self, manifest: Manifest | None) -> Column:
        keys, partitions = (self.keys, self.partitions) if manifest is None else (manifest.keys, manifest.partitions)
        return F.pmod(F.xxhash64(*keys), F.lit(partitions)).cast("int") if keys else F.lit(0)

    def _names(self, folder: str) -> list[str]:
        root = hadoop_path(self.spark, f"{self.path}/{folder}")
        files = file_system(self.spark, root)
        return [status.getPath().getName() for status in files.listStatus(root)] if files.exists(root) else []

    def _numbers(self) -> list[int]:
        return sorted(int(name) for name in self._names("manifests") if name.isdigit())

    def _newest(self, before: int | None) -> Manifest | None:
        numbers = [n for n in self._numbers() if before is None or n < before]
        return self._manifest(numbers[-1]) if numbers else None

    def _manifest(self, number: int) -> Manifest | None:
        file = hadoop_path(self.spark, f"{self.path}/manifests/{number}")
        files = file_system(self.spark, file)
        if not files.exists(file):
            return None
        stream = files.open(file)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        found = json.loads(text)
        return Manifest({int(p): f for p, f in found["folders"].items()}, StructType.fromJson(found["schema"]), found["partitions"], found["keys"])

    def _commit(self, number: int, manifest: Manifest) -> None:
        text = json.dumps({**manifest._asdict(), "schema": json.loads(manifest.schema.json())})
        file, draft = (hadoop_path(self.spark, f"{self.path}/manifests/{name}") for name in (number, f"{number}.draft"))
        files = file_system(self.spark, file)
        stream = files.create(draft, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        files.delete(file, False)  # of a batch run again
        if not files.rename(draft, file):
            raise OSError(f"{file} was not written")

    def _clean(self, number: int, replaced: list[Manifest]) -> None:
        """Drop manifests older than the one before ``number``, and the partitions that only those and ``replaced`` name."""
        numbers = self._numbers()
        kept = [n for n in numbers if n >= number] + [n for n in numbers if n < number][-1:]
        named = {(p, f) for n in kept for p, f in self._manifest(n).folders.items()}
        old = [n for n in numbers if n not in kept]
        dropped = [*replaced, *[self._manifest(n) for n in old]]
        for p, folder in {(p, f) for m in dropped for p, f in m.folders.items()} - named:
            self._delete(f"{folder}/{_PARTITION}={p}")
        for n in old:
            self._delete(f"manifests/{n}")

    def _delete(self, name: str) -> None:
        path = hadoop_path(self.spark, f"{self.path}/{name}")
        file_system(self.spark, path).delete(path, True)
