"""The log of a store: which files count, what lies in them, and their partial aggregates.

Each finished batch and each merge of batches has an entry, a small table with a row for every file, building, room and
sensor type in it: rows, time bounds, and partial aggregates of the values. An entry is put in place by one rename, after its
sketches, a quantile sketch for each sensor type and day. Readers plan from the entries which files to open; reports add up the
partial aggregates of whole days, and exact quantiles begin from the sketches.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from telemetra.functions.columns import STORED_DAYS, STORED_SENSOR, number
from telemetra.operators.quantiles import SKETCH_SIZE
from telemetra.sources.staging import file_system, hadoop_path

LOG, SKETCHES = "_commits", "_sketches"
_BATCH, _MERGED = re.compile(r"batch-(\d+)"), re.compile(r"merged-(\d+)-(\d+)")
#: What a reading is counted by.
KEYS = ("building_id", "room_id", "sensor_type")


def partial_aggregates(value: str = "value") -> list[Column]:
    """Columns that :func:`telemetra.operators.rollups` puts together again."""
    numbers = number(value)
    decimal = numbers.try_cast("decimal(18,4)")
    return [
        F.count("*").alias("rows"),
        F.count(numbers).alias("numbers"),
        F.count(decimal).alias("fitting"),
        F.sum(decimal).alias("exact_total"),
        F.sum(numbers).alias("total"),
        F.max(numbers).alias("high"),
        F.min(numbers).alias("low"),
    ]


class CommitLog:
    """Entries of the store at ``path``; there is none of stores that were written without."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _root(self, name: str = ""):
        return hadoop_path(self.spark, f"{self.path}/{LOG}/{name}".rstrip("/"))

    def exists(self) -> bool:
        return file_system(self.spark, self._root()).exists(self._root())

    def names(self) -> list[str]:
        root = self._root()
        files = file_system(self.spark, root)
        return sorted(status.getPath().getName() for status in files.listStatus(root)) if files.exists(root) else []

    def merged(self) -> dict[tuple[int, int], str]:
        """First and last batch of each merge, and its folder."""
        ranges = [tuple(map(int, found.groups())) for n in self.names() if (found := _MERGED.fullmatch(n))]
        return {r: f"_merged-{r[0]}-{r[1]}" for r in sorted(ranges)}

    def batches(self) -> list[int]:
        """Numbers of the batches that no merge has taken in."""
        last = max((r[1] for r in self.merged()), default=-1)
        return sorted(int(found[1]) for n in self.names() if (found := _BATCH.fullmatch(n)) and int(found[1]) > last)

    def live(self) -> list[str]:
        """Names of the entries that count."""
        return [f"merged-{a}-{b}" for a, b in self.merged()] + [f"batch-{b}" for b in self.batches()]

    def outdated(self) -> list[str]:
        return [n for n in self.names() if n not in set(self.live())]

    def drop(self, name: str) -> None:
        """Take out an entry, then its sketches."""
        for top in (LOG, SKETCHES):
            place = hadoop_path(self.spark, f"{self.path}/{top}/{name}")
            file_system(self.spark, place).delete(place, True)

    def add(self, name: str, folder: str) -> None:
        """Enter the files of ``folder`` below the store; replaces the entry of that name."""
        stored = self.spark.read.parquet(f"{self.path}/{folder}")
        if "value" not in stored.columns:
            stored = stored.withColumn("value", F.lit(None).cast("double"))
        times = [time for time, day in STORED_DAYS.items() if day in stored.columns]
        days = [F.col(STORED_DAYS[time]).cast("date").alias(STORED_DAYS[time]) for time in times]
        keys = [c for c in KEYS if c in stored.columns]
        # the metadata's path is a URI: a percent sign of a directory's name is written as %25 there
        inside = F.url_decode(F.replace(F.substring_index("_metadata.file_path", f"/{folder}/", -1), F.lit("+"), F.lit("%2B")))
        bounds = [f(time).alias(f"{which}_{time}") for time in times for which, f in (("first", F.min), ("last", F.max))]
        by = [F.concat(F.lit(f"{folder}/"), inside).alias("path"), F.col(STORED_SENSOR).cast("string").alias(STORED_SENSOR), *days, *keys]
        self.drop(name)
        numbers = number("value")
        sketch = F.kll_sketch_agg_double(numbers, SKETCH_SIZE).alias("sketch")
        per_day = stored.where(numbers.isNotNull()).groupBy("sensor_type", *days[:1]).agg(F.count("*").alias("numbers"), sketch)
        self._place(per_day, SKETCHES, name)
        self._place(stored.groupBy(*by).agg(*partial_aggregates(), *bounds), LOG, name)

    def _place(self, table: DataFrame, top: str, name: str) -> None:
        """Write a table under another name and put it in place at once; what is there of an earlier attempt goes."""
        draft, place = (hadoop_path(self.spark, f"{self.path}/{top}/{n}") for n in (f".draft-{uuid4().hex}", name))
        # one file by a shuffle: coalesce(1) would have one task aggregate all partitions in turn, each with buffers of its own,
        # as many as spark.sql.shuffle.partitions where a stateful stream has switched adaptive execution off
        table.repartition(1).write.parquet(draft.toString())
        files = file_system(self.spark, place)
        files.delete(place, True)
        if not files.rename(draft, place):
            raise OSError(f"{place} was not written")

    def entries(self) -> DataFrame | None:
        """All rows of the entries that count; None if there are none."""
        live = self.live()
        if not live:
            return None
        # as Spark passes over names that begin with an underscore, entries are named one by one
        return self.spark.read.parquet(*[f"{self.path}/{LOG}/{name}" for name in live])

    def sketches(self) -> DataFrame | None:
        """For each sensor type and day of the entries that count: how many numbers, and their KLL sketch."""
        live = self.live()
        return self.spark.read.parquet(*[f"{self.path}/{SKETCHES}/{name}" for name in live]) if live else None

    def files(self, wanted: Column | None = None) -> list[str]:
        """Paths, below the store, of the files with a row in the log for which ``wanted`` holds."""
        entries = self.entries()
        if entries is None:
            return []
        some = entries if wanted is None else entries.where(wanted)
        return sorted(row[0] for row in some.select("path").distinct().collect())

    def read(self, files: Sequence[str]) -> list[DataFrame]:
        """The files as tables, those of each merge and those of all batches for themselves."""
        groups: dict[str, list[str]] = {}
        for name in files:
            top = name.split("/")[0]
            groups.setdefault(f"{self.path}/{top}" if top.startswith("_merged") else self.path, []).append(f"{self.path}/{name}")
        tables = []
        for base, paths in sorted(groups.items()):
            table = self.spark.read.option("basePath", base).parquet(*paths)
            days = {day: F.col(day).cast("date") for day in STORED_DAYS.values() if day in table.columns}
            tables.append(table.withColumns(days) if days else table)
        return tables
