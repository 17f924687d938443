"""Compaction of closed partitions of an append-only table, beside it.

A stream that appends every ten seconds leaves thousands of small files a day. Once a day has closed its
files are packed into few of ``target_bytes`` each: the scan packs them, largest first, into partitions of
that size, and each partition is written as it is, so nothing is shuffled. The result is published by one
pointer (``sources.runs``); the table itself is not touched, so its own readers, streams among them, and the
log of the sink that writes it are unharmed. ``read`` takes closed days from the packed files and all else
from the table.

A file that reaches a day after it was packed is noticed by name: each pointer holds the number of the files
that were packed and a check sum of their names, and where the table's own list differs, the names. Such
files are read as they are until the day is packed again. Compaction that dies before publication leaves
folders that no pointer names; the next publication removes them. Removing the small files is left to the
table's retention.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterable
from dataclasses import replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tailwake.sources import files
from tailwake.sources.runs import RunStore

TARGET_BYTES = 128 << 20
NO_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def names_of(paths: Iterable[str]) -> set[str]:
    """File names; a sink gives every file a name of its own."""
    return {path.rpartition("/")[2] for path in paths}


def check_sum(names: Iterable[str]) -> int:
    return sum(map(zlib.crc32, (name.encode() for name in names)))


class CompactedTable:
    """The table at ``raw``, partitioned by the date column ``partition``, and its packed days below
    ``base``. One job at a time compacts."""

    def __init__(self, raw: str, base: str, partition: str, target_bytes: int = TARGET_BYTES):
        self.raw, self.partition, self.target_bytes = raw, partition, target_bytes
        self.store = RunStore(base)

    def _files(self, table: DataFrame) -> dict[str, list[str]]:
        """Files of the table by day, as Spark lists them on the driver for every read."""
        found, mark = defaultdict(list), f"/{self.partition}="
        for path in table.inputFiles():
            day = path.rpartition(mark)[2].partition("/")[0]
            if day != NO_PARTITION:
                found[day].append(path)
        return found

    def _late(self, spark: SparkSession, packed: dict, listed: dict[str, list[str]]) -> dict[str, list[str]]:
        """Files that came to a day after it was packed."""
        late = {}
        for day, note in packed.items():
            paths = listed.get(day, [])
            names = names_of(paths)
            if (len(names), check_sum(names)) != (note["files"], note["sum"]):
                known = set(files.read_text(spark, note["names"]).split("\n"))
                late[day] = [path for path in paths if path.rpartition("/")[2] not in known]
        return {day: paths for day, paths in late.items() if paths}

    # -- packing --

    def compact(self, spark: SparkSession, closed_before: date) -> list[str]:
        """Pack the days before ``closed_before`` that have more than one file and are not packed yet, or
        have late files. The days that were packed."""
        table = spark.read.parquet(self.raw)
        listed = self._files(table)
        batch = max(self.store.places(spark), default=-1) + 1  # never that of an earlier compaction
        start, pointer = self.store.start(spark, batch, lambda: 0)
        runs, notes = (dict(start.runs), dict(start.notes)) if start else ({}, {})
        late = self._late(spark, notes, listed)
        due = [
            day for day, paths in sorted(listed.items())
            if day < closed_before.isoformat() and (day in late or (day not in notes and len(paths) > 1))
        ]
        for day in due:
            packed = self._packing(spark).read.schema(self._stored(table)).parquet(*listed[day])
            dated = packed.withColumn(self.partition, F.lit(date.fromisoformat(day)))
            run = self.store.write(dated, day, pointer.place, pointer.place)
            names = sorted(names_of(listed[day]))
            path = f"{self.store.base}/sources/{run.name}"
            files.write_text(spark, path, "\n".join(names))
            runs[day] = [run]
            notes[day] = {"files": len(names), "sum": check_sum(names), "names": path}
        if due:
            self._publish(spark, replace(pointer, runs=runs, notes=notes))
        return due

    def _publish(self, spark: SparkSession, pointer) -> None:
        self.store.publish(spark, pointer)
        kept = [self.store.pointer(spark, place) for place in self.store.places(spark)]
        named = {run.name for old in kept for some in old.runs.values() for run in some}
        for name in files.names(spark, f"{self.store.base}/sources"):
            if name not in named:
                files.remove(spark, f"{self.store.base}/sources/{name}")

    def _packing(self, spark: SparkSession) -> SparkSession:
        """A session whose scans fill partitions of ``target_bytes``, however few these are."""
        session = spark.newSession()
        session.conf.set("spark.sql.files.maxPartitionBytes", str(self.target_bytes))
        session.conf.set("spark.sql.files.openCostInBytes", "0")
        session.conf.set("spark.sql.files.minPartitionNum", "1")
        return session

    def _stored(self, table: DataFrame):
        return table.drop(self.partition).schema

    # -- reading --

    def read(self, spark: SparkSession) -> DataFrame:
        """All rows: packed days from their packed files, all else from the table."""
        table, newest = spark.read.parquet(self.raw), self.store.newest(spark)
        if newest is None:
            return table
        days = [date.fromisoformat(day) for day in newest.notes]
        open_days = table.filter(F.col(self.partition).isNull() | ~F.col(self.partition).isin(*days))
        paths = [self.store.path(day, run) for day, some in newest.runs.items() for run in some]
        whole = open_days.unionByName(spark.read.schema(table.schema).parquet(*paths))
        for day, late in self._late(spark, newest.notes, self._files(table)).items():
            rows = spark.read.schema(self._stored(table)).parquet(*late)
            whole = whole.unionByName(rows.withColumn(self.partition, F.lit(date.fromisoformat(day))))
        return whole
