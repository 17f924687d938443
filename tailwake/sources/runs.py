"""Tables kept as runs: immutable folders of rows, named by one small pointer.

A batch writes its rows as a new run and then publishes a pointer that names all runs of all tables,
written under another name and renamed. Readers take the newest pointer, so they see one batch or the
one before, never half of one. What a batch writes follows the batch, not the table: older runs stay as
they are. Runs are merged in two ways, both of which rewrite a row a bounded number of times: ``FAN``
runs of a level and period become one of the next level, and the runs of a period that has passed
become one. A run whose rows have all expired is no longer named and costs nothing to drop.

Pointers are numbered in the order of publication, not by batch, so a query that starts over with a
fresh checkpoint goes on from the newest state. A batch that is replayed after it was published starts
from the pointer it started from the first time, with the same clock, and so counts once. Runs stay for
``KEPT`` further pointers, for slow readers. Whatever no kept pointer names, such as the runs of a batch
that died before it was published, is removed with the next publication.
"""

from __future__ import annotations

import json
import uuid
from collections import defaultdict
from collections.abc import Callable, Iterable
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tailwake.sources import files

KEPT = 5
FAN = 16


@dataclass(frozen=True)
class Run:
    """One folder: its name, how often it was merged, and the smallest and largest mark of its rows. A
    mark is the clock or the number of the batch that wrote them."""

    name: str
    level: int
    low: int
    high: int
    rows: int


@dataclass(frozen=True)
class Pointer:
    place: int
    query: str
    batch: int
    clock: int
    before: int | None  # place of the pointer that the batch started from
    runs: dict[str, list[Run]] = field(default_factory=dict)
    notes: dict = field(default_factory=dict)


class RunStore:
    """Pointers and runs below one folder. One query writes to it."""

    def __init__(self, base: str):
        self.base = base

    # -- pointers --

    def places(self, spark: SparkSession) -> list[int]:
        return sorted(map(int, files.names(spark, f"{self.base}/published")))

    def pointer(self, spark: SparkSession, place: int) -> Pointer:
        stored = json.loads(files.read_text(spark, f"{self.base}/published/{place:020d}"))
        runs = {table: [Run(**run) for run in some] for table, some in stored.pop("runs").items()}
        return Pointer(**stored, runs=runs)

    def newest(self, spark: SparkSession) -> Pointer | None:
        """The newest pointer, ``None`` before the first batch."""
        places = self.places(spark)
        return self.pointer(spark, places[-1]) if places else None

    def start(self, spark: SparkSession, batch: int, clock: Callable[[], int]) -> tuple[Pointer | None, Pointer]:
        """What a batch starts from, and its own pointer with no runs yet."""
        query = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or ""
        newest = self.newest(spark)
        place = 0 if newest is None else newest.place + 1
        if newest is not None and (newest.query, newest.batch) == (query, batch):
            before, now = newest.before, newest.clock
        else:
            before, now = None if newest is None else newest.place, clock()
        from_ = None if before is None else self.pointer(spark, before)
        return from_, Pointer(place, query, batch, int(now), before)

    def publish(self, spark: SparkSession, pointer: Pointer) -> None:
        path = f"{self.base}/published/{pointer.place:020d}"
        files.write_text(spark, path, json.dumps(asdict(pointer)))
        kept = []
        for place in self.places(spark):
            if place >= pointer.place - KEPT or place == pointer.before:
                kept.append(self.pointer(spark, place))
            else:
                files.remove(spark, f"{self.base}/published/{place:020d}")
        named = {(table, run.name) for old in kept for table, some in old.runs.items() for run in some}
        for table in pointer.runs:
            for name in files.names(spark, f"{self.base}/runs/{table}"):
                if (table, name) not in named:
                    files.remove(spark, f"{self.base}/runs/{table}/{name}")

    # -- runs --

    def path(self, table: str, run: Run) -> str:
        return f"{self.base}/runs/{table}/{run.name}"

    def read(self, spark: SparkSession, table: str, runs: Iterable[Run]) -> DataFrame:
        """The rows of some runs, at least one, as they were written."""
        return spark.read.parquet(*[self.path(table, run) for run in runs])

    def write(
        self, rows: DataFrame, table: str, low: int, high: int, level: int = 0, partition_by: str | None = None
    ) -> Run:
        name, counted = uuid.uuid4().hex, Observation()
        writer = rows.observe(counted, F.count(F.lit(1)).alias("rows")).write
        if partition_by:
            writer = writer.partitionBy(partition_by)
        writer.parquet(f"{self.base}/runs/{table}/{name}")
        return Run(name, level, low, high, counted.get["rows"])

    def merged(
        self,
        spark: SparkSession,
        table: str,
        runs: list[Run],
        merge: Callable[[DataFrame], DataFrame],
        period: int,
        now: int,
        partition_by: str | None = None,
    ) -> list[Run]:
        """``runs`` with those merged that are due; ``merge`` folds rows without changing what readers
        see. Runs without rows go, unless there are no others."""
        filled = [run for run in runs if run.rows] or runs[-1:]
        groups = defaultdict(list)
        for run in filled:
            passed = run.high // period < now // period
            groups[run.high // period, None if passed else run.level].append(run)
        out = []
        for (_, level), some in groups.items():
            if len(some) < (2 if level is None else FAN):
                out += some
                continue
            rows = merge(self.read(spark, table, some))
            low, high = min(r.low for r in some), max(r.high for r in some)
            top = max(r.level for r in some) + 1
            out.append(self.write(rows, table, low, high, top, partition_by))
        return sorted(out, key=lambda run: (run.high, run.low))
