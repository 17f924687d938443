"""Gold tables kept up to date from the partial aggregates of each batch.

``update`` aggregates the silver rows of one batch and appends the partial aggregates, a row per key
and day, as a run (``sources.runs``); a batch counts once, also when it is replayed. ``refresh`` merges
the partial aggregates of the days that batches have touched since the last refresh and replaces those
days in the gold tables. Silver is read once, as it arrives: a refresh reads partial aggregates only,
and of these the row groups of its days, since runs are sorted by date.

A refresh that is interrupted leaves its days due, and the next one replaces them again.
"""

from __future__ import annotations

import time
from collections.abc import Iterable
from dataclasses import replace
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tailwake import constants as K
from tailwake.plans import gold
from tailwake.sources import files, lake
from tailwake.sources.runs import Pointer, RunStore

DAYS = "days"
#: Runs are merged by level only: no period of batches ever passes.
FOREVER = 1 << 60
UNDATED = "undated"


class IncrementalGold:
    """Gold tables below ``base``, with their partial aggregates in ``base``/partials. ``step`` is the
    ``foreachBatch`` function: it refreshes every ``refresh_s`` seconds."""

    def __init__(
        self,
        base: str,
        names: Iterable[str] = gold.TABLES,
        refresh_s: int = K.GOLD_REFRESH_S,
        clock=lambda: int(time.time()),
    ):
        self.base, self.names, self.refresh_s, self.clock = base, tuple(names), refresh_s, clock
        self.store = RunStore(f"{base}/partials")

    # -- batches --

    def update(self, silver: DataFrame, batch_id: int) -> Pointer:
        """Append the partial aggregates of a batch of silver rows."""
        spark = silver.sparkSession
        start, pointer = self.store.start(spark, batch_id, self.clock)
        place = pointer.place
        rows, runs, touched = gold.dated(silver).persist(), {}, set()
        try:
            for name in self.names:
                table = gold.definition(name)
                partial = table.partial(rows).sortWithinPartitions("report_date")
                run = self.store.write(partial, name, place, place)
                touched |= self._days(self.store.read(spark, name, [run]))
                runs[name] = self.store.merged(
                    spark,
                    name,
                    [*(start.runs[name] if start else []), run],
                    lambda merging, table=table: table.merge(merging).sortWithinPartitions("report_date"),
                    FOREVER,
                    place,
                )
        finally:
            rows.unpersist()
        refreshed = self.refreshed(spark)
        due = {day: at for day, at in (start.notes[DAYS] if start else {}).items() if at > refreshed}
        due |= {day: place for day in sorted(touched)}
        pointer = replace(pointer, runs=runs, notes={DAYS: due})
        self.store.publish(spark, pointer)
        return pointer

    @staticmethod
    def _days(partials: DataFrame) -> set[str]:
        """Days of a batch: at most 130 years of them (``timing.utc_date``)."""
        days = partials.select(F.coalesce(F.col("report_date").cast("string"), F.lit(UNDATED))).distinct()
        return {row[0] for row in days.collect()}

    def step(self, silver: DataFrame, batch_id: int) -> None:
        spark = silver.sparkSession
        pointer = self.update(silver, batch_id)
        if pointer.clock >= self._refreshed_at(spark) + self.refresh_s:
            self.refresh(spark)

    # -- refresh --

    def refreshed(self, spark: SparkSession) -> int:
        """Place of the newest batch that the gold tables hold, -1 before the first refresh."""
        return max(map(int, files.names(spark, f"{self.base}/refreshed")), default=-1)

    def _refreshed_at(self, spark: SparkSession) -> int:
        place = self.refreshed(spark)
        return 0 if place < 0 else int(files.read_text(spark, f"{self.base}/refreshed/{place:020d}"))

    def due(self, spark: SparkSession) -> list[str]:
        """Days touched by batches that the gold tables do not hold yet."""
        newest, refreshed = self.store.newest(spark), self.refreshed(spark)
        return [] if newest is None else [day for day, at in newest.notes[DAYS].items() if at > refreshed]

    def merged(self, spark: SparkSession, name: str, days: Iterable[str] | None = None) -> DataFrame:
        """A gold table from the partial aggregates, of some days or of all."""
        table, newest = gold.definition(name), self.store.newest(spark)
        rows = self.store.read(spark, name, newest.runs[name])
        if days is not None:
            rows = rows.filter(self._of(days))
        return table.finish(table.merge(rows))

    @staticmethod
    def _of(days: Iterable[str]) -> Column:
        dates = [date.fromisoformat(day) for day in days if day != UNDATED]
        chosen = F.col("report_date").isin(*dates) if dates else F.lit(False)
        return chosen | F.col("report_date").isNull() if UNDATED in days else chosen

    def refresh(self, spark: SparkSession) -> dict[str, int]:
        """Replace the days that are due; the rows written by table."""
        newest, days = self.store.newest(spark), self.due(spark)
        if not days:
            return dict.fromkeys(self.names, 0)
        written = {
            name: lake.replace_table(
                self.merged(spark, name, days), f"{self.base}/{name}", "report_date", only_present=True
            )
            for name in self.names
        }
        files.write_text(spark, f"{self.base}/refreshed/{newest.place:020d}", str(newest.clock))
        for old in files.names(spark, f"{self.base}/refreshed"):
            if int(old) < newest.place:
                files.remove(spark, f"{self.base}/refreshed/{old}")
        return written
