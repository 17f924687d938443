"""Keyed tables kept up to date by micro-batches: live state, rotations, alerts, statistics.

Each batch folds its rows to one per key and appends them as a run (``sources.runs``); readers fold the
runs again, newest record per key. So a batch writes what it brought, whatever the tables hold: the
rotations of 24 hours are not read or written when ten seconds of reports arrive. Runs are merged
within their hour and once when the hour has passed; expired ones are dropped whole.

A row expires ``ttl_s`` after it was seen, by the clock of its batch. A late report does not displace a
newer one, but outlives it if it was seen later; merging keeps such rows, so what readers see does not
depend on when runs are merged.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tailwake import constants as K
from tailwake.operators.alerts import scan_alerts
from tailwake.operators.latest import latest_per_key
from tailwake.operators.rotation import rotation_index
from tailwake.operators.summaries import batch_stats
from tailwake.plans.live import live_columns
from tailwake.sources.runs import Pointer, Run, RunStore

BATCH, SEEN, PLACE = "batch_id", "seen_at", "place"
STATS_BATCHES = 1000
HOUR_S = 3600


@dataclass(frozen=True)
class KeyedTable:
    """Rows by key, the newest by ``order``. A row's mark is in column ``seen_at``; ``ttl`` counts in
    marks from there, ``None`` keeps all. ``period`` is how many marks are merged into one run. With
    ``single`` a batch brings one row per key."""

    name: str
    key: str
    order: Sequence[str]
    ttl: int | None
    period: int = HOUR_S
    single: bool = False

    def fresh(self, rows: DataFrame, mark: int) -> DataFrame:
        """Rows of one batch, folded to one per key, where they are not so already."""
        seen = rows.withColumn(SEEN, F.lit(mark).cast("bigint"))
        return seen if self.single else latest_per_key(seen, self.key, *self.order)

    def expired(self, mark: int, now: int) -> bool:
        return self.ttl is not None and mark <= now - self.ttl

    def alive(self, now: int) -> Column:
        return F.lit(True) if self.ttl is None else F.col(SEEN) > now - self.ttl

    def unexpired(self, rows: DataFrame, now: int) -> DataFrame:
        return rows if self.ttl is None else rows.filter(self.alive(now))

    def lasting(self, rows: DataFrame) -> DataFrame:
        """Rows that are or will be the newest unexpired one of their key: those seen later than every
        newer one. A key has at most one row for each run that is merged."""
        rest = [c for c in rows.columns if c not in (self.key, SEEN, *self.order)]
        order = [F.col(c).desc() for c in (*self.order, SEEN, *rest)]
        newer = Window.partitionBy(self.key).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        seen = F.max(SEEN).over(newer)
        return rows.withColumn("newer", seen).filter(
            F.col("newer").isNull() | (F.col(SEEN) > F.col("newer"))
        ).drop("newer")

    def current(self, rows: DataFrame, now: int) -> DataFrame:
        return latest_per_key(self.unexpired(rows, now), self.key, *self.order, SEEN)


def processing_clock() -> Column:
    return F.unix_seconds(F.current_timestamp())


class LiveTables:
    """The four live tables below one folder; ``update`` is the ``foreachBatch`` function."""

    def __init__(
        self,
        base: str,
        live_ttl_s: int | None = K.LIVE_TTL_S,
        rotation_ttl_s: int | None = K.ROTATION_HORIZON_S,
        alert_ttl_s: int | None = K.ALERT_TTL_S,
        clock=processing_clock,
    ):
        self.base, self.store = base, RunStore(base)
        self.clock = clock
        by_time = ("timestamp", "updated_at")
        self.live = KeyedTable("flights", "flight_id", by_time, live_ttl_s)
        self.alerts = KeyedTable("alerts", "flight_id", by_time, alert_ttl_s)
        self.rotations = KeyedTable("rotations", "stop", ("timestamp",), rotation_ttl_s, single=True)
        # Statistics have a row a batch; their marks are places, and the newest batches stay.
        self.stats = KeyedTable("stats", PLACE, ("updated_at",), STATS_BATCHES, STATS_BATCHES, True)

    # -- writing --

    def update(self, enriched: DataFrame, batch_id: int) -> None:
        spark = enriched.sparkSession
        start, pointer = self.store.start(
            spark, batch_id, lambda: spark.range(1).select(self.clock()).first()[0]
        )
        clock, place = pointer.clock, pointer.place
        batch = live_columns(enriched).persist()
        stats = batch_stats(batch).select(
            "*",
            F.timestamp_seconds(F.lit(clock)).alias("updated_at"),
            F.lit(batch_id).cast("bigint").alias(BATCH),
            F.lit(place).cast("bigint").alias(PLACE),
        )
        rows = {
            self.live: (batch, clock),
            self.alerts: (scan_alerts(batch), clock),
            self.rotations: (
                rotation_index(batch).withColumn("stop", F.struct("registration", "flight_id")),
                clock,
            ),
            self.stats: (stats, place),
        }
        try:
            runs = {
                table.name: self._appended(table, fresh, mark, start)
                for table, (fresh, mark) in rows.items()
            }
            pointer = replace(pointer, runs=runs)
            pointer = replace(pointer, runs=runs | self._derived(batch, start, pointer))
        finally:
            batch.unpersist()
        self._publish(spark, pointer)

    def _derived(self, batch: DataFrame, start: Pointer | None, pointer: Pointer) -> dict[str, list[Run]]:
        """Runs of further tables, from the batch and the states before and after it."""
        return {}

    def _appended(self, table: KeyedTable, rows: DataFrame, mark: int, start: Pointer | None) -> list[Run]:
        spark = rows.sparkSession
        old = [] if start is None else start.runs[table.name]
        alive = [run for run in old if not table.expired(run.high, mark)]
        run = self.store.write(table.fresh(rows, mark), table.name, mark, mark)
        return self.store.merged(
            spark,
            table.name,
            [*alive, run],
            lambda merging: table.lasting(table.unexpired(merging, mark)),
            table.period,
            mark,
        )

    def _publish(self, spark: SparkSession, pointer: Pointer) -> None:
        self.store.publish(spark, pointer)

    # -- reading --

    def _snapshot(self, spark: SparkSession, table: KeyedTable) -> DataFrame | None:
        newest = self.store.newest(spark)
        if newest is None:
            return None
        now = newest.place if table is self.stats else newest.clock
        return table.current(self.store.read(spark, table.name, newest.runs[table.name]), now)

    def flights(self, spark: SparkSession) -> DataFrame | None:
        return self._snapshot(spark, self.live)

    def alert_list(self, spark: SparkSession) -> DataFrame | None:
        return self._snapshot(spark, self.alerts)

    def rotation_list(self, spark: SparkSession) -> DataFrame | None:
        rows = self._snapshot(spark, self.rotations)
        return None if rows is None else rows.drop("stop")

    def stats_history(self, spark: SparkSession) -> DataFrame | None:
        """Statistics of the newest batches, a row each."""
        rows = self._snapshot(spark, self.stats)
        return None if rows is None else rows.drop(PLACE, SEEN)

    def latest_stats(self, spark: SparkSession) -> DataFrame | None:
        """Statistics of the newest batch."""
        newest = self.store.newest(spark)
        if newest is None:
            return None
        runs = [run for run in newest.runs[self.stats.name] if run.high == newest.place]
        rows = self.store.read(spark, self.stats.name, runs)
        return rows.filter(F.col(PLACE) == F.lit(newest.place)).drop(PLACE, SEEN)
