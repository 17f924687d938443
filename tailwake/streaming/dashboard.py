"""The dashboard's figures, kept by deltas beside the live tables.

Fleet impact, airline performance and totals are sums over the live flights. A batch changes some of
them: those it reports, those that expired, and, since a ripple score depends on the other flights of
the aircraft, all live flights of the same registrations. What these flights added to the sums before
the batch is taken out and what they add now is put in, as one signed row per airline, appended as a
run. So scores are worked out, shuffled by aircraft and summed for changed aircraft only, and a part
of the dashboard is the sum of a few hundred small rows per airline instead of the scored fleet.

Sums are decimals, so taking out is exact and nothing drifts. State before and after the batch comes
from the live tables' own runs; both belong to one pointer, so all parts show the same batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tailwake import constants as K
from tailwake.functions import bands, flight
from tailwake.operators import airlines as A
from tailwake.operators.alerts import list_alerts
from tailwake.operators.rotation import RIPPLE_INPUTS
from tailwake.plans import live
from tailwake.sources import files
from tailwake.sources.runs import Pointer, Run
from tailwake.streaming.live_tables import SEEN, LiveTables

PARTS, CHANGES = "parts", "changes"
SIDES = {"before": -1, "after": 1}
EXACT = "decimal(28,10)"
LONG_SUM = "decimal(38,10)"
COLUMNS = tuple(
    dict.fromkeys(["flight_id", "timestamp", "updated_at", SEEN, *RIPPLE_INPUTS, *A.PERFORMANCE_INPUTS])
)
FOREVER = 1 << 60


def contributions(flights: DataFrame) -> DataFrame:
    """What each scored flight adds to the sums of its airline."""
    category, delayed = F.col("delay_category"), flight.is_delayed_served(F.col("delay_category"))

    def flag(condition: Column) -> Column:
        return F.coalesce(condition.cast("bigint"), F.lit(0).cast("bigint"))

    def whole(name: str, counts: Column | None = None) -> Column:
        value = F.coalesce(F.col(name).cast("bigint"), F.lit(0).cast("bigint"))
        return value if counts is None else F.when(counts, value).otherwise(F.lit(0).cast("bigint"))

    def exact(name: str, counts: Column | None = None) -> Column:
        value = F.coalesce(F.col(name), F.lit(0)).cast("double").cast(EXACT)
        return value if counts is None else F.when(counts, value).otherwise(F.lit(0).cast(EXACT))

    return flights.select(
        F.coalesce("airline", F.lit("")).alias("airline_icao"),
        F.lit(1).cast("bigint").alias("flights"),
        flag(category == K.ON_TIME).alias("on_time"),
        flag(category == K.CRITICAL_DELAY).alias("critical"),
        flag((category == K.CRITICAL_DELAY) & (F.col("flight_id") != "")).alias("alerts"),
        flag(F.col("fdi_category").isin(*K.ELEVATED)).alias("high_fdi"),
        flag(F.col("res_category").isin(*K.ELEVATED)).alias("high_res"),
        whole("affected_passengers").alias("passengers"),
        whole("estimated_compensation_eur").alias("compensation"),
        whole("affected_passengers", delayed).alias("delayed_passengers"),
        whole("estimated_compensation_eur", delayed).alias("delayed_compensation"),
        flag(delayed & F.col("fdi").isNotNull()).alias("delayed_fdi_n"),
        exact("predicted_delay_minutes").alias("delay_sum"),
        exact("fdi").alias("fdi_sum"),
        exact("fdi", delayed).alias("delayed_fdi_sum"),
        exact("res").alias("res_sum"),
    )


def summed(rows: DataFrame) -> DataFrame:
    """Sums per airline."""
    names = [c for c in rows.columns if c != "airline_icao"]
    sums = [
        F.sum(c).cast(LONG_SUM if c.endswith("_sum") else "bigint").alias(c) for c in names
    ]
    return rows.groupBy("airline_icao").agg(*sums)


def taken_out(sums: DataFrame) -> DataFrame:
    """Sums that are to be taken out of others; signs are turned once an airline, not once a flight."""
    return sums.withColumns({c: -F.col(c) for c in sums.columns if c != "airline_icao"})


def of_aircraft(states: DataFrame) -> DataFrame:
    """The records, by ``sign``, of all flights of the registrations that a changed flight had before the
    batch or has now, and of flights without one the changed ones."""
    sides = [
        F.when(F.col(name).isNotNull(), F.struct(F.lit(sign).alias("sign"), F.col(name).alias("record")))
        for name, sign in SIDES.items()
    ]
    rows = (
        states.select("flight_id", "changed", F.explode(F.array(*sides)).alias("side"))
        .filter(F.col("side").isNotNull())
        .select("flight_id", "changed", "side.sign", "side.record.*")
    )
    known = F.nullif(F.col("registration"), F.lit("")).isNotNull()
    aircraft = rows.filter(known & F.col("changed")).select("registration").distinct()
    alone = rows.filter(~known & F.col("changed"))
    return alone.unionByName(rows.filter(known).join(aircraft, "registration", "left_semi")).drop("changed")


class Dashboard(LiveTables):
    """Live tables with the sums of the dashboard; ``update`` is the ``foreachBatch`` function."""

    # -- writing --

    def _states(self, spark: SparkSession, start: Pointer, pointer: Pointer) -> DataFrame:
        """The record of every flight ``before`` and ``after`` the batch, null where it is not live, and
        whether it ``changed`` in what the sums are made of. One pass over the runs gives both."""
        old, new = start.runs[self.live.name], pointer.runs[self.live.name]
        shares = (
            ([run for run in old if run in new], True, True),
            ([run for run in old if run not in new], True, False),
            ([run for run in new if run not in old], False, True),
        )
        rows = None
        for runs, was, now in shares:
            if runs:
                some = self.store.read(spark, self.live.name, runs).select(
                    *COLUMNS,
                    (F.lit(was) & self.live.alive(start.clock)).alias("was"),
                    (F.lit(now) & self.live.alive(pointer.clock)).alias("now"),
                )
                rows = some if rows is None else rows.unionByName(some)
        order = [*self.live.order, SEEN]
        record = F.struct(*order, *[c for c in COLUMNS if c not in (self.live.key, *order)])
        states = rows.groupBy(self.live.key).agg(
            *[F.max(F.when(F.col(c), record)).alias(name) for name, c in zip(SIDES, ("was", "now"), strict=True)]
        )
        # A flight that is seen again with nothing new has not changed.
        states = states.withColumns({name: F.col(name).dropFields("updated_at", SEEN) for name in SIDES})
        return states.withColumn("changed", ~F.col("before").eqNullSafe(F.col("after")))

    def _derived(self, batch: DataFrame, start: Pointer | None, pointer: Pointer) -> dict[str, list[Run]]:
        spark = batch.sparkSession
        if start is None:
            # The first batch alone, which is written with one row a flight.
            first = self.store.read(spark, self.live.name, pointer.runs[self.live.name]).select(*COLUMNS)
            deltas = summed(contributions(live.with_ripple(self.live.unexpired(first, pointer.clock))))
            return {PARTS: [self.store.write(deltas, PARTS, pointer.place, pointer.place)]}
        # Written once, as a table of no pointer: the scores read it several times. What a batch that died
        # left of it goes first.
        folder = f"{self.base}/runs/{CHANGES}"
        files.remove(spark, folder)
        try:
            changes = self.store.write(
                of_aircraft(self._states(spark, start, pointer)), CHANGES, pointer.place, pointer.place
            )
            rows = self.store.read(spark, CHANGES, [changes])
            before, after = [
                summed(contributions(live.with_ripple(rows.filter(F.col("sign") == sign).drop("sign"))))
                for sign in SIDES.values()
            ]
            deltas = summed(taken_out(before).unionByName(after))
            run = self.store.write(deltas, PARTS, pointer.place, pointer.place)
        finally:
            files.remove(spark, folder)
        merged = self.store.merged(spark, PARTS, [*start.runs[PARTS], run], summed, FOREVER, pointer.place)
        return {PARTS: merged}

    # -- reading: one query a part --

    def sums(self, spark: SparkSession) -> DataFrame | None:
        newest = self.store.newest(spark)
        if newest is None:
            return None
        return summed(self.store.read(spark, PARTS, newest.runs[PARTS])).filter("flights > 0")

    def impact(self, spark: SparkSession) -> DataFrame | None:
        """Fleet impact, as ``summaries.aggregate_impact`` of the scored live view."""
        sums = self.sums(spark)
        if sums is None:
            return None

        def total(name: str) -> Column:
            return F.coalesce(F.sum(name), F.lit(0))

        def mean(value: str, count: str) -> Column:
            return F.coalesce(F.try_divide(F.sum(value).cast("double"), F.sum(count)), F.lit(0.0))

        return sums.agg(
            total("flights").alias("total_flights"),
            total("high_fdi").alias("high_fdi_flights"),
            total("critical").alias("critical_delay_flights"),
            total("high_res").alias("high_res_flights"),
            total("delayed_passengers").alias("total_affected_passengers"),
            total("delayed_compensation").alias("total_estimated_compensation_eur"),
            mean("delayed_fdi_sum", "delayed_fdi_n").alias("avg_fdi"),
            mean("res_sum", "flights").alias("avg_res"),
        )

    def airlines(self, spark: SparkSession) -> DataFrame | None:
        """Airline performance, as ``airlines.airline_performance`` of the scored live view."""
        sums = self.sums(spark)
        if sums is None:
            return None

        def share(name: str) -> Column:
            return F.col(name).cast("double") / F.col("flights")

        return A.performance_of(
            sums.filter("airline_icao <> ''").select(
                "airline_icao",
                F.col("flights").alias("total_flights"),
                *[share(c).alias(c) for c in ("on_time", "critical", "high_fdi", "high_res")],
                # Sums are exact; without the last digits of the division a mean of 29.05 stays one.
                *[F.round(share(f"{c}_sum"), 9).alias(c) for c in ("delay", "fdi", "res")],
                F.col("passengers").alias("total_affected_passengers"),
                F.col("compensation").alias("total_estimated_compensation_eur"),
            )
        )

    def totals(self, spark: SparkSession) -> DataFrame | None:
        """Live flights, and those that are critical now."""
        sums = self.sums(spark)
        return sums and sums.agg(
            F.coalesce(F.sum("flights"), F.lit(0)).alias("total_flights"),
            F.coalesce(F.sum("alerts"), F.lit(0)).alias("total_alerts"),
        )

    def payload(self, spark: SparkSession, n: int = 10) -> dict[str, DataFrame]:
        """The dashboard snapshot, one DataFrame a part; none scores the fleet but ``flights``."""
        performance, flights = self.airlines(spark), self.flights(spark)
        return {
            "stats": self.latest_stats(spark),
            "impact": self.impact(spark),
            "airlines": A.top_airlines(performance, n),
            "flights": live.with_ripple(flights),
            "alerts": list_alerts(self.alert_list(spark)),
            "totals": self.totals(spark),
        }
