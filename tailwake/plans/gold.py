"""Gold tables by airline, route, hour and weather.

A gold table is defined by partial aggregates that can be merged (counts, sums, maxima) and by what is
worked out from them. A full refresh takes both steps in one: one scan of its own few silver columns
and one shuffle of partial aggregates. ``IncrementalGold`` (``plans.incremental``) keeps the partial
aggregates of each batch and merges them instead of reading silver again.

``since`` and ``until`` (UTC dates, ``until`` exclusive) filter on the bare ``timestamp`` column, which
reaches the parquet scan, and on the ``event_date`` partition where silver has it, as stored silver
does; a refresh of a few days then opens the files of those days only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tailwake import constants as K
from tailwake.functions import bands, flight, timing, weather
from tailwake.plans.silver import EVENT_DATE
from tailwake.sources import lake


def dated(silver: DataFrame, since: date | None = None, until: date | None = None) -> DataFrame:
    """Silver rows of a range of days, with their date."""
    rows = silver
    by_date = EVENT_DATE in silver.columns
    if since is not None:
        rows = rows.filter(F.col("timestamp") >= timing.epoch_of_day(since))
        rows = rows.filter(F.col(EVENT_DATE) >= F.lit(since)) if by_date else rows
    if until is not None:
        rows = rows.filter(F.col("timestamp") < timing.epoch_of_day(until))
        rows = rows.filter(F.col(EVENT_DATE) < F.lit(until)) if by_date else rows
    return rows.withColumn("report_date", timing.utc_date(F.col("timestamp")))


@dataclass(frozen=True)
class GoldTable:
    """``keys`` beside the date, ``rows`` to prepare silver, ``parts`` to aggregate it by, ``final`` for
    the columns shown, ``order`` of presentation. Parts named ``max_`` merge by their maximum, all
    others by their sum."""

    keys: tuple[str, ...]
    parts: dict[str, Column]
    final: dict[str, Column]
    order: tuple[str, ...]
    rows: Callable[[DataFrame], DataFrame] = lambda silver: silver

    @property
    def group(self) -> list[str]:
        return ["report_date", *self.keys]

    def partial(self, silver: DataFrame) -> DataFrame:
        """Partial aggregates of silver rows with ``report_date``."""
        parts = [part.alias(name) for name, part in self.parts.items()]
        return self.rows(silver).groupBy(*self.group).agg(*parts)

    def merge(self, partials: DataFrame) -> DataFrame:
        """One row per key of partial aggregates of any origin."""
        merged = [(F.max if n.startswith("max_") else F.sum)(n).alias(n) for n in self.parts]
        return partials.groupBy(*self.group).agg(*merged)

    def finish(self, merged: DataFrame) -> DataFrame:
        return merged.select(*self.group, *[column.alias(name) for name, column in self.final.items()])


def _total(*names: str) -> dict[str, Column]:
    """What a mean is made of."""
    sums = {f"sum_{n}": F.sum(F.col(n).cast("double")) for n in names}
    return sums | {f"n_{n}": F.count(n) for n in names}


def _mean(name: str, digits: int) -> Column:
    return F.round(F.try_divide(F.col(f"sum_{name}"), F.col(f"n_{name}")), digits)


def _category_count(category: str) -> Column:
    return bands.count_where(F.col("delay_category") == category)


def _percent(count: str) -> Column:
    return F.round(F.col(count) / F.col("total_flights") * 100, 1)


def _known_routes(silver: DataFrame) -> DataFrame:
    """Routes with both ends known."""
    unknown = ("", K.TEXT_DEFAULT)
    return silver.filter(~F.col("origin").isin(*unknown) & ~F.col("destination").isin(*unknown))


def _bucketed(silver: DataFrame) -> DataFrame:
    return silver.withColumn("weather_bucket", weather.weather_bucket(F.col("weather_score")))


def _tables() -> dict[str, GoldTable]:
    total = {"total_flights": F.count(F.lit(1))}
    shown = {"total_flights": F.col("total_flights"), "avg_delay_minutes": _mean("predicted_delay_minutes", 1)}
    critical = {"critical_delay_count": _category_count(K.CRITICAL_DELAY)}
    return {
        "airline_daily_performance": GoldTable(
            ("airline_icao",),
            total
            | _total("predicted_delay_minutes", "fdi")
            | {
                "max_delay": F.max("predicted_delay_minutes"),
                "on_time_count": _category_count(K.ON_TIME),
                "medium_delay_count": _category_count(K.MEDIUM_DELAY),
            }
            | critical
            | {
                "total_affected_passengers": F.sum("affected_passengers"),
                "total_compensation_eur": F.sum("estimated_compensation_eur"),
            },
            shown
            | {
                "max_delay_minutes": F.round("max_delay", 1),
                "on_time_count": F.col("on_time_count"),
                "medium_delay_count": F.col("medium_delay_count"),
                "critical_delay_count": F.col("critical_delay_count"),
                "avg_fdi": _mean("fdi", 1),
                "total_affected_passengers": F.col("total_affected_passengers"),
                "total_compensation_eur": F.col("total_compensation_eur"),
                "on_time_percentage": _percent("on_time_count"),
            },
            ("report_date", "airline_icao"),
        ),
        "route_daily_statistics": GoldTable(
            ("origin", "destination"),
            total
            | _total("predicted_delay_minutes", "weather_score", "traffic_density", "distance_km")
            | critical,
            shown
            | {
                "avg_weather_score": _mean("weather_score", 3),
                "avg_traffic_density": _mean("traffic_density", 1),
                "critical_delay_count": F.col("critical_delay_count"),
                "avg_distance_km": _mean("distance_km", 1),
            },
            ("report_date", "-total_flights", "origin", "destination"),
            _known_routes,
        ),
        "hourly_delay_trends": GoldTable(
            ("hour_utc",),
            total
            | _total("predicted_delay_minutes", "weather_score", "traffic_density")
            | {"delayed_count": bands.count_where(flight.is_delayed(F.col("delay_category")))},
            shown
            | {
                "delayed_percentage": _percent("delayed_count"),
                "avg_weather_score": _mean("weather_score", 3),
                "avg_traffic_density": _mean("traffic_density", 1),
            },
            ("report_date", "hour_utc"),
        ),
        "weather_impact_analysis": GoldTable(
            ("weather_bucket",),
            total | _total("predicted_delay_minutes", "fdi", "route_deviation") | critical,
            shown
            | {
                "avg_fdi": _mean("fdi", 1),
                "critical_percentage": _percent("critical_delay_count"),
                "avg_route_deviation": _mean("route_deviation", 2),
            },
            ("report_date", "weather_bucket"),
            _bucketed,
        ),
    }


#: Names of the gold tables; a definition holds columns and so needs a running session.
TABLES = (
    "airline_daily_performance", "route_daily_statistics", "hourly_delay_trends", "weather_impact_analysis",
)


def definition(name: str) -> GoldTable:
    if name not in TABLES:
        raise ValueError(f"unknown gold table {name!r}; valid names: {', '.join(TABLES)}")
    return _tables()[name]


def presented(df: DataFrame, name: str) -> DataFrame:
    """A gold table in its order of presentation."""
    order = definition(name).order
    return df.orderBy(
        *[F.col(c[1:]).desc() if c.startswith("-") else F.col(c).asc() for c in order]
    )


def build(silver: DataFrame, name: str, since=None, until=None) -> DataFrame:
    table = definition(name)
    return table.finish(table.partial(dated(silver, since, until)))


def refresh(
    silver: DataFrame,
    base: str,
    since: date | None = None,
    until: date | None = None,
    names: Iterable[str] = TABLES,
    fmt: str = "parquet",
) -> dict[str, int]:
    """Write gold tables below ``base``; returns the rows written by table.

    Without a date range the tables are replaced whole; with one, every day in it, also one that
    has no rows any more.
    """

    def write(name: str) -> int:
        rows, path = build(silver, name, since, until), f"{base}/{name}"
        if since is None and until is None:
            return lake.replace_table(rows, path, "report_date", fmt=fmt)
        return lake.replace_days(rows, path, "report_date", since, until, fmt)

    return {name: write(name) for name in names}


def gold_table(
    spark: SparkSession, base: str, name: str, fmt: str = "parquet"
) -> DataFrame | None:
    """A written gold table in order, ``None`` when it has not been written yet."""
    definition(name)
    table = lake.table_or_none(spark, f"{base}/{name}", fmt)
    return None if table is None else presented(table, name)


def gold_samples(spark: SparkSession, base: str, n: int = 5, fmt: str = "parquet"):
    """The first rows of every written table, by name."""
    tables = {name: gold_table(spark, base, name, fmt) for name in TABLES}
    return {name: table.limit(n) for name, table in tables.items() if table is not None}


def gold_summary(spark: SparkSession, base: str, fmt: str = "parquet") -> DataFrame:
    """(table, rows) of the written gold tables; a missing table has null rows."""
    parts = []
    for name in TABLES:
        table = lake.table_or_none(spark, f"{base}/{name}", fmt)
        if table is None:
            table = spark.range(1).select(F.lit(None).cast("bigint").alias("rows"))
        else:
            table = table.agg(F.count(F.lit(1)).alias("rows"))
        parts.append(table.select(F.lit(name).alias("table"), "rows"))
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union


def gold_json(df: DataFrame, name: str) -> DataFrame:
    """A gold table for serving: one JSON document per row (JSON lines), never one big array."""
    return df.select(F.lit(name).alias("table"), F.to_json(F.struct(*df.columns)).alias("json"))
