"""Airline performance and ranking over a live view with ripple scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tailwake import constants as K
from tailwake.functions import airline, bands


PERFORMANCE_INPUTS = (
    "airline", "delay_category", "fdi_category", "predicted_delay_minutes", "fdi",
    "affected_passengers", "estimated_compensation_eur",
)


def airline_performance(flights: DataFrame) -> DataFrame:
    """One row per airline; flights without an airline code are left out."""

    def rate(column: str, *values: str) -> Column:
        return bands.count_where(F.col(column).isin(*values)) / F.count(F.lit(1))

    def mean(column: str) -> Column:
        return F.avg(F.coalesce(column, F.lit(0)).cast("double"))

    totals = (
        flights.filter(F.col("airline") != "")
        .groupBy(F.col("airline").alias("airline_icao"))
        .agg(
            F.count(F.lit(1)).alias("total_flights"),
            rate("delay_category", K.ON_TIME).alias("on_time"),
            rate("delay_category", K.CRITICAL_DELAY).alias("critical"),
            rate("fdi_category", *K.ELEVATED).alias("high_fdi"),
            rate("res_category", *K.ELEVATED).alias("high_res"),
            mean("predicted_delay_minutes").alias("delay"),
            mean("fdi").alias("fdi"),
            mean("res").alias("res"),
            F.sum(F.coalesce("affected_passengers", F.lit(0))).alias("total_affected_passengers"),
            F.sum(F.coalesce("estimated_compensation_eur", F.lit(0))).alias(
                "total_estimated_compensation_eur"
            ),
        )
    )
    return performance_of(totals)


def performance_of(totals: DataFrame) -> DataFrame:
    """What is shown of the totals of each airline: counts and sums, shares, and means ``delay``,
    ``fdi`` and ``res``."""
    score = airline.performance_index(*[F.col(c) for c in ("on_time", "delay", "critical", "fdi", "res")])
    percent = {
        "on_time_rate": "on_time",
        "critical_delay_rate": "critical",
        "high_fdi_rate": "high_fdi",
        "high_res_rate": "high_res",
    }
    averages = {"avg_delay_minutes": "delay", "avg_fdi": "fdi", "avg_res": "res"}
    return totals.select(
        "airline_icao",
        "total_flights",
        *[F.round(F.col(c) * 100, 1).alias(name) for name, c in percent.items()],
        *[F.round(c, 1).alias(name) for name, c in averages.items()],
        "total_affected_passengers",
        "total_estimated_compensation_eur",
        score.alias("api_score"),
        airline.performance_band(score).alias("api_category"),
    )


def _best_first() -> list[Column]:
    return [F.col("api_score").desc(), F.col("airline_icao").asc()]


def rank_airlines(performance: DataFrame) -> DataFrame:
    """All airlines with their place, best score first, ties by code.

    The score has one decimal, hence at most 1,001 values: airlines are numbered within their score
    in parallel and only the per-score counts pass through one task and a broadcast. Both uses of
    the figures begin with the same exchange, which is computed once.
    """
    figures = performance
    within_score = Window.partitionBy("api_score").orderBy("airline_icao")
    better = (
        Window.orderBy(F.col("api_score").desc()).rowsBetween(Window.unboundedPreceding, -1)
    )
    ahead = (
        figures.groupBy("api_score")
        .agg(F.count(F.lit(1)).alias("airlines"))
        .select("api_score", F.coalesce(F.sum("airlines").over(better), F.lit(0)).alias("ahead"))
    )
    rank = F.col("ahead") + F.row_number().over(within_score)
    return figures.join(F.broadcast(ahead), "api_score").select(
        rank.cast("int").alias("rank"), *performance.columns
    )


def top_airlines(performance: DataFrame, n: int = 10) -> DataFrame:
    return performance.orderBy(*_best_first()).limit(n)


def list_airlines(
    performance: DataFrame,
    min_api_score: float | None = None,
    category: str | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Airlines best first, with the optional filters of the served list."""
    if limit is not None and not 1 <= limit <= 500:
        raise ValueError("limit must be between 1 and 500")
    rows = performance
    if min_api_score is not None:
        rows = rows.filter(F.col("api_score") >= min_api_score)
    if category:
        rows = rows.filter(F.col("api_category") == category.upper())
    ordered = rows.orderBy(*_best_first())
    return ordered.limit(limit) if limit else ordered
