"""The served queries over a live view (``plans.live``) and its summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tailwake.operators import airlines as A
from tailwake.operators.alerts import list_alerts
from tailwake.operators.summaries import aggregate_impact

MAX_FLIGHTS = 1000

IMPACT_COLUMNS = (
    "flight_id", "callsign", "airline", "aircraft", "registration", "origin", "destination",
    "predicted_delay_minutes", "delay_category", "capacity", "affected_passengers",
    "fdi", "fdi_category", "estimated_compensation_eur",
    "res", "res_category", "next_flight_id", "next_flight_gap_min", "downstream_flight_count",
)
RIPPLE_COLUMNS = (
    "flight_id", "registration", "res", "res_category",
    "next_flight_id", "next_flight_gap_min", "downstream_flight_count",
)


def list_flights(
    flights: DataFrame,
    airline: str | None = None,
    delay_category: str | None = None,
    fdi_category: str | None = None,
    res_category: str | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Live flights under the given filters; the airline code ignores case."""
    if limit is not None and not 1 <= limit <= MAX_FLIGHTS:
        raise ValueError(f"limit must be between 1 and {MAX_FLIGHTS}")
    rows = flights
    if airline:
        rows = rows.filter(F.upper("airline") == airline.upper())
    exact = {
        "delay_category": delay_category,
        "fdi_category": fdi_category,
        "res_category": res_category,
    }
    for column, wanted in exact.items():
        if wanted:
            rows = rows.filter(F.col(column) == wanted)
    return rows.orderBy("flight_id").limit(limit) if limit else rows


def flight_detail(flights: DataFrame, flight_id: str) -> DataFrame:
    """The one live record; no row when the flight is not live."""
    return flights.filter(F.col("flight_id") == flight_id)


def flight_impact(flights: DataFrame, flight_id: str | None = None) -> DataFrame:
    """Impact figures of one flight, or of all."""
    rows = flights if flight_id is None else flight_detail(flights, flight_id)
    return rows.select(*IMPACT_COLUMNS)


def ripple_effect(flights: DataFrame, flight_id: str | None = None) -> DataFrame:
    """Ripple score and onward legs of one flight, or of all."""
    rows = flights if flight_id is None else flight_detail(flights, flight_id)
    return rows.select(*RIPPLE_COLUMNS)


def airline_detail(flights: DataFrame, icao: str) -> DataFrame:
    """One airline's figures (any case); filters its flights before they are aggregated."""
    return A.airline_performance(flights.filter(F.upper("airline") == icao.upper()))


def dashboard_payload(
    flights: DataFrame, alerts: DataFrame, stats: DataFrame, n: int = 10
) -> dict[str, DataFrame]:
    """The dashboard snapshot, one DataFrame per part."""
    return {
        "stats": stats,
        "impact": aggregate_impact(flights),
        "airlines": A.top_airlines(A.airline_performance(flights), n),
        "flights": flights,
        "alerts": list_alerts(alerts),
        "totals": dashboard_totals(flights, alerts),
    }


def dashboard_totals(flights: DataFrame, alerts: DataFrame) -> DataFrame:
    """(total_flights, total_alerts), one row."""
    tagged = flights.select(F.lit(1).alias("f"), F.lit(0).alias("a")).unionByName(
        alerts.select(F.lit(0).alias("f"), F.lit(1).alias("a"))
    )
    return tagged.agg(
        F.coalesce(F.sum("f"), F.lit(0)).alias("total_flights"),
        F.coalesce(F.sum("a"), F.lit(0)).alias("total_alerts"),
    )


def counted(rows: DataFrame) -> DataFrame:
    """``count`` of a served list."""
    return rows.agg(F.count(F.lit(1)).alias("count"))
