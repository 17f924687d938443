"""Critical-delay alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tailwake import constants as K
from tailwake.functions import display
from tailwake.operators.latest import latest_per_key, within_retention


def _critical(flights: DataFrame) -> DataFrame:
    return flights.filter(
        (F.col("delay_category") == K.CRITICAL_DELAY) & (F.col("flight_id") != "")
    )


def remaining_ttl(created: Column, now: Column | int, ttl_s: int = K.ALERT_TTL_S) -> Column:
    clock = now if isinstance(now, Column) else F.lit(now)
    return F.greatest(F.lit(0), created + ttl_s - clock).cast("int")


def scan_alerts(flights: DataFrame) -> DataFrame:
    """Flights of a live view that are critical now, stamped with the time of the sighting."""
    return _critical(flights).withColumn("alert_created_at", F.col("timestamp"))


def critical_alerts(
    flights: DataFrame, now: Column | int | None = None, ttl_s: int = K.ALERT_TTL_S
) -> DataFrame:
    """Last critical sighting of each flight; with a clock, those of the last hour only.

    ``flights`` may hold many records per flight: an alert outlives the flight's return to a
    lesser delay until it expires.
    """
    sighted = latest_per_key(
        within_retention(_critical(flights), now, ttl_s), "flight_id", "timestamp"
    )
    alerts = sighted.withColumn("alert_created_at", F.col("timestamp"))
    if now is None:
        return alerts
    return alerts.withColumn("ttl_seconds", remaining_ttl(F.col("alert_created_at"), now, ttl_s))


def list_alerts(alerts: DataFrame, limit: int | None = None) -> DataFrame:
    if limit is None:
        return alerts
    if not 1 <= limit <= 1000:
        raise ValueError("limit must be between 1 and 1000")
    return alerts.orderBy("flight_id").limit(limit)


def add_severity(alerts: DataFrame) -> DataFrame:
    """Colour by delay index, and advice by ripple band."""
    return alerts.withColumn("fdi_severity", display.fdi_severity(F.col("fdi"))).withColumn(
        "ripple_advice", display.ripple_advice(F.col("res_category"))
    )


def top_alerts(alerts: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` alerts with the highest delay index; a missing index counts as zero."""
    return alerts.orderBy(F.coalesce("fdi", F.lit(0)).desc(), "flight_id").limit(n)
