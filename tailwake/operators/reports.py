"""Cleaning, features, delay and impact of position reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tailwake import constants as K
from tailwake.functions import bands, flight, impact, timing, weather


def clean_reports(reports: DataFrame) -> DataFrame:
    """Plausible airborne reports with a position; missing weather and codes get defaults.

    Empty text is kept as it is: only nulls become ``UNKNOWN``.
    """
    plausible = (
        F.col("flight_id").isNotNull()
        & F.col("latitude").isNotNull()
        & F.col("longitude").isNotNull()
        & ~F.col("on_ground")
        & F.col("altitude_ft").between(*K.ALTITUDE_FT)
        & F.col("speed_kn").between(*K.SPEED_KN)
        & F.col("heading_deg").between(*K.HEADING_DEG)
    )
    texts = dict.fromkeys(K.TEXT_DEFAULT_COLUMNS, K.TEXT_DEFAULT)
    return reports.filter(plausible).fillna({**K.NUMERIC_DEFAULTS, **texts})


def add_base_features(rows: DataFrame) -> DataFrame:
    """Flags and ratios shared by inference and training.

    Training rows bring ``hour_utc`` and ``day_of_week``; reports get them from their timestamp
    first (``add_features``).
    """
    rain, wind, sight, code, height, speed = (
        F.col(c)
        for c in (
            "precipitation_mm", "wind_knots", "visibility_m", "weather_code",
            "altitude_ft", "speed_kn",
        )
    )
    return rows.withColumns(
        {
            "is_raining": weather.is_raining(rain),
            "is_high_wind": weather.is_high_wind(wind),
            "is_low_visibility": weather.is_low_visibility(sight),
            "is_bad_weather": weather.is_bad_weather(code),
            "flight_phase": flight.flight_phase(height),
            "is_slow": flight.is_slow(speed),
            "speed_altitude_ratio": flight.speed_altitude_ratio(speed, height),
            "is_peak_hour": timing.is_peak_hour(F.col("hour_utc")),
            "is_weekend": timing.is_weekend(F.col("day_of_week")),
        }
    )


def add_features(reports: DataFrame) -> DataFrame:
    """Every derived feature of a cleaned report, in three projections Catalyst merges."""
    clock = F.col("timestamp")
    timed = reports.withColumns(
        {"hour_utc": timing.hour_utc(clock), "day_of_week": timing.day_of_week(clock)}
    )
    rain, wind, sight, code, height, speed = (
        F.col(c)
        for c in (
            "precipitation_mm", "wind_knots", "visibility_m", "weather_code",
            "altitude_ft", "speed_kn",
        )
    )
    return add_base_features(timed).withColumns(
        {
            "weather_score": weather.weather_score(rain, wind, sight, code),
            "distance_km": flight.distance_km(speed, height),
            "route_deviation": weather.route_deviation(wind, code),
            "traffic_density": timing.traffic_density(F.col("hour_utc"), F.col("day_of_week")),
            "risk_score_manual": flight.risk_score(),
        }
    )


def add_delay(rows: DataFrame, minutes: Column | None = None) -> DataFrame:
    """Delay in minutes and its category; the rule-based delay unless ``minutes`` is given."""
    if minutes is None:
        minutes = flight.rule_delay(F.col("risk_score_manual"))
    return rows.withColumn("predicted_delay_minutes", bands.real(minutes)).withColumn(
        "delay_category", flight.delay_category(F.col("predicted_delay_minutes"))
    )


def add_impact(rows: DataFrame) -> DataFrame:
    """Seats, passengers, delay index and compensation of rows with a delay."""
    minutes = F.col("predicted_delay_minutes")
    return (
        rows.withColumns(
            {
                "capacity": impact.capacity(F.col("aircraft_model")),
                "normalized_delay": impact.normalized_delay(minutes),
            }
        )
        .withColumns(
            {
                "affected_passengers": impact.affected_passengers(F.col("capacity")),
                "fdi": impact.flight_delay_index(
                    F.col("normalized_delay"),
                    F.col("weather_score"),
                    F.col("traffic_density"),
                    F.col("route_deviation"),
                    F.col("is_peak_hour"),
                ),
            }
        )
        .withColumns(
            {
                "fdi_category": bands.score_band(F.col("fdi")),
                "estimated_compensation_eur": impact.compensation_eur(
                    minutes, F.col("distance_km"), F.col("affected_passengers")
                ),
            }
        )
    )
