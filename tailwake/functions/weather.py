"""Weather flags, scores and classes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tailwake import constants as K
from tailwake.functions.bands import above, at_least, below, capped, flag, real, weighted, within

KMH_PER_KNOT = 1.852


def is_raining(precipitation_mm: Column) -> Column:
    return flag(precipitation_mm > 0.5)


def is_high_wind(wind_knots: Column) -> Column:
    return flag(wind_knots > 25)


def is_low_visibility(visibility_m: Column) -> Column:
    return flag(visibility_m < 3000)


def is_bad_weather(weather_code: Column) -> Column:
    return flag(within(weather_code, (60, 99)))


def weather_score(
    precipitation_mm: Column, wind_knots: Column, visibility_m: Column, weather_code: Column
) -> Column:
    """0 (clear) to 1 (storm)."""
    rain = capped(precipitation_mm / F.lit(50.0))
    wind = capped(wind_knots / F.lit(60.0))
    haze = F.greatest(F.lit(0.0), 1.0 - visibility_m / F.lit(15000.0))
    kind = at_least(weather_code, [(80, 1.0), (60, 0.6), (40, 0.3)], 0.0)
    return real(capped(weighted([(rain, 0.3), (wind, 0.25), (haze, 0.25), (kind, 0.2)])))


def route_deviation(wind_knots: Column, weather_code: Column) -> Column:
    drift = above(wind_knots, [(30, wind_knots * 0.3)], wind_knots * 0.1)
    return real(drift + at_least(weather_code, [(60, 5.0)], 0.0))


def weather_bucket(score: Column) -> Column:
    return below(score, [(0.2, K.CLEAR), (0.5, K.MODERATE)], K.SEVERE)


def weather_condition(weather_code: Column) -> Column:
    """Display class of a WMO weather code; codes between the ranges are cloudy."""
    return (
        F.when(weather_code <= 1, "CLEAR")
        .when(weather_code <= 3, "PARTLY CLOUDY")
        .when(within(weather_code, (51, 69)), "RAIN")
        .when(within(weather_code, (71, 79)), "SNOW")
        .when(within(weather_code, (80, 99)), "STORM")
        .otherwise("CLOUDY")
    )


def knots(speed: Column, unit: Column) -> Column:
    """Wind speed in knots; anything not marked ``kmh`` is taken to be knots already."""
    return real(F.when(unit == "kmh", speed / F.lit(KMH_PER_KNOT)).otherwise(speed))
