"""Flight-state features and the rule-based delay."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tailwake import constants as K
from tailwake.functions.bands import above, below, flag, real, up_to, weighted


def flight_phase(altitude_ft: Column) -> Column:
    return below(altitude_ft, [(15000, 0), (35000, 1)], 2)


def is_slow(speed_kn: Column) -> Column:
    return flag(speed_kn < 200)


def speed_altitude_ratio(speed_kn: Column, altitude_ft: Column) -> Column:
    return above(altitude_ft, [(0, speed_kn / altitude_ft * 1000)], 0.0)


def distance_km(speed_kn: Column, altitude_ft: Column) -> Column:
    """Trip length guessed from cruise height (hours flown) and ground speed."""
    kmh = speed_kn * 1.852
    return real(above(altitude_ft, [(30000, kmh * 3.5), (20000, kmh * 2.0)], kmh * 1.0))


# --- fixed values: risk weights ---
RISK_WEIGHTS = {
    "is_raining": 2.0,
    "is_high_wind": 2.5,
    "is_low_visibility": 3.0,
    "is_bad_weather": 2.0,
    "is_peak_hour": 1.5,
    "is_weekend": 0.5,
    "is_slow": 1.0,
}
MINUTES_PER_RISK_POINT = 6.0


def risk_score() -> Column:
    return weighted([(F.col(name), weight) for name, weight in RISK_WEIGHTS.items()])


def rule_delay(risk: Column) -> Column:
    return real(F.round(risk * MINUTES_PER_RISK_POINT, 1))


def delay_category(minutes: Column) -> Column:
    """A null delay counts as critical."""
    return F.when(minutes < 15, K.ON_TIME).otherwise(
        up_to(minutes, [(60, K.MEDIUM_DELAY)], K.CRITICAL_DELAY)
    )


def is_delayed(category: Column) -> Column:
    return category.isin(*K.DELAYED)


def is_delayed_served(category: Column) -> Column:
    """Delayed as the served views see it: anything but on time, blank, unknown or missing."""
    return ~F.coalesce(category, F.lit("")).isin(K.ON_TIME, "", K.TEXT_DEFAULT)
