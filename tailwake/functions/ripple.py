"""How a delay carries over to the aircraft's later flights (0-100)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tailwake import constants as K
from tailwake.functions.bands import at_least, below, capped, weighted, within


def rotation_factor(gap_min: Column) -> Column:
    """How tight the turn-round is; 0 with no next flight."""
    tight = below(gap_min, [(60, 100.0), (120, 75.0), (180, 50.0), (300, 25.0)], 10.0)
    return F.when(gap_min.isNull(), 0.0).otherwise(tight)


def downstream_factor(flights: Column) -> Column:
    return at_least(flights, [(5, 100.0), (3, 66.0), (1, 33.0)], 0.0)


def hub_factor(destination: Column) -> Column:
    return F.when(destination.isin(*K.HUB_AIRPORTS), 100.0).otherwise(30.0)


def delay_factor(minutes: Column) -> Column:
    return capped(minutes / F.lit(120.0)) * 100.0


def recovery_factor(hour: Column) -> Column:
    return (
        F.when(within(hour, (0, 5)), 100.0)
        .when(within(hour, K.MORNING_PEAK, K.EVENING_PEAK), 75.0)
        .when(within(hour, (21, 23)), 50.0)
        .otherwise(25.0)
    )


def ripple_score(
    gap_min: Column,
    downstream: Column,
    destination: Column,
    minutes: Column,
    hour: Column,
    fdi: Column,
) -> Column:
    def or_zero(value):
        return F.coalesce(value, F.lit(0))

    raw = weighted(
        [
            (rotation_factor(gap_min), 0.30),
            (downstream_factor(downstream), 0.20),
            (hub_factor(destination), 0.20),
            (delay_factor(or_zero(minutes)), 0.15),
            (recovery_factor(or_zero(hour)), 0.10),
            (or_zero(fdi).cast("double"), 0.05),
        ]
    )
    return F.round(F.least(F.greatest(raw, F.lit(0.0)), F.lit(100.0)), 1)
