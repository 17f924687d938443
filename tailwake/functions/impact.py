"""Passengers, delay index and compensation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tailwake import constants as K
from tailwake.functions.bands import below, capped, real, weighted


def capacity(aircraft_model: Column) -> Column:
    """Seats by type from a 25-entry literal map; unknown or null types get the default."""
    seats = ", ".join(f"'{model}', {n}" for model, n in K.AIRCRAFT_CAPACITY.items())
    return F.coalesce(
        F.element_at(F.expr(f"map({seats})"), aircraft_model), F.lit(K.DEFAULT_CAPACITY)
    )


def affected_passengers(seats: Column) -> Column:
    return F.round(seats * K.LOAD_FACTOR).cast("int")


def normalized_delay(minutes: Column) -> Column:
    return real(capped(minutes / F.lit(180.0)))


def flight_delay_index(
    delay: Column, weather: Column, traffic: Column, deviation: Column, peak: Column
) -> Column:
    return real(
        weighted(
            [
                (delay, 40.0),
                (weather, 25.0),
                (traffic / F.lit(10.0), 15.0),
                (capped(deviation / F.lit(50.0)), 10.0),
                (peak, 10.0),
            ]
        )
    )


def compensation_eur(minutes: Column, distance: Column, passengers: Column) -> Column:
    per_head = below(distance, [(1500, 250), (3500, 400)], 600)
    return F.when(minutes < 180, 0).otherwise(passengers * per_head).cast("int")
