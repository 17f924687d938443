"""Live view: the latest record of every flight, its rotation and ripple score."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tailwake import constants as K
from tailwake import schemas as S
from tailwake.operators.latest import latest_per_key, within_retention
from tailwake.operators.rotation import add_ripple, onward_legs, rotations


def live_columns(enriched: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Enriched reports under the live view's column names, all or the named ones."""
    wanted = S.LIVE_COLUMNS if columns is None else columns
    return enriched.select(*[F.col(S.LIVE_COLUMNS[name]).alias(name) for name in wanted])


def live_state(
    enriched: DataFrame,
    now: Column | int | None = None,
    ttl_s: int = K.LIVE_TTL_S,
    columns: Iterable[str] | None = None,
) -> DataFrame:
    """Last report per flight; with a clock, of flights heard from within ``ttl_s``.

    The record travels as one struct, which the optimizer does not prune: name the ``columns``
    a query needs and only those are computed and shuffled. Key and times always are.
    """
    if columns is not None:
        columns = list(dict.fromkeys(["flight_id", "timestamp", "updated_at", *columns]))
    current = within_retention(live_columns(enriched, columns), now, ttl_s)
    return latest_per_key(current, "flight_id", "timestamp", "updated_at")


def chosen_with_ripple(
    flights: DataFrame,
    condition: Column,
    index: DataFrame | None = None,
    horizon_s: int = K.ROTATION_HORIZON_S,
) -> DataFrame:
    """Live flights that meet a condition, with ripple scores; rotations are computed for their
    aircraft only."""
    chosen = flights.filter(condition)
    index = rotations(flights) if index is None else index
    own = index.join(chosen.select("registration").distinct(), "registration", "left_semi")
    return add_ripple(chosen, onward_legs(own, horizon_s))


def one_with_ripple(
    flights: DataFrame,
    flight_id: str,
    index: DataFrame | None = None,
    horizon_s: int = K.ROTATION_HORIZON_S,
) -> DataFrame:
    """One live flight with its ripple score."""
    return chosen_with_ripple(flights, F.col("flight_id") == flight_id, index, horizon_s)


def airline_with_ripple(
    flights: DataFrame,
    icao: str,
    index: DataFrame | None = None,
    horizon_s: int = K.ROTATION_HORIZON_S,
) -> DataFrame:
    """The live flights of one airline (any case) with their ripple scores."""
    return chosen_with_ripple(flights, F.upper("airline") == icao.upper(), index, horizon_s)


def with_ripple(
    flights: DataFrame,
    index: DataFrame | None = None,
    horizon_s: int = K.ROTATION_HORIZON_S,
) -> DataFrame:
    """Live flights with ripple scores, over ``index`` or the rotations of the flights themselves."""
    legs = onward_legs(rotations(flights) if index is None else index, horizon_s)
    return add_ripple(flights, legs)
