"""Joins with the fixed lookup tables (at most 104 rows, hence broadcast)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tailwake import constants as K
from tailwake.sources import lookups


def add_airline_name(rows: DataFrame, code: str = "airline_icao") -> DataFrame:
    names = F.broadcast(
        lookups.airline_names(rows.sparkSession).withColumnRenamed("airline_icao", "code")
    )
    return (
        rows.join(names, rows[code] == names["code"], "left")
        .drop("code")
        .withColumn("airline_name", F.coalesce("airline_name", F.lit(K.UNKNOWN_AIRLINE)))
    )


def add_route_airports(rows: DataFrame) -> DataFrame:
    """ICAO code, name, country and position of both ends of the route, where they are known."""
    result = rows
    for end in ("origin", "destination"):
        airport = lookups.airports(rows.sparkSession)
        named = F.broadcast(airport.select(*[F.col(c).alias(f"{end}_{c}") for c in airport.columns]))
        result = result.join(named, F.col(end) == F.col(f"{end}_iata"), "left").drop(f"{end}_iata")
    return result


def add_capacity(rows: DataFrame) -> DataFrame:
    """Seats by aircraft type as a join; ``functions.impact.capacity`` is the map form."""
    seats = F.broadcast(lookups.capacities(rows.sparkSession))
    return rows.join(seats, "aircraft_model", "left").withColumn(
        "capacity", F.coalesce("capacity", F.lit(K.DEFAULT_CAPACITY))
    )
