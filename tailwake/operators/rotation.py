"""Aircraft rotations: which flights follow a flight on the same aircraft, and how soon.

The lookup is a window over time slices as long as the horizon. Flights of one aircraft in one
second are folded to one stop first, so a (registration, slice) group holds at most two rows per
second of the horizon however many rows carry the registration, and the work is linear in the
number of stops: no pair of flights is formed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tailwake import constants as K
from tailwake.functions import bands, ripple, timing
from tailwake.operators.latest import within_retention

KEY = ("registration", "timestamp")
RIPPLE_INPUTS = ("registration", "destination", "predicted_delay_minutes", "hour_utc", "fdi")


def rotations(flights: DataFrame) -> DataFrame:
    """(registration, flight_id, timestamp) of the rows with a registration and a time."""
    known = F.nullif(F.col("registration"), F.lit("")).isNotNull()
    return flights.filter(known & (F.col("timestamp") != 0)).select(
        "registration", "flight_id", "timestamp"
    )


def rotation_index(
    reports: DataFrame,
    now: Column | int | None = None,
    retention_s: int = K.ROTATION_HORIZON_S,
) -> DataFrame:
    """(registration, flight_id, timestamp of its last report); blank registrations left out."""
    return (
        rotations(within_retention(reports, now, retention_s))
        .groupBy("registration", "flight_id")
        .agg(F.max("timestamp").alias("timestamp"))
    )


def onward_legs(index: DataFrame, horizon_s: int = K.ROTATION_HORIZON_S) -> DataFrame:
    """Per (registration, timestamp): flights later than it within the horizon, and the first.

    ``index`` has one row per flight: ``rotation_index``, or ``rotations`` of a live view. Of several next flights
    in the same second the smallest id is taken.
    """
    stops = index.groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("flights"), F.min("flight_id").alias("flight_id")
    )
    # A stop looks no further than the end of the next slice, so each is placed in its own slice
    # and, as something to look ahead to, in the one before.
    own = timing.slice_of(F.col("timestamp"), horizon_s)
    placed = stops.withColumn("slice", F.explode(F.array(own, own - 1)))
    # Backwards in time both counts run over frames that only grow, which Spark evaluates in one
    # pass; a frame from 1 to horizon seconds ahead would be summed anew for every row.
    backwards = Window.partitionBy("registration", "slice").orderBy(F.col("timestamp").desc())

    def flights_from(seconds_ahead: int) -> Column:
        frame = backwards.rangeBetween(Window.unboundedPreceding, -seconds_ahead)
        return F.coalesce(F.sum("flights").over(frame), F.lit(0))

    upcoming = F.lag(F.struct("timestamp", "flight_id")).over(backwards)
    swept = placed.select(
        *KEY,
        "slice",
        (flights_from(1) - flights_from(horizon_s + 1)).alias("downstream_count"),
        upcoming.alias("upcoming"),
    ).filter(F.col("slice") == own)
    reached = F.col("downstream_count") > 0
    return swept.select(
        *KEY,
        "downstream_count",
        F.when(reached, F.col("upcoming.timestamp")).alias("next_timestamp"),
        F.when(reached, F.col("upcoming.flight_id")).alias("next_flight_id"),
    )


def add_onward_legs(flights: DataFrame, legs: DataFrame) -> DataFrame:
    """Flights with ``downstream_flight_count``, ``next_flight_id``, ``next_flight_gap_min``.

    The join key includes the second, so rows of a busy or blank registration spread over the
    tasks; ``legs`` has one row per key.
    """
    f, g = flights.alias("f"), legs.alias("g")
    joined = f.join(g, [F.col(f"f.{c}") == F.col(f"g.{c}") for c in KEY], "left")
    gap = F.floor((F.col("g.next_timestamp") - F.col("f.timestamp")) / F.lit(60)).cast("int")
    return joined.select(
        *[F.col(f"f.{c}") for c in flights.columns],
        F.col("g.next_flight_id").alias("next_flight_id"),
        gap.alias("next_flight_gap_min"),
        F.coalesce("g.downstream_count", F.lit(0)).alias("downstream_flight_count"),
    )


def add_ripple(flights: DataFrame, legs: DataFrame) -> DataFrame:
    """Flights of the live view with their onward legs, ripple score and band."""
    return (
        add_onward_legs(flights, legs)
        .withColumn(
            "res",
            ripple.ripple_score(
                F.col("next_flight_gap_min"),
                F.col("downstream_flight_count"),
                F.col("destination"),
                F.col("predicted_delay_minutes"),
                F.col("hour_utc"),
                F.col("fdi"),
            ),
        )
        .withColumn("res_category", bands.score_band(F.col("res")))
    )


def next_flight_records(
    flights: DataFrame, columns, horizon_s: int = K.ROTATION_HORIZON_S
) -> DataFrame:
    """Every flight that has a next flight on the same aircraft, beside that flight's record.

    The self-join is on the id of the next flight, one row per flight, instead of all later
    flights of the aircraft.
    """
    legs = onward_legs(rotations(flights), horizon_s).filter(
        F.col("next_flight_id").isNotNull()
    )
    here = (
        flights.select("flight_id", *KEY)
        .join(legs, list(KEY))
        .select("flight_id", *KEY, "next_flight_id", "next_timestamp", "downstream_count")
    )
    following = flights.select(
        F.col("flight_id").alias("next_flight_id"),
        *[F.col(c).alias(f"next_{c}") for c in columns],
    )
    return here.join(following, "next_flight_id").select(
        "flight_id", *KEY, "next_flight_id", "next_timestamp", "downstream_count",
        *[f"next_{c}" for c in columns],
    )
