"""Track heading of a flight from its successive positions.

A move of more than 0.0001 degrees on either axis gives a new heading, otherwise the last one is
kept; the first fix has none. Fixes are worked on in (flight, time slice) groups, which after
folding fixes of the same second hold at most one row per second of the slice. What crosses a
slice edge (last position, last heading) is carried over one summary row per slice, so a flight
id that holds a large share of all rows is still spread over its slices.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tailwake.functions import timing

MIN_MOVE_DEG = 0.0001
GROUP = ("flight_id", "slice")


def bearing(before: Column, after: Column) -> Column:
    """Degrees from north (-180 to 180), null when there is no move to speak of."""
    north, east = after["lat"] - before["lat"], after["lon"] - before["lon"]
    moved = (F.abs(north) > MIN_MOVE_DEG) | (F.abs(east) > MIN_MOVE_DEG)
    return F.when(moved, F.degrees(F.atan2(east, north)))


def track_heading(reports: DataFrame, slice_s: int = 21600) -> DataFrame:
    """(flight_id, timestamp, lat, lon, heading), one row per flight and second."""
    fix = F.struct(
        "ingested_at", F.col("latitude").alias("lat"), F.col("longitude").alias("lon")
    )
    in_slice = Window.partitionBy(*GROUP).orderBy("timestamp")
    # Nulls are filtered here column by column, and the edges joined from the left below: no join
    # adds a null filter of its own then, and both uses of the moves share one scan and shuffle.
    needed = ("flight_id", "timestamp", "latitude", "longitude")
    moves = (
        reports.filter(reduce(and_, [F.col(c).isNotNull() for c in needed]))
        .groupBy("flight_id", "timestamp")
        .agg(F.max(fix).alias("at"))
        .withColumn("slice", timing.slice_of(F.col("timestamp"), slice_s))
        .withColumn("before", F.lag("at").over(in_slice))
        .withColumn("move", bearing(F.col("before"), F.col("at")))
    )
    edges = (
        moves.groupBy(*GROUP)
        .agg(
            F.min_by("at", "timestamp").alias("first"),
            F.max_by("at", "timestamp").alias("last"),
            F.max_by(
                "move", F.when(F.col("move").isNotNull(), F.col("timestamp"))
            ).alias("last_move"),
        )
    )
    by_slice = Window.partitionBy("flight_id").orderBy("slice")
    earlier = by_slice.rowsBetween(Window.unboundedPreceding, -1)
    entering = edges.withColumn("before", F.lag("last").over(by_slice)).withColumn(
        "entry_move", bearing(F.col("before"), F.col("first"))
    ).select(
        *GROUP,
        F.coalesce(
            "entry_move",
            F.last(F.coalesce("last_move", "entry_move"), ignorenulls=True).over(earlier),
        ).alias("entry_heading"),
    )
    so_far = in_slice.rowsBetween(Window.unboundedPreceding, 0)
    return (
        moves.withColumn("in_slice", F.last("move", ignorenulls=True).over(so_far))
        .join(entering, list(GROUP), "left")
        .select(
            "flight_id",
            "timestamp",
            F.col("at.lat").alias("lat"),
            F.col("at.lon").alias("lon"),
            F.coalesce("in_slice", "entry_heading").alias("heading"),
        )
    )
