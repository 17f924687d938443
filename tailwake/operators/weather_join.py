"""As-of join of reports with weather readings on a one-degree grid.

The newest reading of a cell holds until the next one, at most half an hour, a failed one (no
values at all) at most five minutes. Reports and readings are folded to one row per cell and second,
and one sorted pass over (cell, slice of time) carries the newest reading on to the seconds that
follow it. One summary row per slice, its last reading, opens the next slice, so a reading is carried
across the edge; slices are as long as the longest validity at least, and no reading reaches further.
The seconds with their weather go back to the reports by an equality join.

A group of the pass holds a row per second of its slice and the carried one, however many reports or
readings share a cell. The join key includes the second, so a busy cell is spread over the tasks;
both sides are plain shuffles, and adaptive execution splits a second that holds many reports.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tailwake import constants as K
from tailwake import schemas as S
from tailwake.functions import timing, weather

CELL = ("cell_lat", "cell_lon")
# --- fixed values: which source wins when both report the same second ---
SOURCE_RANK = {"primary": 0, "fallback": 1}


def grid_cell(coordinate: Column) -> Column:
    """Whole degrees, halves to even."""
    return F.bround(coordinate).cast("int")


def newest_readings(readings: DataFrame) -> DataFrame:
    """One reading per cell and second, as ``reading``: when it was made, whether it failed, weather."""
    rank = F.coalesce(
        *[F.when(F.col("source") == name, n) for name, n in SOURCE_RANK.items()],
        F.lit(len(SOURCE_RANK)),
    )
    values = F.struct(
        F.col("precipitation_mm").cast("float").alias("precipitation_mm"),
        weather.knots(F.col("wind_speed"), F.col("wind_unit")).alias("wind_knots"),
        F.col("visibility_m").cast("float").alias("visibility_m"),
        F.col("weather_code").cast("int").alias("weather_code"),
    )
    best = (
        readings.dropna(subset=[*CELL, "observed_at"])
        .select(*CELL, "observed_at", F.struct(rank.alias("rank"), values.alias("w")).alias("c"))
        .groupBy(*CELL, F.col("observed_at").alias("second"))
        .agg(F.min("c")["w"].alias("weather"))
    )
    failed = F.coalesce(*[F.col("weather")[name].cast("double") for name in S.WEATHER_COLUMNS]).isNull()
    return best.select(
        *CELL, "second", F.struct(F.col("second").alias("at"), failed.alias("failed"), "weather").alias("reading")
    )


def carried_weather(
    seconds: DataFrame, readings: DataFrame, ttl_s: int, failed_ttl_s: int, slice_s: int
) -> DataFrame:
    """``seconds`` (cell, second), each once, with the weather that is valid then, if any."""
    slice_s = max(slice_s, ttl_s, failed_ttl_s)
    known = newest_readings(readings).withColumn("slice", timing.slice_of(F.col("second"), slice_s))
    # The last reading of a slice opens the next; its own second is before all others there.
    opening = known.groupBy(*CELL, "slice").agg(F.max_by("reading", "second").alias("reading"))
    opening = opening.select(
        *CELL, F.col("reading.at").alias("second"), "reading", (F.col("slice") + 1).alias("slice")
    )
    wanted = seconds.select(
        *CELL, "second", timing.slice_of(F.col("second"), slice_s).alias("slice"), F.lit(True).alias("wanted")
    )
    rows = wanted.unionByName(known.unionByName(opening), allowMissingColumns=True)
    # A second with both a reading and reports has two rows; as peers of a range frame they share it.
    upto = Window.partitionBy(*CELL, "slice").orderBy("second")
    swept = rows.withColumn("newest", F.last("reading", ignorenulls=True).over(upto)).filter("wanted")
    held = F.when(F.col("newest.failed"), failed_ttl_s).otherwise(ttl_s)
    valid = F.col("second") < F.col("newest.at") + held
    return swept.filter(valid).select(*CELL, "second", F.col("newest.weather").alias("weather"))


def attach_weather(
    reports: DataFrame,
    readings: DataFrame,
    ttl_s: int = K.WEATHER_TTL_S,
    failed_ttl_s: int = K.FAILED_WEATHER_TTL_S,
    slice_s: int = 3600,
) -> DataFrame:
    """Reports with a ``weather`` struct; null where no reading is valid at their time."""
    located = reports.withColumns(
        {"cell_lat": grid_cell(F.col("latitude")), "cell_lon": grid_cell(F.col("longitude"))}
    )
    seconds = (
        located.select(*CELL, F.col("timestamp").alias("second"))
        .dropna()
        .distinct()
    )
    found = carried_weather(seconds, readings, ttl_s, failed_ttl_s, slice_s)
    r, w = located.alias("r"), found.alias("w")
    same = [F.col(f"r.{c}") == F.col(f"w.{c}") for c in CELL] + [F.col("r.timestamp") == F.col("w.second")]
    return r.join(w, same, "left").select(
        *[F.col(f"r.{c}") for c in reports.columns], F.col("w.weather").alias("weather")
    )


def flatten_weather(reports: DataFrame) -> DataFrame:
    """The ``weather`` struct as four columns."""
    return reports.select(
        *[c for c in reports.columns if c != "weather"],
        *[F.col("weather")[name].alias(name) for name in S.WEATHER_COLUMNS],
    )
