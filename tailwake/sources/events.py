"""Position reports, weather readings, messages and feed snapshots derived from an event log.

The event log has ``event_id, ts (timestamp_ntz), user_id, event_type, value, props``; a user
stands for an aircraft and a six-hour block of its events for a flight. Integer and simple double
arithmetic only, so any SQL engine can derive the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tailwake import schemas as S

# --- fixed values: the codes the derivation draws from ---
AIRLINES = ("GIA", "LNI", "BTK", "SJY", "CTV", "IDX", "AWQ", "TGN", "NAM", "AXM")
MODELS = (
    "A20N", "A21N", "A320", "A333", "B738", "B739", "B77W", "B788", "CRJ9", "E190", "ZZZZ", "A359",
)
AIRPORTS = (
    "CGK", "DPS", "SUB", "KNO", "UPG", "BPN", "SIN", "KUL", "PKY", "SRG", "BDO", "LHR",
)
WEATHER_CODES = ("00", "01", "02", "03", "45", "51", "61", "63", "80", "95")
BLOCK_S = 21600

EVENTS_SCHEMA = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
    "props string"
)


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def read_event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same log as a file stream."""
    return (
        spark.readStream.schema(EVENTS_SCHEMA)
        .option("pathGlobFilter", "events.parquet")
        .option("recursiveFileLookup", "true")
        .parquet(sf_dir)
    )


def _pick(codes, index: Column) -> Column:
    """The code at an index, cut from one literal of all the (equally long) codes."""
    width = len(codes[0])
    return F.substring(F.lit("".join(codes)), index.cast("int") * width + 1, F.lit(width))


def _every(n: int) -> Column:
    return F.col("event_id") % n == 0


def _epoch_s(ts: Column) -> Column:
    days = F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")).cast("long")
    return days * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def _keyed(events: DataFrame) -> DataFrame:
    return events.select(
        "event_id",
        "user_id",
        "event_type",
        "value",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        _epoch_s(F.col("ts")).alias("timestamp"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("ingested_at"),
    ).withColumn("block", F.floor(F.col("timestamp") / F.lit(BLOCK_S)))


def _position() -> dict[str, Column]:
    event_id = F.col("event_id")
    return {
        "latitude": (event_id * 37 % 1700) / F.lit(100.0) - 11,
        "longitude": (event_id * 53 % 4600) / F.lit(100.0) + 95,
    }


def _weather() -> dict[str, Column]:
    event_id, k = F.col("event_id"), F.col("k")
    no_rain_gauge = (F.col("event_type") == "error") & (k % 10 == 0)
    return {
        "precipitation_mm": F.when(~no_rain_gauge, k * 6 / F.lit(10.0)).cast("float"),
        "wind_knots": (event_id * 13 % 700 / F.lit(10.0)).cast("float"),
        "visibility_m": (event_id * 29 % 16000).cast("float"),
        "weather_code": _pick(WEATHER_CODES, k % 10).cast("int"),
    }


def flight_reports(events: DataFrame) -> DataFrame:
    """Flattened reports plus ``given_delay`` (the observed delay, used as label and override)."""
    event_id, user, block, k = (F.col(c) for c in ("event_id", "user_id", "block", "k"))
    airline = F.when(_every(53), None).when(_every(59), "").otherwise(_pick(AIRLINES, user % 10))
    place = _position()
    return (
        _keyed(events)
        .withColumn("airline_icao", airline)
        .select(
            F.concat(F.lit("F"), user, F.lit("-"), block).alias("flight_id"),
            F.concat(F.coalesce("airline_icao", F.lit("")), k).alias("callsign"),
            "airline_icao",
            F.when(~_every(61), _pick(MODELS, user * 7 % 12)).alias("aircraft_model"),
            F.when(_every(41), "")
            .otherwise(F.concat(F.lit("PK-"), F.lpad(user.cast("string"), 5, "0")))
            .alias("registration"),
            F.when(_every(67), "")
            .when(_every(71), None)
            .otherwise(_pick(AIRPORTS, (user + block) % 12))
            .alias("origin"),
            F.when(~_every(73), _pick(AIRPORTS, (user + block * 5 + 3) % 12)).alias("destination"),
            F.when(~_every(101), place["latitude"]).alias("latitude"),
            place["longitude"].alias("longitude"),
            (event_id * 7919 % 62000).cast("int").alias("altitude_ft"),
            (event_id * 7877 % 760).cast("int").alias("speed_kn"),
            (event_id * 31 % 366).cast("int").alias("heading_deg"),
            F.when(~_every(97), _every(20)).alias("on_ground"),
            "timestamp",
            "ingested_at",
            *[column.alias(name) for name, column in _weather().items()],
            (F.floor(F.col("value") * 6) / F.lit(10.0) - 10).cast("float").alias("given_delay"),
        )
    )


def weather_readings(events: DataFrame) -> DataFrame:
    """One reading per event, taken up to an hour before it at the event's grid cell."""
    place = _position()
    fallback = F.col("event_id") % 4 == 3
    return _keyed(events).select(
        F.bround(place["latitude"]).cast("int").alias("cell_lat"),
        F.bround(place["longitude"]).cast("int").alias("cell_lon"),
        (F.col("timestamp") - F.col("event_id") * 97 % 3600).alias("observed_at"),
        F.when(fallback, "fallback").otherwise("primary").alias("source"),
        F.when(fallback, "kmh").otherwise("kn").alias("wind_unit"),
        *[
            column.alias("wind_speed" if name == "wind_knots" else name)
            for name, column in _weather().items()
        ],
    )


def messages(events: DataFrame) -> DataFrame:
    """Envelopes (key, value, timestamp) with the reports as JSON; some values are not JSON."""
    reports = flight_reports(events)
    body = F.to_json(F.struct(*S.REPORT_COLUMNS, F.struct(*S.WEATHER_COLUMNS).alias("weather")))
    broken = F.col("timestamp") % 89 == 0
    return reports.select(
        F.col("flight_id").alias("key"),
        F.when(broken, "not-json").otherwise(body).alias("value"),
        F.timestamp_seconds("timestamp").alias("timestamp"),
    )


def feed_snapshots(events: DataFrame) -> DataFrame:
    """Feed snapshots, one per event: a flight array among metadata keys, some malformed."""
    event_id = F.col("event_id")
    place = _position()
    flight_id = F.concat(F.lit("F"), F.col("user_id"), F.lit("-"), event_id)

    def quoted(column: Column) -> Column:
        return F.concat(F.lit('"'), column, F.lit('"'))

    airline = _pick(AIRLINES, F.col("user_id") % 10)
    slots = [
        quoted(F.lit("x")),
        F.when(event_id % 31 == 0, quoted(F.lit("?"))).otherwise(place["latitude"].cast("string")),
        place["longitude"].cast("string"),
        (event_id * 31 % 366).cast("string"),
        F.when(event_id % 37 == 0, F.lit("null")).otherwise(
            (event_id * 7919 % 62000).cast("string")
        ),
        (event_id * 7877 % 760).cast("string"),
        quoted(F.lit("0000")),
        quoted(F.lit("radar")),
        F.when(event_id % 61 == 0, F.lit("null")).otherwise(
            quoted(_pick(MODELS, F.col("user_id") * 7 % 12))
        ),
        quoted(F.concat(F.lit("PK-"), F.lpad(F.col("user_id").cast("string"), 5, "0"))),
        F.col("timestamp").cast("string"),
        quoted(_pick(AIRPORTS, F.col("user_id") % 12)),
        quoted(_pick(AIRPORTS, (F.col("user_id") + 5) % 12)),
        quoted(F.concat(F.lit("N"), F.col("k"))),
        F.when(event_id % 20 == 0, "1").otherwise("0"),
        F.lit("0"),
        F.when(event_id % 7 == 0, quoted(F.lit(""))).otherwise(quoted(F.concat(airline, F.col("k")))),
    ]
    full = F.concat_ws(",", *slots, F.lit("0"), quoted(airline))
    entry = (
        F.when(event_id % 43 == 0, F.lit('"gone"'))
        .when(event_id % 47 == 0, F.lit("[1,2]"))
        .when(event_id % 11 == 0, F.concat(F.lit("["), F.concat_ws(",", *slots), F.lit("]")))
        .otherwise(F.concat(F.lit("["), full, F.lit("]")))
    )
    return _keyed(events).select(
        F.concat(
            F.lit('{"full_count":1,"version":4,"'), flight_id, F.lit('":'), entry, F.lit("}")
        ).alias("value"),
        "ingested_at",
    )
