"""Declared schemas and column lists of the lake layers and the live view."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: fields of the messages and columns of the lake tables, in their order ---

WEATHER_COLUMNS = ("precipitation_mm", "wind_knots", "visibility_m", "weather_code")

WEATHER = T.StructType(
    [
        T.StructField("precipitation_mm", T.FloatType()),
        T.StructField("wind_knots", T.FloatType()),
        T.StructField("visibility_m", T.FloatType()),
        T.StructField("weather_code", T.IntegerType()),
    ]
)

REPORT = T.StructType(
    [
        T.StructField("flight_id", T.StringType()),
        T.StructField("callsign", T.StringType()),
        T.StructField("airline_icao", T.StringType()),
        T.StructField("aircraft_model", T.StringType()),
        T.StructField("registration", T.StringType()),
        T.StructField("origin", T.StringType()),
        T.StructField("destination", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("altitude_ft", T.IntegerType()),
        T.StructField("speed_kn", T.IntegerType()),
        T.StructField("heading_deg", T.IntegerType()),
        T.StructField("on_ground", T.BooleanType()),
        T.StructField("timestamp", T.LongType()),
        T.StructField("ingested_at", T.StringType()),
    ]
)

EVENT = T.StructType(list(REPORT.fields)).add("weather", WEATHER)

ENVELOPE = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

REPORT_COLUMNS = tuple(REPORT.names)

BRONZE_COLUMNS = REPORT_COLUMNS + WEATHER_COLUMNS

SILVER_COLUMNS = (
    "flight_id", "callsign", "airline_icao", "aircraft_model", "registration",
    "origin", "destination", "latitude", "longitude", "altitude_ft", "speed_kn",
    "predicted_delay_minutes", "delay_category", "spatial_cluster",
    "capacity", "affected_passengers", "fdi", "fdi_category", "estimated_compensation_eur",
    "weather_score", "traffic_density", "distance_km", "route_deviation",
    "precipitation_mm", "wind_knots", "visibility_m", "weather_code",
    "timestamp", "hour_utc", "flight_phase", "ingested_at",
)

PAYLOAD_COLUMNS = tuple(name for name in SILVER_COLUMNS if name != "visibility_m")

CONSOLE_COLUMNS = (
    "flight_id", "callsign", "airline_icao", "origin", "destination", "altitude_ft", "speed_kn",
    "predicted_delay_minutes", "delay_category", "spatial_cluster", "fdi", "fdi_category",
    "affected_passengers", "estimated_compensation_eur",
)

# Live view: column -> source column in the enriched reports.
LIVE_COLUMNS = {
    "flight_id": "flight_id",
    "callsign": "callsign",
    "airline": "airline_icao",
    "aircraft": "aircraft_model",
    "registration": "registration",
    "origin": "origin",
    "destination": "destination",
    "lat": "latitude",
    "lon": "longitude",
    "altitude_ft": "altitude_ft",
    "speed_kn": "speed_kn",
    "precip_mm": "precipitation_mm",
    "wind_knots": "wind_knots",
    "visibility_m": "visibility_m",
    "weather_score": "weather_score",
    "traffic_density": "traffic_density",
    "distance_km": "distance_km",
    "route_deviation": "route_deviation",
    "predicted_delay_minutes": "predicted_delay_minutes",
    "delay_category": "delay_category",
    "spatial_cluster": "spatial_cluster",
    "capacity": "capacity",
    "affected_passengers": "affected_passengers",
    "fdi": "fdi",
    "fdi_category": "fdi_category",
    "estimated_compensation_eur": "estimated_compensation_eur",
    "risk_score": "risk_score_manual",
    "hour_utc": "hour_utc",
    "flight_phase": "flight_phase",
    "timestamp": "timestamp",
    "updated_at": "ingested_at",
}

# Columns the enriched reports need to feed silver, the payload and the live view.
ENRICHED_COLUMNS = SILVER_COLUMNS + ("heading_deg", "risk_score_manual")

TRAINING = T.StructType(
    [
        T.StructField("aircraft_model", T.StringType(), False),
        T.StructField("airline_icao", T.StringType(), False),
        T.StructField("precipitation_mm", T.FloatType(), False),
        T.StructField("wind_knots", T.FloatType(), False),
        T.StructField("visibility_m", T.FloatType(), False),
        T.StructField("weather_code", T.IntegerType(), False),
        T.StructField("altitude_ft", T.IntegerType(), False),
        T.StructField("speed_kn", T.IntegerType(), False),
        T.StructField("heading_deg", T.IntegerType(), False),
        T.StructField("hour_utc", T.IntegerType(), False),
        T.StructField("day_of_week", T.IntegerType(), False),
        T.StructField("weather_score", T.FloatType(), False),
        T.StructField("traffic_density", T.IntegerType(), False),
        T.StructField("distance_km", T.FloatType(), False),
        T.StructField("route_deviation", T.FloatType(), False),
        T.StructField("delay_minutes", T.FloatType(), False),
        T.StructField("latitude", T.FloatType(), False),
        T.StructField("longitude", T.FloatType(), False),
    ]
)
