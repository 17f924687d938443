"""Raw feed snapshots: one JSON object per message, flight id -> positional array."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tailwake import schemas as S

# --- fixed values: keys that are not flights, and the slots of a flight array ---
METADATA_KEYS = ("full_count", "version")
MIN_SLOTS = 17
SLOT = {
    "latitude": 1,
    "longitude": 2,
    "heading_deg": 3,
    "altitude_ft": 4,
    "speed_kn": 5,
    "aircraft_model": 8,
    "registration": 9,
    "timestamp": 10,
    "origin": 11,
    "destination": 12,
    "flight_number": 13,
    "on_ground": 14,
    "callsign": 16,
    "airline_icao": 18,
}


def _slot(name: str, dtype: str) -> Column:
    return F.try_variant_get("slots", f"$[{SLOT[name]}]", dtype)


def _has(slot: int) -> Column:
    """Whether an array reaches that far; a JSON null in the slot counts as there."""
    return F.try_variant_get("slots", f"$[{slot}]", "variant").isNotNull()


def _text(*names: str) -> Column:
    """First slot with non-empty text, else an empty string."""
    filled = [F.nullif(_slot(name, "string"), F.lit("")) for name in names]
    return F.coalesce(*filled, F.lit(""))


def _whole(name: str) -> Column:
    """Integer slot: a number loses its fraction, text must already be a whole number."""
    return _slot(name, "int")


def _truthy(name: str) -> Column:
    """Zero, null and empty text are false, everything else is true."""
    kind = F.schema_of_variant(F.try_variant_get("slots", f"$[{SLOT[name]}]", "variant"))
    as_text = _slot(name, "string") != ""
    return F.coalesce(F.when(kind == "STRING", as_text).otherwise(_slot(name, "boolean")), F.lit(False))


def normalize_feed(snapshots: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """Airborne flights of the snapshots as reports, one row per flight and snapshot.

    ``snapshots`` has the JSON text in ``value``. Metadata keys, values that are not arrays,
    arrays that are too short, rows with an unreadable position, height, speed or heading, and
    aircraft on the ground are dropped. ``ingested_at`` defaults to the current time. The slots are
    unpacked by a generator of one row, so that the filters on them do not unpack them again.
    """
    if ingested_at is None:
        now = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())
        ingested_at = F.concat(F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z"))
    entries = snapshots.select(
        ingested_at.alias("ingested_at"),
        F.explode(F.from_json(F.col("value").cast("string"), "map<string, variant>")).alias(
            "flight_id", "slots"
        ),
    )
    airline = F.when(_has(SLOT["airline_icao"]), _slot("airline_icao", "string")).otherwise("")
    fields = F.struct(
        _text("callsign", "flight_number").alias("callsign"),
        airline.alias("airline_icao"),
        *[_text(n).alias(n) for n in ("aircraft_model", "registration", "origin", "destination")],
        _slot("latitude", "double").alias("latitude"),
        _slot("longitude", "double").alias("longitude"),
        *[_whole(n).alias(n) for n in ("altitude_ft", "speed_kn", "heading_deg")],
        _truthy("on_ground").alias("on_ground"),
        _slot("timestamp", "bigint").alias("timestamp"),
    )
    flights = entries.filter(
        ~F.col("flight_id").isin(*METADATA_KEYS) & _has(MIN_SLOTS - 1)
    ).select("flight_id", "ingested_at", F.inline(F.array(fields)))
    readable = ("latitude", "longitude", "altitude_ft", "speed_kn", "heading_deg")
    return flights.dropna(subset=list(readable)).filter(~F.col("on_ground")).select(
        *S.REPORT_COLUMNS
    )
