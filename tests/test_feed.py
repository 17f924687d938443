"""Hand-written feed snapshots."""

import json

from pyspark.sql import functions as F

from tailwake.sources.feed import normalize_feed


def flight(**changes):
    slots = [
        "hex", 1.5, 103.25, 90, 31000, 450, "7000", "radar", "A320", "PK-ABC", 1704067200,
        "CGK", "SIN", "GA123", 0, 0, "GIA123", 0, "GIA",
    ]
    for slot, value in changes.items():
        slots[int(slot[1:])] = value
    return slots


CASES = {
    "plain": flight(),
    "short": [1, 2],
    "sixteen": flight()[:16],
    "seventeen": flight()[:17],
    "text": "gone",
    "object": {"a": 1},
    "bad-lat": flight(s1="north"),
    "text-lat": flight(s1="1.5"),
    "null-alt": flight(s4=None),
    "fraction": flight(s4=31000.9, s5="450"),
    "text-fraction": flight(s5="450.5"),
    "ground": flight(s14=1),
    "ground-text": flight(s14="yes"),
    "airborne-null": flight(s14=None),
    "no-callsign": flight(s16=""),
    "null-callsign": flight(s16=None, s13=None),
    "null-model": flight(s8=None, s11=None),
    "null-airline": flight(s18=None),
}


def test_cases(spark):
    snapshot = json.dumps({"full_count": 9, "version": 4, **CASES})
    frame = spark.createDataFrame([(snapshot,), ("not json",), ("[]",), (None,)], "value string")
    rows = {r.flight_id: r for r in normalize_feed(frame, F.lit("now")).collect()}
    assert set(rows) == {
        "plain", "seventeen", "text-lat", "fraction", "airborne-null", "no-callsign",
        "null-callsign", "null-model", "null-airline",
    }
    plain = rows["plain"]
    assert (plain.callsign, plain.airline_icao, plain.aircraft_model) == ("GIA123", "GIA", "A320")
    assert (plain.latitude, plain.longitude, plain.heading_deg) == (1.5, 103.25, 90)
    assert (plain.altitude_ft, plain.speed_kn, plain.timestamp) == (31000, 450, 1704067200)
    assert (plain.origin, plain.destination, plain.registration) == ("CGK", "SIN", "PK-ABC")
    assert (plain.on_ground, plain.ingested_at) == (False, "now")
    assert rows["seventeen"].airline_icao == ""
    assert rows["text-lat"].latitude == 1.5
    assert (rows["fraction"].altitude_ft, rows["fraction"].speed_kn) == (31000, 450)
    assert rows["no-callsign"].callsign == "GA123"
    assert rows["null-callsign"].callsign == ""
    assert (rows["null-model"].aircraft_model, rows["null-model"].origin) == ("", "")
    assert rows["null-airline"].airline_icao is None


def test_default_stamp_is_iso_utc(spark):
    frame = spark.createDataFrame([(json.dumps({"f": flight()}),)], "value string")
    stamp = normalize_feed(frame).first().ingested_at
    assert len(stamp) == 27 and stamp[10] == "T" and stamp.endswith("Z")
