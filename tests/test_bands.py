"""Values at, just below and just above each threshold, and null."""

import pytest
from pyspark.sql import functions as F

from tailwake.functions import (
    airline, bands, display, flight, impact, parse, ripple, timing, weather,
)


def check(spark, function, cases, dtype):
    """``cases``: input -> expected, one Spark job for all."""
    rows = [(n, value) for n, (value, _) in enumerate(cases)]
    frame = spark.createDataFrame(rows, f"n int, v {dtype}")
    got = {r.n: r.out for r in frame.select("n", function(F.col("v")).alias("out")).collect()}
    assert [(cases[n][0], got[n]) for n in sorted(got)] == [(v, want) for v, want in cases]


C = F.lit
CASES = {
    "rain": (weather.is_raining, "float", [(0.5, 0), (0.51, 1), (None, None)]),
    "wind": (weather.is_high_wind, "float", [(25.0, 0), (25.1, 1)]),
    "sight": (weather.is_low_visibility, "float", [(2999.0, 1), (3000.0, 0)]),
    "bad weather": (weather.is_bad_weather, "int", [(59, 0), (60, 1), (99, 1), (100, 0)]),
    "bucket": (
        weather.weather_bucket, "double",
        [(0.19, "CLEAR"), (0.2, "MODERATE"), (0.49, "MODERATE"), (0.5, "SEVERE"), (None, "SEVERE")],
    ),
    "condition": (
        weather.weather_condition, "int",
        [(1, "CLEAR"), (3, "PARTLY CLOUDY"), (45, "CLOUDY"), (51, "RAIN"), (69, "RAIN"),
         (70, "CLOUDY"), (71, "SNOW"), (79, "SNOW"), (80, "STORM"), (99, "STORM"), (100, "CLOUDY")],
    ),
    "deviation wind": (
        lambda v: weather.route_deviation(v, C(0)), "double", [(30.0, 3.0), (31.0, pytest.approx(9.3))],
    ),
    "deviation code": (
        lambda v: weather.route_deviation(C(0.0), v), "int", [(59, 0.0), (60, 5.0)],
    ),
    "phase": (
        flight.flight_phase, "int",
        [(14999, 0), (15000, 1), (34999, 1), (35000, 2), (None, 2)],
    ),
    "slow": (flight.is_slow, "int", [(199, 1), (200, 0)]),
    "ratio": (
        lambda v: flight.speed_altitude_ratio(C(100), v), "int", [(0, 0.0), (1000, 100.0), (-5, 0.0)],
    ),
    "distance": (
        lambda v: flight.distance_km(C(100), v), "int",
        [(20000, pytest.approx(185.2)), (20001, pytest.approx(370.4)),
         (30000, pytest.approx(370.4)), (30001, pytest.approx(648.2))],
    ),
    "category": (
        flight.delay_category, "double",
        [(14.9, "ON TIME"), (15.0, "MEDIUM DELAY"), (60.0, "MEDIUM DELAY"),
         (60.1, "CRITICAL DELAY"), (None, "CRITICAL DELAY"), (-10.0, "ON TIME")],
    ),
    "delayed": (
        flight.is_delayed, "string",
        [("ON TIME", False), ("MEDIUM DELAY", True), ("CRITICAL DELAY", True)],
    ),
    "delayed served": (
        flight.is_delayed_served, "string",
        [("ON TIME", False), ("", False), (None, False), ("UNKNOWN", False), ("MEDIUM DELAY", True)],
    ),
    "rule delay": (flight.rule_delay, "double", [(0.0, 0.0), (12.5, 75.0), (0.5, 3.0)]),
    "peak": (
        timing.is_peak_hour, "int",
        [(5, 0), (6, 1), (9, 1), (10, 0), (16, 0), (17, 1), (20, 1), (21, 0)],
    ),
    "weekend": (timing.is_weekend, "int", [(1, 1), (2, 0), (6, 0), (7, 1)]),
    "traffic weekday": (
        lambda v: timing.traffic_density(v, C(2)), "int",
        [(5, 4), (6, 9), (9, 9), (10, 7), (16, 7), (17, 10), (20, 10), (21, 4)],
    ),
    "traffic weekend": (lambda v: timing.traffic_density(C(12), v), "int", [(1, 6), (7, 6), (6, 7)]),
    "hour": (timing.hour_utc, "bigint", [(0, 0), (3599, 0), (3600, 1), (86399, 23), (-1, 23)]),
    "weekday": (timing.day_of_week, "bigint", [(0, 5), (86400 * 3, 1), (86400 * 2, 7), (-1, 4)]),
    "iso": (timing.iso_utc, "bigint", [(1704067207, "2024-01-01T00:00:07Z")]),
    "capacity": (
        impact.capacity, "string", [("B744", 416), ("CRJ9", 90), ("ZZZZ", 180), (None, 180)],
    ),
    "passengers": (impact.affected_passengers, "int", [(150, 128), (250, 213), (220, 187)]),
    "normalized": (
        impact.normalized_delay, "double", [(-18.0, pytest.approx(-0.1)), (180.0, 1.0), (900.0, 1.0), (None, 1.0)],
    ),
    "compensation delay": (
        lambda v: impact.compensation_eur(v, C(1000.0), C(100)), "double",
        [(179.9, 0), (180.0, 25000)],
    ),
    "compensation distance": (
        lambda v: impact.compensation_eur(C(200.0), v, C(100)), "double",
        [(1499.0, 25000), (1500.0, 40000), (3499.0, 40000), (3500.0, 60000)],
    ),
    "score band": (
        bands.score_band, "double",
        [(25.0, "LOW"), (25.1, "MODERATE"), (50.0, "MODERATE"), (50.1, "HIGH"), (75.0, "HIGH"),
         (75.1, "CRITICAL")],
    ),
    "rotation gap": (
        ripple.rotation_factor, "int",
        [(None, 0.0), (0, 100.0), (59, 100.0), (60, 75.0), (119, 75.0), (120, 50.0), (179, 50.0),
         (180, 25.0), (299, 25.0), (300, 10.0)],
    ),
    "downstream": (
        ripple.downstream_factor, "int",
        [(0, 0.0), (1, 33.0), (2, 33.0), (3, 66.0), (4, 66.0), (5, 100.0), (9, 100.0)],
    ),
    "hub": (ripple.hub_factor, "string", [("SIN", 100.0), ("CAN", 30.0), ("", 30.0), (None, 30.0)]),
    "delay factor": (ripple.delay_factor, "double", [(120.0, 100.0), (500.0, 100.0), (-12.0, -10.0)]),
    "recovery": (
        ripple.recovery_factor, "int",
        [(0, 100.0), (5, 100.0), (6, 75.0), (9, 75.0), (10, 25.0), (16, 25.0), (17, 75.0),
         (20, 75.0), (21, 50.0), (23, 50.0)],
    ),
    "airline band": (
        airline.performance_band, "double",
        [(80.0, "EXCELLENT"), (79.9, "GOOD"), (60.0, "GOOD"), (59.9, "FAIR"), (40.0, "FAIR"), (39.9, "POOR")],
    ),
    "severity": (
        display.fdi_severity, "double", [(30.0, "RED"), (29.9, "AMBER"), (15.0, "AMBER"), (14.9, "NONE"), (None, "NONE")],
    ),
    "advice": (
        display.ripple_advice, "string",
        [("CRITICAL", "SPREADS"), ("HIGH", "SPREADS"), ("MODERATE", "MAY SPREAD"), ("LOW", "SAFE"), (None, "SAFE")],
    ),
    "to double": (
        parse.to_double, "string",
        [("1.5", 1.5), (" 2 ", 2.0), ("1e3", 1000.0), ("", 0.0), ("x", 0.0), (None, 0.0), ("7d", 0.0), ("7.f", 0.0)],
    ),
    "to int": (
        parse.to_int, "string", [("3.9", 3), ("-3.9", -3), ("NaN", 0), ("1e99", 0), ("12", 12), (None, 0)],
    ),
    "first nonzero": (
        lambda v: display.first_nonzero(v, C(7)), "int", [(5, 5), (0, 7), (None, 7)],
    ),
}


@pytest.mark.parametrize("name", sorted(CASES))
def test_bands(spark, name):
    function, dtype, cases = CASES[name]
    check(spark, function, cases, dtype)


def test_clean_limits(spark):
    from tailwake import schemas as S
    from tailwake.operators.reports import clean_reports

    good = dict(
        flight_id="F", latitude=1.0, longitude=2.0, on_ground=False,
        altitude_ft=1000, speed_kn=50, heading_deg=0,
    )
    kept = [
        {}, {"altitude_ft": 60000}, {"speed_kn": 700}, {"heading_deg": 360}, {"airline_icao": ""},
    ]
    dropped = [
        {"flight_id": None}, {"latitude": None}, {"longitude": None}, {"on_ground": True},
        {"on_ground": None}, {"altitude_ft": 999}, {"altitude_ft": 60001}, {"altitude_ft": None},
        {"speed_kn": 49}, {"speed_kn": 701}, {"speed_kn": None},
        {"heading_deg": -1}, {"heading_deg": 361}, {"heading_deg": None},
    ]
    names = S.BRONZE_COLUMNS
    types = {**{f.name: f.dataType.simpleString() for f in S.REPORT}, **{f.name: f.dataType.simpleString() for f in S.WEATHER}}
    ddl = ", ".join(f"`{n}` {types[n]}" for n in names)
    rows = [tuple({**good, **change}.get(n) for n in names) for change in kept + dropped]
    clean = clean_reports(spark.createDataFrame(rows, ddl)).collect()
    assert len(clean) == len(kept)
    assert {r.airline_icao for r in clean} == {"UNKNOWN", ""}
    assert {(r.precipitation_mm, r.wind_knots, r.visibility_m, r.weather_code) for r in clean} == {
        (0.0, 0.0, 10000.0, 0)
    }
