"""As-of weather against brute force."""

import random

import pytest

from tailwake.operators.weather_join import attach_weather, flatten_weather

READINGS = (
    "cell_lat int, cell_lon int, observed_at bigint, source string, wind_unit string, "
    "precipitation_mm double, wind_speed double, visibility_m double, weather_code int"
)
REPORTS = "id int, latitude double, longitude double, `timestamp` bigint"


def reading(lat, lon, at, source="primary", code=1, failed=False):
    values = (None, None, None, None) if failed else (0.0, 10.0, 9000.0, code)
    return (lat, lon, at, source, "kn", *values)


def brute_force(reports, readings, ttl, failed_ttl):
    best = {}
    for r in readings:
        key, rank = r[:3], (0 if r[3] == "primary" else 1, r[8] or 0)
        if key not in best or rank < best[key][0]:
            best[key] = (rank, r)
    out = {}
    for ident, lat, lon, ts in reports:
        past = [
            (at, r) for (la, lo, at), (_, r) in best.items()
            if lat is not None and (la, lo) == (round(lat), round(lon)) and at <= ts
        ]
        out[ident] = None
        if past:
            at, newest = max(past, key=lambda p: p[0])
            lifetime = failed_ttl if newest[8] is None else ttl
            if ts - at < lifetime:
                out[ident] = newest[8]
    return out


@pytest.mark.parametrize("seed,slice_s", [(1, 600), (2, 7), (3, 5000)])
def test_matches_brute_force(spark, seed, slice_s):
    rng = random.Random(seed)
    cells = [(0, 0)] * 4 + [(1, 2), (-1, 2), (2, 100)]
    readings = [
        reading(*rng.choice(cells), rng.randrange(0, 3000), rng.choice(["primary", "fallback"]),
                rng.randrange(0, 99), rng.random() < 0.15)
        for _ in range(150)
    ]
    # One reading per source and second: which of two equal ones wins is not the point here.
    readings = list({r[:4]: r for r in readings}.values())
    reports = [
        (i, None if rng.random() < 0.05 else la + rng.uniform(-0.5, 0.5),
         lo + rng.uniform(-0.5, 0.5), rng.randrange(0, 3600))
        for i in range(500)
        for la, lo in [rng.choice(cells)]
    ]
    frame = attach_weather(
        spark.createDataFrame(reports, REPORTS), spark.createDataFrame(readings, READINGS),
        ttl_s=180, failed_ttl_s=30, slice_s=slice_s,
    )
    rows = flatten_weather(frame).collect()
    assert len(rows) == len(reports)
    assert {r.id: r.weather_code for r in rows} == brute_force(reports, readings, 180, 30)


def test_limits_and_priority(spark):
    readings = [
        reading(0, 0, 1000, "fallback", code=5),
        reading(0, 0, 1000, "primary", code=3),
        reading(1, 0, 1000, failed=True),
        reading(2, 0, 1000, code=7),
        reading(2, 0, 1100, failed=True),
    ]
    at = {
        "before": (0.4, 0.0, 999, None), "exact": (0.4, 0.0, 1000, 3), "last": (0.4, 0.0, 2799, 3),
        "expired": (0.4, 0.0, 2800, None), "half to even": (0.5, 0.5, 1000, 3),
        "failed": (1.0, 0.0, 1001, None), "failed newer": (2.0, 0.0, 1150, None),
        "failed expired hides the old one": (2.0, 0.0, 1500, None), "good": (2.0, 0.0, 1099, 7),
    }
    reports = [(n, *row[:3]) for n, row in enumerate(at.values())]
    frame = attach_weather(
        spark.createDataFrame(reports, REPORTS), spark.createDataFrame(readings, READINGS)
    )
    got = {r.id: r.weather and r.weather.weather_code for r in frame.collect()}
    assert got == {n: row[3] for n, row in enumerate(at.values())}


def test_a_reading_is_carried_over_the_edge_of_a_slice(spark):
    readings = [reading(0, 0, 3599, code=4), reading(0, 0, 100, code=2)]
    at = {0: None, 100: 2, 1899: 2, 1900: None, 3598: None, 3599: 4, 3600: 4, 5398: 4, 5399: None, 7200: None}
    reports = [(second, 0.0, 0.0, second) for second in at]
    frame = attach_weather(
        spark.createDataFrame(reports, REPORTS), spark.createDataFrame(readings, READINGS)
    )
    assert {r.id: r.weather and r.weather.weather_code for r in frame.collect()} == at


def test_no_range_predicate(spark):
    """Equality joins only, and reports are compared with nothing else."""
    frame = attach_weather(
        spark.createDataFrame([(1, 0.0, 0.0, 1000)], REPORTS),
        spark.createDataFrame([reading(0, 0, 1000)], READINGS),
    )
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.split("\n") if "Join" in line]
    assert len(joins) == 1 and " < " not in joins[0] and " >= " not in joins[0] and " > " not in joins[0]


def test_many_reports_and_readings_of_one_second(spark):
    readings = [reading(0, 0, 1000, "fallback", code=n) for n in range(1, 40)] + [reading(0, 0, 1000, code=50)]
    reports = [(n, 0.1, 0.1, 1000 + n % 2) for n in range(2000)]
    frame = attach_weather(
        spark.createDataFrame(reports, REPORTS), spark.createDataFrame(readings, READINGS)
    )
    assert {r.weather.weather_code for r in frame.collect()} == {50} and frame.count() == 2000


def test_wind_in_knots(spark):
    kmh = (0, 0, 1000, "fallback", "kmh", 0.0, 18.52, 9000.0, 1)
    frame = attach_weather(
        spark.createDataFrame([(1, 0.0, 0.0, 1000)], REPORTS),
        spark.createDataFrame([kmh], READINGS),
    )
    assert frame.first().weather.wind_knots == pytest.approx(10.0)
