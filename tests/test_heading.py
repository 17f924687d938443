"""Track heading against a plain loop over each flight."""

import math
import random

import pytest

from tailwake.operators.heading import track_heading

SCHEMA = "flight_id string, `timestamp` bigint, ingested_at string, latitude double, longitude double"


def brute_force(rows):
    fixes = {}
    for flight, ts, seen, lat, lon in rows:
        if flight is None or lat is None or lon is None:
            continue
        key = (flight, ts)
        fixes[key] = max(fixes.get(key, ("",)), (seen, lat, lon))
    out, state = {}, {}
    for flight, ts in sorted(fixes):
        _, lat, lon = fixes[flight, ts]
        heading = None
        if flight in state:
            before_lat, before_lon, heading = state[flight]
            north, east = lat - before_lat, lon - before_lon
            if abs(north) > 1e-4 or abs(east) > 1e-4:
                heading = math.degrees(math.atan2(east, north))
        state[flight] = (lat, lon, heading)
        out[flight, ts] = heading
    return out


@pytest.mark.parametrize("slice_s", [5, 60, 100000])
def test_matches_loop(spark, slice_s):
    rng = random.Random(slice_s)
    spots = [0.0, 0.00005, 1.0, 1.5]
    rows = [
        (rng.choice(["HOT", "HOT", "A", "B", None]), rng.randrange(0, 900), f"{i:04d}",
         rng.choice([*spots, None]), rng.choice(spots))
        for i in range(600)
    ]
    got = track_heading(spark.createDataFrame(rows, SCHEMA), slice_s).collect()
    expected = brute_force(rows)
    assert len(got) == len(expected)
    for r in got:
        want = expected[r.flight_id, r.timestamp]
        assert r.heading == (want if want is None else pytest.approx(want))
