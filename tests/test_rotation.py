"""Onward legs against brute force, with busy aircraft, shared seconds and slice edges."""

import random

import pytest
from pyspark.sql import functions as F

from tailwake.operators import rotation

SCHEMA = "registration string, flight_id string, `timestamp` bigint"


def brute_force(flights, horizon):
    """{(registration, timestamp): (count, next timestamp, next id)} for known aircraft."""
    out = {}
    for reg, _, ts in flights:
        if not reg:
            continue
        later = sorted((t, f) for r, f, t in flights if r == reg and ts < t <= ts + horizon)
        out[reg, ts] = (len(later), *(later[0] if later else (None, None)))
    return out


def random_flights(seed, n=400, span=4000):
    rng = random.Random(seed)
    regs = ["HOT"] * 5 + ["A", "B", "C", "", None]
    return [(rng.choice(regs), f"F{i}", rng.randrange(1, span)) for i in range(n)]


@pytest.mark.parametrize("seed,horizon", [(1, 100), (2, 1), (3, 999), (4, 10000)])
def test_legs_match_brute_force(spark, seed, horizon):
    flights = random_flights(seed)
    frame = spark.createDataFrame(flights, SCHEMA)
    legs = rotation.onward_legs(rotation.rotation_index(frame), horizon).collect()
    got = {
        (r.registration, r.timestamp): (r.downstream_count, r.next_timestamp, r.next_flight_id)
        for r in legs
    }
    assert len(legs) == len(got)
    assert got == brute_force(flights, horizon)


def test_horizon_is_inclusive(spark):
    flights = [("A", "F1", 100), ("A", "F2", 200), ("A", "F3", 201)]
    legs = rotation.onward_legs(spark.createDataFrame(flights, SCHEMA), 100)
    got = {r.timestamp: (r.downstream_count, r.next_flight_id) for r in legs.collect()}
    assert got == {100: (1, "F2"), 200: (1, "F3"), 201: (0, None)}


def test_many_onward_flights(spark):
    flights = [("A", f"F{i}", 1000 + 3600 * i) for i in range(8)]
    frame = spark.createDataFrame(flights, SCHEMA)
    counts = rotation.add_onward_legs(frame, rotation.onward_legs(frame)).orderBy("timestamp")
    assert [r.downstream_flight_count for r in counts.collect()] == [7, 6, 5, 4, 3, 2, 1, 0]
    assert counts.first().next_flight_gap_min == 60


def test_all_flights_are_kept_and_blanks_have_no_legs(spark):
    flights = random_flights(9)
    frame = spark.createDataFrame(flights, SCHEMA)
    joined = rotation.add_onward_legs(frame, rotation.onward_legs(rotation.rotations(frame)))
    assert joined.count() == len(flights)
    blank = joined.filter("registration IS NULL OR registration = ''").agg(
        F.max("downstream_flight_count").alias("n"), F.count("next_flight_id").alias("ids")
    )
    assert tuple(blank.first()) == (0, 0)


def test_without_timestamps_nothing_is_downstream(spark):
    frame = spark.createDataFrame([("A", "F1", 0), ("A", "F2", None)], SCHEMA)
    assert rotation.onward_legs(rotation.rotations(frame)).count() == 0


def test_index_keeps_the_last_report_and_the_retention(spark):
    rows = [("A", "F1", 10), ("A", "F1", 30), ("A", "F2", 5), ("B", "F1", 7)]
    frame = spark.createDataFrame(rows, SCHEMA)
    got = sorted(tuple(r) for r in rotation.rotation_index(frame).collect())
    assert got == [("A", "F1", 30), ("A", "F2", 5), ("B", "F1", 7)]
    recent = rotation.rotation_index(frame, now=30, retention_s=24).collect()
    assert sorted(tuple(r) for r in recent) == [("A", "F1", 30), ("B", "F1", 7)]


def test_next_flight_records(spark):
    frame = spark.createDataFrame(random_flights(5), SCHEMA).withColumn(
        "destination", F.concat(F.lit("to-"), "flight_id")
    )
    rows = rotation.next_flight_records(frame, ["destination"], 500).collect()
    expected = brute_force(random_flights(5), 500)
    assert len(rows) == sum(
        1 for reg, _, ts in random_flights(5) if reg and expected[reg, ts][0]
    )
    for r in rows:
        assert (r.downstream_count, r.next_timestamp, r.next_flight_id) == expected[
            r.registration, r.timestamp
        ]
        assert r.next_destination == f"to-{r.next_flight_id}"
