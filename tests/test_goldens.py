"""A published sample flight and sample airline, recomputed in full."""

import calendar

import pytest
from pyspark.sql import functions as F

from tailwake.functions.airline import performance_band, performance_index
from tailwake.operators.reports import add_delay, add_features, add_impact
from tailwake.operators.rotation import add_ripple


@pytest.fixture(scope="module")
def sample(spark):
    noon_on_a_wednesday = calendar.timegm((2026, 6, 17, 12, 0, 0))
    rows = spark.createDataFrame(
        [("403acf39", "A21N", "9M-VAA", "CAN", 31000, 436, 0.0, 9.9, 14040.0, 0, noon_on_a_wednesday)],
        "flight_id string, aircraft_model string, registration string, destination string, "
        "altitude_ft int, speed_kn int, precipitation_mm float, wind_knots float, "
        "visibility_m float, weather_code int, `timestamp` bigint",
    )
    return add_impact(add_delay(add_features(rows), F.lit(13.6)))


def no_legs(spark):
    return spark.createDataFrame(
        [], "registration string, `timestamp` bigint, downstream_count bigint, "
        "next_timestamp bigint, next_flight_id string",
    )


def test_sample_flight(spark, sample):
    row = add_ripple(sample, no_legs(spark)).first()
    assert row.distance_km == pytest.approx(2826.15, abs=0.01)
    assert row.route_deviation == pytest.approx(0.99, abs=1e-4)
    assert row.weather_score == pytest.approx(0.05725, abs=1e-5)
    assert (row.traffic_density, row.hour_utc, row.flight_phase) == (7, 12, 1)
    assert (row.capacity, row.affected_passengers) == (220, 187)
    assert row.fdi == pytest.approx(15.15, abs=0.01)
    assert (row.fdi_category, row.delay_category) == ("LOW", "ON TIME")
    assert row.estimated_compensation_eur == 0
    assert row.risk_score_manual == 0.0
    assert (row.res, row.res_category) == (11.0, "LOW")
    assert (row.next_flight_id, row.next_flight_gap_min, row.downstream_flight_count) == (None, None, 0)


def test_sample_airline(spark):
    figures = [14 / 29, 16.1, 0.0, 17.1, 0.0]
    score = performance_index(*[F.lit(x) for x in figures])
    row = spark.range(1).select(score.alias("s"), performance_band(score).alias("b")).first()
    assert (row.s, row.b) == (74.2, "GOOD")


def test_null_delay_is_critical(spark, sample):
    row = add_impact(add_delay(sample.drop("capacity"), F.lit(None).cast("float"))).first()
    assert row.delay_category == "CRITICAL DELAY"
    assert row.normalized_delay == 1.0
