"""Served lists, ranking, headline figures and alerts."""

import pytest
from pyspark.sql import functions as F

from tailwake.operators import airlines, alerts, summaries
from tailwake.plans import live, serving


@pytest.fixture(scope="module")
def flights(given):
    return live.with_ripple(live.live_state(given)).persist()


def test_scores_stay_in_range(flights):
    low, high = flights.agg(F.min("res"), F.max("res")).first()
    assert 0 <= low <= high <= 100
    scores = airlines.airline_performance(flights).agg(F.min("api_score"), F.max("api_score"))
    assert 0 <= scores.first()[0] <= scores.first()[1] <= 100


def test_filters(flights):
    everything = flights.count()
    assert serving.list_flights(flights).count() == everything
    upper = serving.list_flights(flights, airline="GIA").count()
    assert serving.list_flights(flights, airline="gia").count() == upper > 0
    assert serving.list_flights(flights, limit=3).count() == 3
    for bad in (0, 1001):
        with pytest.raises(ValueError):
            serving.list_flights(flights, limit=bad)
    with pytest.raises(ValueError):
        airlines.list_airlines(airlines.airline_performance(flights), limit=501)


def test_point_lookups(flights):
    one = flights.agg(F.min("flight_id")).first()[0]
    assert serving.flight_detail(flights, one).count() == 1
    assert serving.flight_detail(flights, "nope").count() == 0
    assert serving.airline_detail(flights, "nope").count() == 0
    assert serving.flight_impact(flights, one).columns == list(serving.IMPACT_COLUMNS)
    assert serving.ripple_effect(flights, one).first().flight_id == one


def test_ranking_matches_the_sorted_list(flights):
    performance = airlines.airline_performance(flights)
    ranked = airlines.rank_airlines(performance).orderBy("rank").collect()
    listed = airlines.list_airlines(performance).collect()
    assert [r.airline_icao for r in ranked] == [r.airline_icao for r in listed]
    assert [r["rank"] for r in ranked] == list(range(1, len(ranked) + 1))


def test_ranking_with_equal_scores(spark):
    rows = [("B", 50.0), ("A", 50.0), ("C", 90.0), ("D", 10.0), ("E", 50.0)]
    performance = spark.createDataFrame(rows, "airline_icao string, api_score double")
    ranked = airlines.rank_airlines(performance).orderBy("rank").collect()
    assert [(r["rank"], r.airline_icao) for r in ranked] == [
        (1, "C"), (2, "A"), (3, "B"), (4, "E"), (5, "D"),
    ]


def test_payload(given, flights):
    found = alerts.scan_alerts(flights)
    payload = serving.dashboard_payload(flights, found, summaries.batch_stats(given))
    assert set(payload) == {"stats", "impact", "airlines", "flights", "alerts", "totals"}
    totals = payload["totals"].first()
    assert (totals.total_flights, totals.total_alerts) == (flights.count(), found.count())
    assert payload["airlines"].count() <= 10
    assert serving.counted(payload["flights"]).first()["count"] == totals.total_flights


def test_empty_batches_give_zeros(given, flights):
    stats = summaries.batch_stats(given.limit(0)).first()
    assert set(stats.asDict().values()) == {0}
    impact = summaries.aggregate_impact(flights.limit(0)).first()
    assert set(impact.asDict().values()) == {0}


def test_kpi_falls_back(spark):
    names = "critical_delay_flights", "total_estimated_compensation_eur", "total_affected_passengers", "avg_fdi"
    impact = spark.createDataFrame([(0, 5, None, 0.0)], ", ".join(f"{n} double" for n in names).replace("critical_delay_flights double", "critical_delay_flights int").replace("eur double", "eur int").replace("passengers double", "passengers int"))
    stats = spark.createDataFrame(
        [(7, 9, 11, 0.0)],
        "critical_flights int, total_estimated_compensation_eur int, "
        "total_affected_passengers int, avg_fdi double",
    )
    assert tuple(summaries.kpi_header(impact, stats).first()) == (7, 5, 11, 0.0)
    assert tuple(summaries.kpi_header(impact.limit(0), stats.limit(0)).first()) == (0, 0, 0, 0.0)


def test_alert_retention(spark):
    rows = [
        ("F1", "CRITICAL DELAY", 1000, 20.0), ("F1", "ON TIME", 2000, 1.0),
        ("F1", "CRITICAL DELAY", 900, 30.0), ("", "CRITICAL DELAY", 3000, 50.0),
        ("F2", "CRITICAL DELAY", 5000, None), ("F3", "MEDIUM DELAY", 5000, 5.0),
    ]
    frame = spark.createDataFrame(
        rows, "flight_id string, delay_category string, `timestamp` bigint, fdi double"
    )
    everything = alerts.critical_alerts(frame).collect()
    assert {(r.flight_id, r.alert_created_at) for r in everything} == {("F1", 1000), ("F2", 5000)}
    late = {r.flight_id: r.ttl_seconds for r in alerts.critical_alerts(frame, now=5100).collect()}
    assert late == {"F2": 3500}
    edge = {r.flight_id: r.ttl_seconds for r in alerts.critical_alerts(frame, now=4599).collect()}
    assert edge == {"F1": 1, "F2": 4001}
    assert [r.flight_id for r in alerts.top_alerts(alerts.critical_alerts(frame)).collect()] == ["F1", "F2"]
    with pytest.raises(ValueError):
        alerts.list_alerts(frame, 0)
    assert alerts.list_alerts(frame, 2).count() == 2


def test_live_view_expires(spark, given):
    newest = given.agg(F.max("timestamp")).first()[0]
    current = live.live_state(given, now=newest + 100).collect()
    expected = {
        r.flight_id for r in given.filter(F.col("timestamp") > newest - 200).collect()
    }
    assert {r.flight_id for r in current} == expected
    assert live.live_state(given, now=newest + 301).count() == 0
