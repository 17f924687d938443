"""The dashboard's sums by deltas, against summing the scored live view."""

import pytest
from pyspark.sql import functions as F

from tailwake.operators import airlines, summaries
from tailwake.operators.rotation import rotation_index
from tailwake.plans import live, serving
from tailwake.sources import files, runs
from tailwake.sources.workspace import new_folder
from tailwake.streaming import dashboard
from tailwake.streaming.dashboard import Dashboard


def rows_of(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def check(spark, board):
    """Every part equals the same figure of the whole live view."""
    scored = live.with_ripple(board.flights(spark)).persist()
    impact, want = board.impact(spark).first(), summaries.aggregate_impact(scored).first()
    for name in want.asDict():
        assert impact[name] == pytest.approx(want[name], abs=1e-6), name
    got, whole = rows_of(board.airlines(spark)), rows_of(airlines.airline_performance(scored))
    assert len(got) == len(whole)
    for one, other in zip(got, whole, strict=True):
        # Sums are exact here and in doubles there, which shows where a mean ends in 5.
        assert one == pytest.approx(other, abs=0.1001)
    totals = serving.dashboard_totals(scored, scored.filter("delay_category = 'CRITICAL DELAY' AND flight_id <> ''"))
    assert board.totals(spark).first() == totals.first()
    scored.unpersist()


def test_changes_expiry_replay_and_merging(spark, given, monkeypatch):
    monkeypatch.setattr(runs, "FAN", 2)
    clock = {"now": 1000}
    board = Dashboard(new_folder(spark, "board"), live_ttl_s=100, clock=lambda: F.lit(clock["now"]))
    assert board.impact(spark) is None and board.airlines(spark) is None
    slot = F.pmod(F.xxhash64("flight_id", "ingested_at"), F.lit(5))
    batches = [given.filter(slot == n).limit(120) for n in range(2)]
    moved = batches[0].withColumns({"registration": F.lit("PK-00001"), "timestamp": F.col("timestamp") + 60})
    for batch, (rows, passed) in enumerate(
        [(batches[0], 0), (moved, 70), (batches[1].limit(0), 45), (batches[1], 500)]
    ):
        clock["now"] += passed
        board.update(rows, batch)
        if batch == 1:
            board.update(rows, batch)
        check(spark, board)
    assert len(board.store.newest(spark).runs["parts"]) <= 3


def test_scores_are_worked_out_for_changed_aircraft_only(spark, given, monkeypatch):
    board = Dashboard(new_folder(spark, "few"), live_ttl_s=None, clock=lambda: F.lit(5))
    board.update(given, 0)
    scored, whole = [], dashboard.contributions

    def counted(flights):
        scored.append(flights.count())
        return whole(flights)

    monkeypatch.setattr(dashboard, "contributions", counted)
    few = given.filter("registration <> ''").limit(3)
    board.update(few.withColumn("timestamp", F.col("timestamp") + 10_000_000), 1)
    aircraft = [r[0] for r in few.select("registration").distinct().collect()]
    expected = board.flights(spark).filter(F.col("registration").isin(aircraft)).count()
    assert len(scored) == 2 and 0 < max(scored) <= expected + 3 < board.flights(spark).count() / 4
    check(spark, board)


def test_payload(spark, given):
    board = Dashboard(new_folder(spark, "payload"), live_ttl_s=None, clock=lambda: F.lit(5))
    board.update(given, 0)
    parts = board.payload(spark)
    assert set(parts) == {"stats", "impact", "airlines", "flights", "alerts", "totals"}
    assert parts["flights"].count() == parts["totals"].first().total_flights
    assert parts["airlines"].count() == min(10, board.airlines(spark).count())
    plan = parts["impact"]._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Join" not in plan


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_scores_read_files_and_skip_what_is_seen_again_unchanged(spark, given, monkeypatch):
    board = Dashboard(new_folder(spark, "again"), live_ttl_s=None, clock=lambda: F.lit(5))
    board.update(given, 0)
    plans, scored, whole = [], [], dashboard.contributions

    def watched(flights):
        plans.append(plan_of(flights))
        scored.append(flights.count())
        return whole(flights)

    monkeypatch.setattr(dashboard, "contributions", watched)
    newest = board.flights(spark).filter("registration <> ''").select("flight_id", "timestamp")
    again = given.join(newest.limit(20), ["flight_id", "timestamp"], "left_semi")
    board.update(again, 1)
    assert scored == [0, 0]
    board.update(again.withColumn("predicted_delay_minutes", F.lit(200.0).cast("float")).withColumn("ingested_at", F.lit("~")), 2)
    assert len(scored) == 4 and min(scored[2:]) >= 20
    # A cached state has a task for each shuffle partition, however few rows; files are read by their size.
    assert not any("InMemoryTableScan" in plan for plan in plans)
    assert "changes" not in files.names(spark, f"{board.base}/runs")
    check(spark, board)


def test_flights_without_registration_and_what_a_dead_batch_left(spark, given, monkeypatch):
    board = Dashboard(new_folder(spark, "blank"), live_ttl_s=None, clock=lambda: F.lit(5))
    blank = given.limit(40).withColumn("registration", F.expr("CASE WHEN altitude_ft % 2 = 0 THEN '' END"))
    board.update(blank.unionByName(given), 0)
    whole = dashboard.contributions

    def dying(flights):
        raise RuntimeError("no scores")

    later = blank.withColumns({"timestamp": F.col("timestamp") + 50_000_000, "fdi": F.lit(None).cast("float")})
    monkeypatch.setattr(dashboard, "contributions", dying)
    monkeypatch.setattr(files, "remove", lambda spark, path: None)
    with pytest.raises(RuntimeError):
        board.update(later, 1)
    monkeypatch.undo()
    assert files.names(spark, f"{board.base}/runs/changes")
    assert dashboard.contributions is whole
    board.update(later, 1)
    assert "changes" not in files.names(spark, f"{board.base}/runs")
    check(spark, board)


def test_rows_that_are_one_per_key_are_not_folded_again(spark, given, monkeypatch):
    board = Dashboard(new_folder(spark, "first"), live_ttl_s=None, clock=lambda: F.lit(5))
    plans, whole = [], dashboard.contributions
    monkeypatch.setattr(dashboard, "contributions", lambda flights: plans.append(plan_of(flights)) or whole(flights))
    board.update(given.unionByName(given), 0)
    assert len(plans) == 1 and "max(struct" not in plans[0]
    check(spark, board)
    stops = rotation_index(given.unionByName(given)).withColumn("stop", F.struct("registration", "flight_id"))
    assert plan_of(board.rotations.fresh(stops, 5)).count("Exchange") == 1
    kept = board.rotation_list(spark).select("registration", "flight_id", "timestamp")
    assert rows_of(kept) == rows_of(rotation_index(given))
