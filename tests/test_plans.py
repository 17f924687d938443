"""What the physical plans must and must not contain."""

import contextlib
import io
import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from tailwake.operators import heading, weather_join
from tailwake.plans import gold, live, silver
from tailwake.sources import events
from tailwake.sources.workspace import new_folder


@pytest.fixture(scope="module", autouse=True)
def whole_plans(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


@pytest.fixture(scope="module")
def bronze(spark, reports):
    path = new_folder(spark, "bronze")
    silver.bronze(reports).write.partitionBy("ingestion_date").parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def stored_silver(spark, given):
    path = new_folder(spark, "silver")
    silver.silver(given).write.parquet(path)
    return spark.read.parquet(path)


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def final_plan_of(frame) -> str:
    """The plan adaptive execution ended with."""
    execution = frame._jdf.queryExecution()
    execution.toRdd().count()
    return execution.executedPlan().toString().split("Initial Plan")[0]


def test_cleaning_reaches_the_scan(bronze):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        silver.enrich(bronze).explain("formatted")
    pushed = re.search(r"PushedFilters: \[(.*)\]", text.getvalue()).group(1)
    for column in ("on_ground", "altitude_ft", "speed_kn", "heading_deg", "flight_id", "latitude"):
        assert f"IsNotNull({column})" in pushed
    assert "EqualTo(on_ground,true)" in pushed
    assert "GreaterThanOrEqual(altitude_ft,1000)" in pushed


def test_silver_stays_in_compiled_code(bronze):
    text = io.StringIO()
    frame = silver.silver(silver.enrich(bronze))
    with contextlib.redirect_stdout(text):
        frame.explain("codegen")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text.getvalue())]
    assert sizes and max(sizes) < 8000
    assert "Python" not in plan_of(frame)


@pytest.mark.parametrize("name", sorted(gold.TABLES))
def test_gold_is_one_pruned_scan_and_one_shuffle(stored_silver, name):
    plan = plan_of(gold.build(stored_silver, name, date(2024, 1, 10), date(2024, 1, 12)))
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1
    assert "GreaterThanOrEqual(timestamp," in plan and "LessThan(timestamp," in plan
    read = re.search(r"ReadSchema: struct<([^>]*)", plan).group(1)
    assert len(read.split(",")) <= 9
    assert "callsign" not in read


def test_live_view_and_rotations_share_the_shuffle(stored_silver):
    enriched = stored_silver.withColumn("risk_score_manual", F.lit(0.0))
    plan = final_plan_of(live.with_ripple(live.live_state(enriched)))
    assert "ReusedExchange" in plan
    assert len(re.findall(r"FileScan parquet", plan)) == 1


def test_heading_uses_its_fixes_once(bronze):
    plan = final_plan_of(heading.track_heading(bronze))
    assert len(re.findall(r"FileScan parquet", plan)) == 1


def test_no_cross_join_and_no_python(spark, sf_dir, reports, given):
    readings = events.weather_readings(events.read_events(spark, sf_dir))
    frames = [
        weather_join.attach_weather(reports, readings),
        heading.track_heading(reports),
        live.with_ripple(live.live_state(given)),
        *[gold.build(given, name) for name in gold.TABLES],
    ]
    for frame in frames:
        plan = plan_of(frame)
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan
        assert "Python" not in plan and "Pandas" not in plan


def test_one_flight_computes_the_rotations_of_its_aircraft_only(given):
    flights = live.live_state(given)
    plan = live.one_with_ripple(flights, "F0-78929")._jdf.queryExecution().optimizedPlan().toString()
    before_windows = plan[plan.rindex("Window") :]
    assert "LeftSemi" in before_windows
