"""Lookups read little, and find all."""

import pytest
from pyspark.sql import functions as F

from tailwake.operators import airlines
from tailwake.plans import live, lookup, serving
from tailwake.sources.workspace import new_folder


@pytest.fixture(scope="module")
def stored(spark):
    """200,000 flights of 50,000 aircraft in ten files."""
    path = new_folder(spark, "lookup")
    rows = spark.range(200_000).select(
        F.concat(F.lit("F"), F.lpad(F.col("id").cast("string"), 8, "0")).alias("flight_id"),
        F.concat(F.lit("PK-"), (F.xxhash64("id") % 50_000).cast("string")).alias("registration"),
        F.col("id").alias("timestamp"),
    )
    lookup.store(rows.orderBy(F.rand(1)), path, "flight_id", ["registration"], rows_a_file=20_000)
    return spark.read.parquet(path)


def rows_read(frame) -> int:
    """Rows that the scan gave out, from the metrics of the executed plan."""
    frame.collect()
    node = frame._jdf.queryExecution().executedPlan()
    while node.children().size():
        node = node.children().apply(0)
    return node.metrics().apply("numOutputRows").value()


def test_a_lookup_by_key_reads_one_page(stored):
    got = stored.filter(F.col("flight_id") == "F00123456")
    assert [r.timestamp for r in got.collect()] == [123456]
    assert 0 < rows_read(got) <= 20_100
    assert rows_read(stored.filter(F.col("flight_id") == "F99999999")) == 0


def test_bloom_filters_skip_row_groups(spark, stored):
    names = [r[0] for r in stored.select("registration").distinct().limit(2000).sample(0.01, seed=3).collect()]
    want = stored.filter(F.col("registration").isin(names)).groupBy("registration").count().collect()
    for name, count in want:
        got = stored.filter(F.col("registration") == name)
        assert got.count() == count
    # A registration that no aircraft has: only false positives of the filters are read.
    assert rows_read(stored.filter(F.col("registration") == "PK-x")) <= 40_000
    few = [rows_read(stored.filter(F.col("registration") == n)) for n, _ in want]
    assert min(few) < 200_000


def test_one_airline_computes_the_rotations_of_its_aircraft_only(given):
    flights = live.live_state(given)
    chosen = live.airline_with_ripple(flights, "gia")
    plan = chosen._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan[plan.rindex("Window") :]
    whole = airlines.airline_performance(live.with_ripple(flights)).filter("airline_icao = 'GIA'")
    assert serving.airline_detail(chosen, "GIA").collect() == whole.collect()
