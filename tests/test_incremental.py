"""Gold tables from the partial aggregates of batches, against a full refresh."""

import re

import pytest
from pyspark.sql import functions as F

from tailwake.plans import gold, silver
from tailwake.plans.incremental import IncrementalGold
from tailwake.sources import runs
from tailwake.sources.workspace import new_folder
from tailwake.streaming import jobs

KEY = ("flight_id", "ingested_at")


def rows_of(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def read(spark, kept, name):
    columns = [c for c in gold.gold_table(spark, kept.base, name).columns if c != "report_date"]
    return rows_of(gold.gold_table(spark, kept.base, name).select("report_date", *columns))


@pytest.fixture(scope="module")
def parts(given):
    share = F.pmod(F.xxhash64(*KEY), F.lit(4))
    return [given.filter(share == n).persist() for n in range(4)]


def test_equals_a_full_refresh(spark, given, parts, monkeypatch):
    monkeypatch.setattr(runs, "FAN", 3)
    kept = IncrementalGold(new_folder(spark, "incremental"))
    for batch, rows in enumerate([*parts, given.limit(0)]):
        kept.update(rows, batch)
        kept.update(rows, batch)  # replayed
        if batch == 1:
            assert set(kept.refresh(spark)) == set(gold.TABLES)
    assert max(len(some) for some in kept.store.newest(spark).runs.values()) < 4
    written = kept.refresh(spark)
    assert kept.due(spark) == [] and kept.refresh(spark) == dict.fromkeys(gold.TABLES, 0)
    for name in gold.TABLES:
        whole = gold.build(given, name)
        assert read(spark, kept, name) == rows_of(whole) and written[name] == whole.count()


def test_a_refresh_replaces_the_days_of_new_batches_only(spark, given):
    name = "airline_daily_performance"
    kept = IncrementalGold(new_folder(spark, "days"), names=[name])
    first = F.floor(F.col("timestamp") / 86400) < 19735
    kept.update(given.filter(first), 0)
    before = kept.refresh(spark)[name]
    late = given.filter(F.floor(F.col("timestamp") / 86400) == 19734).limit(5)
    kept.update(given.filter(F.floor(F.col("timestamp") / 86400) == 19740).unionByName(late), 1)
    assert sorted(kept.due(spark)) == ["2024-01-12", "2024-01-18"]
    assert 0 < kept.refresh(spark)[name] < before
    # Merged rows come from partial aggregates, with the days as a filter of the scan.
    plan = kept.merged(spark, name, ["2024-01-18"])._jdf.queryExecution().executedPlan().toString()
    assert "predicted_delay_minutes" not in plan.replace("sum_predicted_delay_minutes", "").replace("n_predicted_delay_minutes", "")
    assert re.search(r"PushedFilters: \[[^\]]*report_date", plan)
    assert len(re.findall("FileScan", plan)) == 1


def test_an_interrupted_refresh_is_taken_up_again(spark, parts, monkeypatch):
    name = "hourly_delay_trends"
    kept = IncrementalGold(new_folder(spark, "interrupted"), names=[name])
    kept.update(parts[0], 0)
    with monkeypatch.context() as patch:
        patch.setattr(IncrementalGold, "merged", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            kept.refresh(spark)
    kept.update(parts[1], 1)
    kept.refresh(spark)
    whole = gold.build(parts[0].unionByName(parts[1]), name)
    assert read(spark, kept, name) == rows_of(whole)


def test_undated_rows(spark, given):
    name = "weather_impact_analysis"
    kept = IncrementalGold(new_folder(spark, "undated"), names=[name])
    odd = given.limit(40).withColumn("timestamp", F.when(F.col("timestamp") % 2 == 0, F.col("timestamp") * 1000).otherwise(F.col("timestamp")))
    odd = odd.persist()
    kept.update(odd, 0)
    kept.refresh(spark)
    assert read(spark, kept, name) == rows_of(gold.build(odd, name))


def test_stream_of_stored_silver(spark, given, parts):
    base = new_folder(spark, "gold-stream")
    clock = {"now": 1000}
    kept = IncrementalGold(f"{base}/gold", clock=lambda: clock["now"])
    path = f"{base}/silver"

    def run():
        stream = jobs.stored_stream(given, path)
        jobs.drain(jobs.start_gold(stream, kept, f"{base}/ck", jobs.ONCE))

    silver.stored(parts[0]).write.partitionBy(silver.EVENT_DATE).parquet(path)
    run()
    assert read(spark, kept, "airline_daily_performance") == rows_of(gold.build(parts[0], "airline_daily_performance"))
    silver.stored(parts[1]).write.mode("append").partitionBy(silver.EVENT_DATE).parquet(path)
    clock["now"] += 10
    run()  # not due yet
    assert read(spark, kept, "airline_daily_performance") == rows_of(gold.build(parts[0], "airline_daily_performance"))
    silver.stored(parts[2]).write.mode("append").partitionBy(silver.EVENT_DATE).parquet(path)
    clock["now"] += 300
    run()
    whole = parts[0].unionByName(parts[1]).unionByName(parts[2])
    for name in gold.TABLES:
        assert read(spark, kept, name) == rows_of(gold.build(whole, name))
