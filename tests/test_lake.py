"""Gold tables on disk, JSON lines, workspace."""

import json
import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from tailwake.plans import gold, silver
from tailwake.sources import files, lake, workspace


@pytest.fixture(scope="module")
def base(spark, given):
    base = workspace.new_folder(spark, "gold-test")
    assert set(gold.refresh(given, base)) == set(gold.TABLES)
    return base


def test_refresh_counts_and_summary(spark, given, base):
    summary = {r.table: r.rows for r in gold.gold_summary(spark, base).collect()}
    for name in gold.TABLES:
        assert summary[name] == gold.build(given, name).count() > 0


def test_read_back_in_order(spark, base):
    rows = gold.gold_table(spark, base, "route_daily_statistics").collect()
    keys = [(r.report_date, -r.total_flights) for r in rows]
    assert keys == sorted(keys)
    samples = gold.gold_samples(spark, base)
    assert set(samples) == set(gold.TABLES)
    assert samples["hourly_delay_trends"].count() == 5


def test_partial_refresh_replaces_only_its_days(spark, given, tmp_path):
    base, name = str(tmp_path), "airline_daily_performance"
    gold.refresh(given, base, names=[name])
    before = {tuple(r) for r in gold.gold_table(spark, base, name).collect()}
    day, next_day = date(2024, 1, 10), date(2024, 1, 11)
    half = given.limit(0).unionByName(given.filter("airline_icao <> 'GIA'"))
    gold.refresh(half, base, since=day, until=next_day, names=[name])
    after = {tuple(r) for r in gold.gold_table(spark, base, name).collect()}
    assert before - after
    columns = gold.gold_table(spark, base, name).columns
    at, who = columns.index("report_date"), columns.index("airline_icao")
    assert {(r[at], r[who]) for r in before - after} == {(day, "GIA")}
    assert not after - before


def test_a_day_that_became_empty_goes(spark, given, tmp_path):
    base, name = str(tmp_path), "route_daily_statistics"
    gold.refresh(given, base, names=[name])
    before = {tuple(r) for r in gold.gold_table(spark, base, name).collect()}
    at = gold.gold_table(spark, base, name).columns.index("report_date")
    gone = given.filter(F.floor(F.col("timestamp") / 86400) != 19733)
    gold.refresh(gone, base, date(2024, 1, 10), date(2024, 1, 13), [name])
    after = {tuple(r) for r in gold.gold_table(spark, base, name).collect()}
    assert {r[at] for r in before - after} == {date(2024, 1, 11)} and not after - before
    gold.refresh(given.limit(0), base, None, date(2024, 1, 5), [name])
    left = {tuple(r) for r in gold.gold_table(spark, base, name).collect()}
    assert left == {r for r in after if r[at] >= date(2024, 1, 5)}


def test_a_range_reads_only_its_days(spark, given, tmp_path):
    rows = silver.stored(given)
    rows.write.partitionBy(silver.EVENT_DATE).parquet(str(tmp_path / "silver"))
    stored = spark.read.parquet(str(tmp_path / "silver"))
    table = gold.build(stored, "airline_daily_performance", date(2024, 1, 10), date(2024, 1, 12))
    plan = table._jdf.queryExecution().executedPlan().toString()
    filters = re.search(r"PartitionFilters: \[(.*?)\]", plan)[1]
    assert "event_date" in filters and "2024-01-10" in filters and "2024-01-12" in filters
    whole = gold.build(given, "airline_daily_performance", date(2024, 1, 10), date(2024, 1, 12))
    assert sorted(map(tuple, table.collect())) == sorted(map(tuple, whole.collect()))


def test_unknown_and_missing_tables(spark, tmp_path):
    with pytest.raises(ValueError, match="airline_daily_performance"):
        gold.gold_table(spark, str(tmp_path), "nonsense")
    assert gold.gold_table(spark, str(tmp_path), "hourly_delay_trends") is None
    rows = gold.gold_summary(spark, str(tmp_path)).collect()
    assert {r.rows for r in rows} == {None} and len(rows) == len(gold.TABLES)


def test_json_lines(given):
    table = gold.build(given, "weather_impact_analysis")
    docs = [json.loads(r.json) for r in gold.gold_json(table, "weather_impact_analysis").collect()]
    assert len(docs) == table.count()
    assert set(docs[0]) == set(table.columns)


def test_append_and_read(spark, given, tmp_path):
    path = str(tmp_path / "t")
    rows = given.select("flight_id", "flight_phase")
    lake.append_table(rows, path, ["flight_phase"])
    lake.append_table(rows, path, ["flight_phase"])
    assert lake.read_table(spark, path).count() == 2 * rows.count()


def test_shared_root_comes_from_the_session(spark):
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert workspace.shared_root(spark) == root
    assert workspace.new_folder(spark, "x").startswith(root)


def test_scratch_folders_are_removed(spark):
    made, workspace._made[:] = list(workspace._made), []
    kept = workspace.materialize(spark.range(3).toDF("x"), "scratch")
    assert kept.count() == 3
    workspace.remove_scratch(spark)
    assert workspace._made == []
    path = kept.inputFiles()[0].rpartition("/")[0]
    assert files.names(spark, path) == []
    workspace._made[:] = made
