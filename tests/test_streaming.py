"""Streams against the batch path, restarts, replays and expiry."""

import json
import time

import pytest
from pyspark.sql import functions as F

from tailwake import schemas as S
from tailwake.operators.rotation import rotation_index
from tailwake.plans import live, silver
from tailwake.sources import envelopes, events, files, runs
from tailwake.sources.workspace import new_folder
from tailwake.streaming import jobs
from tailwake.streaming.live_tables import LiveTables


@pytest.fixture(scope="module")
def topic(spark, sf_dir):
    """Message files, several per folder, so a run has more than one micro-batch."""
    path = new_folder(spark, "topic")
    messages = events.messages(events.read_events(spark, sf_dir))
    messages.repartition(4).write.parquet(path)
    return path


def read_topic(spark, topic):
    return envelopes.read_envelope_stream(
        spark, "parquet", topic, {"maxFilesPerTrigger": "1"}
    )


def batch_path(spark, topic):
    return envelopes.decode_reports(spark.read.schema(S.ENVELOPE).parquet(topic))


def rows_of(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def test_all_queries_restart_and_match_batch(spark, topic):
    base = new_folder(spark, "run")

    def run():
        queries = jobs.start_all(read_topic(spark, topic), base, f"{base}/ck", jobs.ONCE)
        jobs.drain(*queries.values())
        return queries

    first = run()
    assert first["bronze"].lastProgress["batchId"] >= 3
    # Messages are parsed for bronze and silver; the rest reads what silver stored.
    for name in ("predictions", "live"):
        assert "silver" in first[name].lastProgress["sources"][0]["description"]
    parsed = batch_path(spark, topic)
    enriched = silver.enrich(parsed)
    bronze = spark.read.parquet(f"{base}/bronze")
    assert rows_of(bronze.select(*S.BRONZE_COLUMNS)) == rows_of(parsed.select(*S.BRONZE_COLUMNS))
    # Malformed messages reach bronze as all-null rows.
    assert bronze.filter("flight_id IS NULL").count() > 0
    stored = spark.read.parquet(f"{base}/silver").select(*S.SILVER_COLUMNS)
    assert rows_of(stored) == rows_of(enriched.select(*S.SILVER_COLUMNS))
    replayed = silver.rebuild_silver(bronze).select(*S.SILVER_COLUMNS)
    assert rows_of(replayed) == rows_of(stored)
    sent = spark.read.schema("key string, value string").json(f"{base}/predictions")
    assert sent.count() == stored.count()

    run()  # nothing new since
    assert spark.read.parquet(f"{base}/bronze").count() == bronze.count()
    assert spark.read.parquet(f"{base}/silver").count() == stored.count()


def test_live_tables_match_batch(spark, topic):
    base = new_folder(spark, "live")
    tables = LiveTables(base, live_ttl_s=None, rotation_ttl_s=None, alert_ttl_s=None)
    enriched = silver.enrich(envelopes.decode_reports(read_topic(spark, topic)))
    assert tables.flights(spark) is None and tables.latest_stats(spark) is None
    jobs.drain(jobs.start_live(enriched, tables, f"{base}/ck", jobs.ONCE))
    batch = silver.enrich(batch_path(spark, topic))
    assert rows_of(tables.flights(spark).select(*S.LIVE_COLUMNS)) == rows_of(live.live_state(batch))
    index = tables.rotation_list(spark).select("registration", "flight_id", "timestamp")
    assert rows_of(index) == rows_of(rotation_index(batch))
    stats = tables.stats_history(spark)
    assert stats.count() >= 4
    assert stats.agg(F.sum("total_flights")).first()[0] == batch.count()
    assert tables.latest_stats(spark).count() == 1


def test_replayed_batch_changes_nothing(spark, given):
    base = new_folder(spark, "replay")
    tables = LiveTables(base, live_ttl_s=None, rotation_ttl_s=None, alert_ttl_s=None, clock=lambda: F.lit(50))
    parts = given.randomSplit([0.5, 0.5], 7)
    tables.update(parts[0], 0)
    tables.update(parts[1], 1)
    before = rows_of(tables.flights(spark))
    tables.update(parts[1], 1)
    assert rows_of(tables.flights(spark)) == before
    assert tables.stats_history(spark).count() == 2


def test_a_replayed_batch_keeps_its_clock(spark, given):
    tables = LiveTables(new_folder(spark, "replay-clock"))
    tables.update(given.limit(50), 0)
    seen = [r[0] for r in tables.flights(spark).select("seen_at").distinct().collect()]
    time.sleep(1.1)
    tables.update(given.limit(50), 0)
    assert [r[0] for r in tables.flights(spark).select("seen_at").distinct().collect()] == seen


def test_a_fresh_checkpoint_goes_on_from_the_newest_state(spark, given):
    tables = LiveTables(new_folder(spark, "reset"), live_ttl_s=None, clock=lambda: F.lit(50))
    parts = given.randomSplit([0.4, 0.3, 0.3], 7)
    tables.update(parts[0], 100)
    tables.update(parts[1], 101)
    before = tables.flights(spark).count()
    tables.update(parts[2], 0)
    assert tables.flights(spark).count() > before
    assert tables.latest_stats(spark).first().batch_id == 0
    assert [r.batch_id for r in tables.stats_history(spark).collect()].count(0) == 1


def test_readers_see_whole_batches_only(spark, given):
    class Halfway(LiveTables):
        def _publish(self, spark, pointer):
            raise RuntimeError("stopped before publication")

    base = new_folder(spark, "halfway")
    tables = LiveTables(base, clock=lambda: F.lit(50))
    tables.update(given.limit(100), 0)
    reader, before = tables.flights(spark), rows_of(tables.flights(spark))
    with pytest.raises(RuntimeError):
        Halfway(base, clock=lambda: F.lit(60)).update(given, 1)
    assert rows_of(tables.flights(spark)) == before
    tables.update(given.limit(200), 1)
    assert rows_of(reader) == before  # a slow reader keeps its files


def folders(spark, tables):
    names = files.names(spark, f"{tables.base}/runs")
    return {(t, n) for t in names for n in files.names(spark, f"{tables.base}/runs/{t}")}


def named(spark, tables):
    kept = [tables.store.pointer(spark, place) for place in tables.store.places(spark)]
    return {(t, run.name) for pointer in kept for t, some in pointer.runs.items() for run in some}


def test_old_batches_are_removed(spark, given):
    clock = {"now": 0}
    tables = LiveTables(new_folder(spark, "kept"), clock=lambda: F.lit(clock["now"]))
    for batch in range(runs.KEPT + 3):
        clock["now"] = 400 * batch
        tables.update(given.limit(3), batch)
    assert len(tables.store.places(spark)) == runs.KEPT + 1
    assert folders(spark, tables) == named(spark, tables)
    # Flights expire after 300 s, so each pointer names the run of its own batch only.
    newest = tables.store.newest(spark)
    assert len(newest.runs["flights"]) == 1 < len(newest.runs["rotations"])


def test_folders_of_a_batch_that_died_are_removed(spark, given):
    class Dying(LiveTables):
        def _publish(self, spark, pointer):
            raise RuntimeError("stopped before publication")

    base = new_folder(spark, "dying")
    tables = LiveTables(base, clock=lambda: F.lit(50))
    tables.update(given.limit(3), 0)
    with pytest.raises(RuntimeError):
        Dying(base, clock=lambda: F.lit(60)).update(given.limit(5), 1)
    assert folders(spark, tables) > named(spark, tables)
    tables.update(given.limit(5), 1)
    assert folders(spark, tables) == named(spark, tables)


def test_odd_times_do_not_stop_a_stream(spark, tmp_path):
    base = str(tmp_path)
    times = [1704067200, 1704067200000, 1704067200000000, -5, 2**62, 4102444799, 4102444800]
    lines = [json.dumps({"key": "k", "value": json.dumps({"flight_id": f"F{t}", "timestamp": t})}) for t in times]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text("\n".join(lines))

    def run():
        messages = spark.readStream.schema("key string, value string, timestamp timestamp").json(f"{base}/in")
        parsed = envelopes.decode_reports(messages)
        jobs.drain(jobs.start_bronze(parsed, f"{base}/bronze", f"{base}/ck", jobs.ONCE))
        return {r.flight_id: str(r.ingestion_date) for r in spark.read.parquet(f"{base}/bronze").collect()}

    want = {f"F{t}": "None" for t in times} | {"F1704067200": "2024-01-01", "F4102444799": "2099-12-31"}
    assert run() == want
    assert run() == want  # and again from its checkpoint


def test_console_sink(spark, topic, tmp_path):
    enriched = silver.enrich(envelopes.decode_reports(read_topic(spark, topic)))
    query = jobs.start_console(enriched, str(tmp_path), jobs.ONCE)
    jobs.drain(query)
    assert "ConsoleTable" in query.lastProgress["sink"]["description"]
    read = sum(p["numInputRows"] for p in query.recentProgress)
    assert read == spark.read.parquet(topic).count()


def test_expiry_counts_from_the_last_sighting(spark, given):
    base = new_folder(spark, "expiry")
    clock = {"now": 1000}
    tables = LiveTables(base, clock=lambda: F.lit(clock["now"]))
    some = given.filter(F.col("delay_category") == "CRITICAL DELAY").limit(6).persist()
    tables.update(some, 0)
    flights = tables.flights(spark).count()
    assert flights > 0 and tables.alert_list(spark).count() == flights
    clock["now"] = 1299
    tables.update(given.limit(0), 1)
    assert tables.flights(spark).count() == flights
    clock["now"] = 1300
    tables.update(given.limit(0), 2)
    assert tables.flights(spark).count() == 0
    assert tables.alert_list(spark).count() == flights
    assert tables.rotation_list(spark).count() > 0
    clock["now"] = 1000 + 3600
    tables.update(given.limit(0), 3)
    assert tables.alert_list(spark).count() == 0
    assert tables.rotation_list(spark).count() > 0


def test_a_failing_sink_fails_its_query(spark, topic):
    from pyspark.errors import StreamingQueryException

    class Broken(LiveTables):
        def update(self, enriched, batch_id):
            raise RuntimeError("sink is down")

    base = new_folder(spark, "broken")
    enriched = silver.enrich(envelopes.decode_reports(read_topic(spark, topic)))
    query = jobs.start_live(enriched, Broken(base), f"{base}/ck", jobs.ONCE)
    with pytest.raises(StreamingQueryException, match="sink is down"):
        jobs.drain(query)


def test_stop_all_when_one_ends(spark, topic):
    base = new_folder(spark, "await")
    source = envelopes.decode_reports(read_topic(spark, topic))
    slow = jobs.start_bronze(source, f"{base}/a", f"{base}/ck", {"processingTime": "1 hour"})
    spark.streams.resetTerminated()
    quick = jobs.start_silver(silver.enrich(source), f"{base}/b", f"{base}/ck", jobs.ONCE)
    jobs.await_any(spark, {"slow": slow, "quick": quick})
    assert not slow.isActive and not quick.isActive


def test_messages_survive_a_file_round_trip(spark, given, tmp_path):
    path = str(tmp_path / "out")
    envelopes.write_envelopes(envelopes.encode_predictions(given), "json", path)
    back = spark.read.schema("key string, value string").json(path)
    body = F.from_json("value", given.select(*S.PAYLOAD_COLUMNS).schema)
    assert rows_of(back.select(body.alias("b")).select("b.*")) == rows_of(given.select(*S.PAYLOAD_COLUMNS))
    # Nulls are left out of the text, and the nested form carries the weather.
    nested = envelopes.nest_weather(batch_parsed(given, spark))
    text = envelopes.encode_events(nested).first().value
    assert '"weather":{' in text


def batch_parsed(given, spark):
    missing = [c for c in S.BRONZE_COLUMNS if c not in given.columns]
    assert not missing
    return given
