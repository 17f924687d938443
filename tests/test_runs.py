"""Tables of runs: what a batch writes, merging, expiry, replay."""

import random

import pytest
from pyspark.sql import functions as F

from tailwake.sources import runs
from tailwake.sources.runs import RunStore
from tailwake.sources.workspace import new_folder
from tailwake.streaming.live_tables import KeyedTable, LiveTables

SCHEMA = "k string, at int, what string"


def view(table, store, spark):
    newest = store.newest(spark)
    rows = table.current(store.read(spark, "t", newest.runs["t"]), newest.clock)
    return sorted((r.k, r.at, r.what, r.seen_at) for r in rows.collect())


def brute(history, ttl, now):
    alive = [row for row in history if ttl is None or row[3] > now - ttl]
    return sorted(max(r for r in order) for order in by_key(alive).values())


def by_key(rows):
    out = {}
    for k, at, what, seen in rows:
        out.setdefault(k, []).append((k, at, what, seen))
    return {k: [max(some, key=lambda r: (r[1], r[3], r[2]))] for k, some in out.items()}


def append(store, table, spark, rows, batch, clock):
    start, pointer = store.start(spark, batch, lambda: clock)
    old = start.runs["t"] if start else []
    fresh = table.fresh(spark.createDataFrame(rows, SCHEMA).coalesce(1), clock)
    alive = [r for r in old if not table.expired(r.high, clock)]
    run = store.write(fresh, "t", clock, clock)
    merged = store.merged(
        spark, "t", [*alive, run], lambda m: table.lasting(table.unexpired(m, clock)), table.period, clock
    )
    pointer.runs["t"] = merged
    store.publish(spark, pointer)


@pytest.mark.parametrize("ttl,fan,period", [(None, 2, 100), (55, 2, 30), (55, 3, 1000), (55, 1000, 10**9)])
def test_views_do_not_depend_on_merging(spark, monkeypatch, ttl, fan, period):
    """Late reports, keys that vanish and come back, batches without rows."""
    monkeypatch.setattr(runs, "FAN", fan)
    rng = random.Random(8)
    store = RunStore(new_folder(spark, "runs"))
    table = KeyedTable("t", "k", ("at",), ttl, period)
    history, clock = [], 100
    for batch in range(12):
        clock += rng.choice([1, 7, 20])
        rows = [(rng.choice("abcdef"), clock - rng.choice([0, 0, 5, 60]), f"w{batch}") for _ in range(rng.choice([0, 2, 6]))]
        rows = list({r[0]: r for r in sorted(rows)}.values())
        append(store, table, spark, rows, batch, clock)
        history += [(*r, clock) for r in rows]
        assert view(table, store, spark) == brute(history, ttl, clock)
    if fan == 2:
        assert len(store.newest(spark).runs["t"]) < 7


def test_a_replayed_batch_counts_once(spark):
    store, table = RunStore(new_folder(spark, "again")), KeyedTable("t", "k", ("at",), None)
    append(store, table, spark, [("a", 1, "x")], 0, 10)
    for _ in range(runs.KEPT + 3):
        append(store, table, spark, [("b", 1, "y")], 1, 20)
    newest = store.newest(spark)
    assert [run.rows for run in newest.runs["t"]] == [1, 1] and newest.clock == 20
    append(store, table, spark, [("c", 1, "z")], 0, 30)  # another batch, after a fresh checkpoint
    assert [r[0] for r in view(table, store, spark)] == ["a", "b", "c"]


def size(spark, base):
    at = spark._jvm.org.apache.hadoop.fs.Path(base)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(at).getLength()


def test_a_batch_writes_what_it_brought(spark, given):
    """A large first batch, then small ones: each adds a small part of what the tables hold."""
    clock = {"now": 10}
    tables = LiveTables(new_folder(spark, "bytes"), clock=lambda: F.lit(clock["now"]))
    tables.update(given, 0)
    whole = size(spark, f"{tables.base}/runs")
    held = tables.rotation_list(spark).count()
    for batch in range(1, 6):
        clock["now"] += 10
        before = size(spark, f"{tables.base}/runs")
        tables.update(given.limit(2), batch)
        assert size(spark, f"{tables.base}/runs") - before < 0.25 * whole
    assert tables.rotation_list(spark).count() == held
    newest = tables.store.newest(spark)
    assert len(newest.runs["rotations"]) == 6


def test_hours_are_merged_once_they_have_passed(spark, given):
    clock = {"now": 3590}
    tables = LiveTables(new_folder(spark, "hours"), clock=lambda: F.lit(clock["now"]))
    parts = given.randomSplit([0.4, 0.3, 0.3], 3)
    tables.update(parts[0], 0)
    clock["now"] = 3599
    tables.update(parts[1], 1)
    assert [r.level for r in tables.store.newest(spark).runs["rotations"]] == [0, 0]
    before = tables.rotation_list(spark).count()
    clock["now"] = 3600
    tables.update(parts[2].limit(0), 2)
    merged = tables.store.newest(spark).runs["rotations"]
    assert [(r.level, r.low, r.high) for r in merged] == [(1, 3590, 3599)]
    assert tables.rotation_list(spark).count() == before
    clock["now"] = 3599 + 86400
    tables.update(parts[2].limit(1), 3)
    assert [r.low for r in tables.store.newest(spark).runs["rotations"]] == [3599 + 86400]
