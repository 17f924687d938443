"""Packed days hold the same rows as the small files they came from."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from tailwake import schemas as S
from tailwake.plans import silver
from tailwake.sources import envelopes, events, files
from tailwake.sources.compaction import CompactedTable
from tailwake.sources.workspace import new_folder
from tailwake.streaming import jobs

FAR = date(2100, 1, 1)


def rows_of(frame):
    return sorted(map(tuple, frame.select(*S.SILVER_COLUMNS, silver.EVENT_DATE).collect()), key=repr)


@pytest.fixture(scope="module")
def topic(spark, sf_dir):
    path = new_folder(spark, "topic")
    events.messages(events.read_events(spark, sf_dir)).repartition(4).write.parquet(path)
    return path


@pytest.fixture
def table(spark, topic):
    """Silver as the stream's own sink writes it, in several small files a day."""
    base = new_folder(spark, "packed")
    source = envelopes.read_envelope_stream(spark, "parquet", topic, {"maxFilesPerTrigger": "1"})
    enriched = silver.enrich(envelopes.decode_reports(source))
    jobs.drain(jobs.start_silver(enriched, f"{base}/silver", f"{base}/ck", jobs.ONCE))
    return CompactedTable(f"{base}/silver", f"{base}/compacted", silver.EVENT_DATE)


def test_rows_stay_and_files_become_few(spark, table):
    raw = spark.read.parquet(table.raw)
    before, reader = rows_of(raw), table.read(spark)
    closed = date(2024, 1, 20)
    days = table.compact(spark, closed)
    assert days and max(days) < "2024-01-20" and table.compact(spark, closed) == []
    packed = table.read(spark)
    assert rows_of(packed) == before == rows_of(reader) == rows_of(spark.read.parquet(table.raw))
    listed = table._files(raw)
    newest = table.store.newest(spark)
    for day in days:
        made = spark.read.parquet(table.store.path(day, newest.runs[day][0])).inputFiles()
        assert len(made) == 1 < len(listed[day])
    # A day that is packed is read from its packed file only, an open one from the table.
    read = packed.select(F.input_file_name()).distinct().count()
    assert read == len(days) + sum(len(p) for d, p in listed.items() if d not in days)
    one = packed.filter(F.col(silver.EVENT_DATE) == date(2024, 1, 25))
    assert one.count() == raw.filter(F.col(silver.EVENT_DATE) == date(2024, 1, 25)).count() > 0


def test_bins_are_filled(spark, table):
    """Small bins: every packed file holds about one bin, and no row moves between tasks."""
    raw = spark.read.parquet(table.raw)
    day, paths = max(table._files(raw).items(), key=lambda item: len(item[1]))
    table.target_bytes = 2 * max(sizes(spark, paths))
    table.compact(spark, FAR)
    made = spark.read.parquet(table.store.path(day, table.store.newest(spark).runs[day][0])).inputFiles()
    assert 1 < len(made) < len(paths)
    assert rows_of(table.read(spark)) == rows_of(raw)


def sizes(spark, paths):
    at = [spark._jvm.org.apache.hadoop.fs.Path(path) for path in paths]
    system = at[0].getFileSystem(spark._jsc.hadoopConfiguration())
    return [system.getFileStatus(path).getLen() for path in at]


def test_a_compaction_that_dies_changes_nothing(spark, table):
    class Dying(CompactedTable):
        def _publish(self, spark, pointer):
            raise RuntimeError("stopped before publication")

    before = rows_of(spark.read.parquet(table.raw))
    dying = Dying(table.raw, table.store.base, table.partition)
    with pytest.raises(RuntimeError):
        dying.compact(spark, FAR)
    assert table.store.newest(spark) is None and rows_of(table.read(spark)) == before
    days = table.compact(spark, FAR)
    assert rows_of(table.read(spark)) == before
    for day in days:
        assert len(files.names(spark, f"{table.store.base}/runs/{day}")) == 1
    assert len(files.names(spark, f"{table.store.base}/sources")) == len(days)


def test_late_files_are_read_and_packed_later(spark, given):
    base = new_folder(spark, "late")
    stored = silver.stored(given).persist()
    day = F.col(silver.EVENT_DATE) == date(2024, 1, 11)

    def put(rows):
        rows.repartition(2).write.mode("append").partitionBy(silver.EVENT_DATE).parquet(f"{base}/silver")

    put(stored.filter(~day | (F.col("hour_utc") < 12)))
    table = CompactedTable(f"{base}/silver", f"{base}/compacted", silver.EVENT_DATE)
    table.compact(spark, FAR)
    put(stored.filter(day & (F.col("hour_utc") >= 12)))
    assert rows_of(table.read(spark)) == rows_of(stored)
    assert table.compact(spark, FAR) == ["2024-01-11"]
    assert rows_of(table.read(spark)) == rows_of(stored)
    assert table.compact(spark, FAR) == []


def test_undated_rows_stay_in_the_table(spark, given):
    base = new_folder(spark, "undated")
    odd = silver.stored(given.limit(30).withColumn("timestamp", F.col("timestamp") * 1000)).unionByName(
        silver.stored(given.limit(50))
    ).persist()
    odd.repartition(3).write.partitionBy(silver.EVENT_DATE).parquet(f"{base}/silver")
    table = CompactedTable(f"{base}/silver", f"{base}/compacted", silver.EVENT_DATE)
    table.compact(spark, FAR)
    assert rows_of(table.read(spark)) == rows_of(odd)
