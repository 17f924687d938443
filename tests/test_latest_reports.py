"""One report per flight and interval, from a stream with late and repeated reports."""

from pyspark.sql import functions as F

from tailwake.sources.workspace import new_folder
from tailwake.streaming import jobs
from tailwake.streaming.latest_reports import latest_reports

SCHEMA = "flight_id string, timestamp bigint, ingested_at string, altitude_ft int"
T = 1704067200  # a full hour


def run(spark, base):
    """One run over the files that have come since the last; the rows so far and the query."""
    source = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", "1").json(f"{base}/in")
    latest = latest_reports(source, every="1 minute", late="2 minutes")
    query = jobs._append(latest, "latest", f"{base}/ck", jobs.ONCE, "parquet", f"{base}/out")
    jobs.drain(query)
    rows = spark.read.schema(SCHEMA).parquet(f"{base}/out").collect()
    return sorted(tuple(r) for r in rows), query


def put(spark, base, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").json(f"{base}/in")


def test_late_and_repeated_reports(spark):
    base = new_folder(spark, "latest")
    put(spark, base, [("A", T + 5, "1", 10), ("A", T + 50, "2", 20), ("A", T + 50, "3", 30), ("B", T + 10, "1", 1)])
    rows, _ = run(spark, base)
    assert rows == []  # the interval is open
    put(spark, base, [("A", T + 50, "3", 30), ("A", T + 55, "4", 40), ("A", T + 70, "5", 50), ("A", T * 1000, "x", 9)])
    put(spark, base, [("B", T + 300, "6", 2)])
    first = [("A", T + 55, "4", 40), ("A", T + 70, "5", 50), ("B", T + 10, "1", 1)]
    rows, _ = run(spark, base)
    assert rows == first
    # Too late for its interval; and repeated after it was sent.
    put(spark, base, [("A", T + 59, "7", 60), ("A", T + 55, "4", 40), ("B", T + 301, "8", 3)])
    put(spark, base, [("C", T + 900, "9", 4)])
    rows, query = run(spark, base)
    assert rows == sorted([*first, ("B", T + 301, "8", 3)])
    state = query.lastProgress["stateOperators"][0]
    assert state["numRowsTotal"] == 1  # C alone is open


def test_state_is_bounded(spark):
    """Many intervals pass; the state holds the open ones only."""
    base = new_folder(spark, "bounded")
    for batch in range(5):
        put(spark, base, [(f"F{n}", T + 600 * batch + n % 60, "1", n) for n in range(200)])
    rows, query = run(spark, base)
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 200
    assert len(rows) == 4 * 200


def test_as_a_table(spark):
    table = spark.createDataFrame([("A", T, "1", 1), ("A", T + 59, "2", 2), ("A", T + 60, "3", 3), (None, T, "4", 4)], SCHEMA)
    got = latest_reports(table).orderBy(F.col("timestamp"), F.col("altitude_ft")).collect()
    assert [r.altitude_ft for r in got] == [4, 2, 3]
