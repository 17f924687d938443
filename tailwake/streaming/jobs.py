"""Streaming queries from message envelopes to the lake, the live tables and a message sink.

Bronze and silver read the messages; predictions and the live tables read the stored silver table as
a stream, so reports are enriched and scored by the model once. Bronze, silver and predictions are
append queries on Spark's file sink, whose log makes every micro-batch land exactly once, also for
those that read it; each has its own checkpoint and resumes from it. The live tables are kept by one
``foreachBatch`` query (``streaming.live_tables``). An error in a sink fails its query, so no batch
is skipped.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tailwake import schemas as S
from tailwake.plans import silver as layers
from tailwake.plans.incremental import IncrementalGold
from tailwake.plans.models import ScoredSilver
from tailwake.sources import files
from tailwake.sources.envelopes import decode_reports, encode_predictions
from tailwake.streaming.live_tables import LiveTables

INTERVAL = {"processingTime": "10 seconds"}
ONCE = {"availableNow": True}


def _append(
    rows: DataFrame,
    name: str,
    checkpoints: str,
    trigger: Mapping,
    fmt: str = "parquet",
    path: str | None = None,
    partition_by: Sequence[str] = (),
    options: Mapping[str, str] | None = None,
) -> StreamingQuery:
    writer = (
        rows.writeStream.format(fmt)
        .outputMode("append")
        .option("checkpointLocation", f"{checkpoints}/{name}")
        .options(**dict(options or {}))
        .trigger(**trigger)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.start(path) if path else writer.start()


def start_bronze(
    parsed: DataFrame, path: str, checkpoints: str, trigger: Mapping = INTERVAL, fmt: str = "parquet"
) -> StreamingQuery:
    """Parsed reports, uncleaned, partitioned by the date of the report."""
    return _append(
        layers.bronze(parsed), "bronze", checkpoints, trigger, fmt, path, ["ingestion_date"]
    )


def start_silver(
    enriched: DataFrame, path: str, checkpoints: str, trigger: Mapping = INTERVAL, fmt: str = "parquet"
) -> StreamingQuery:
    """Enriched reports, partitioned by the date of the report."""
    rows = layers.stored(enriched)
    return _append(rows, "silver", checkpoints, trigger, fmt, path, [layers.EVENT_DATE])


def start_predictions(
    enriched: DataFrame,
    checkpoints: str,
    trigger: Mapping = INTERVAL,
    fmt: str = "kafka",
    path: str | None = None,
    options: Mapping[str, str] | None = None,
) -> StreamingQuery:
    """Prediction messages to a broker topic, or as files."""
    return _append(
        encode_predictions(enriched), "predictions", checkpoints, trigger, fmt, path,
        options=options,
    )


def start_console(enriched: DataFrame, checkpoints: str, trigger: Mapping = INTERVAL) -> StreamingQuery:
    """Ten rows of each batch on the console, for debugging."""
    return _append(
        enriched.select(*S.CONSOLE_COLUMNS), "console", checkpoints, trigger, "console",
        options={"truncate": "false", "numRows": "10"},
    )


def start_live(
    enriched: DataFrame, tables: LiveTables, checkpoints: str, trigger: Mapping = INTERVAL
) -> StreamingQuery:
    """Live state, rotation index, alerts and batch statistics."""
    return (
        enriched.writeStream.foreachBatch(tables.update)
        .option("checkpointLocation", f"{checkpoints}/live")
        .trigger(**trigger)
        .start()
    )


def start_scored(
    parsed: DataFrame, table: ScoredSilver, checkpoints: str, trigger: Mapping = INTERVAL
) -> StreamingQuery:
    """Silver scored by the newest version of the models, asked for with every batch."""
    return (
        parsed.writeStream.foreachBatch(table.update)
        .option("checkpointLocation", f"{checkpoints}/scored")
        .trigger(**trigger)
        .start()
    )


def start_gold(
    stored: DataFrame, tables: IncrementalGold, checkpoints: str, trigger: Mapping = INTERVAL
) -> StreamingQuery:
    """Gold tables from the stored silver as it grows, refreshed every few minutes."""
    return (
        stored.writeStream.foreachBatch(tables.step)
        .option("checkpointLocation", f"{checkpoints}/gold")
        .trigger(**trigger)
        .start()
    )


def start_all(
    envelopes: DataFrame,
    base: str,
    checkpoints: str,
    trigger: Mapping = INTERVAL,
    delay_model=None,
    cluster_model=None,
    fmt: str = "parquet",
    predictions: Mapping | None = None,
    console: bool = False,
    gold: bool = False,
) -> dict[str, StreamingQuery]:
    """All queries over one source of envelopes; predictions go to files below ``base`` unless
    ``predictions`` names another sink (``fmt``, ``path``, ``options``).

    What follows silver sees a report up to one interval after it is stored. With a trigger that
    ends, silver is waited for before they start.
    """
    parsed = decode_reports(envelopes)
    enriched = layers.enrich(parsed, delay_model=delay_model, cluster_model=cluster_model)
    sink = predictions or {"fmt": "json", "path": f"{base}/predictions"}
    queries = {
        "bronze": start_bronze(parsed, f"{base}/bronze", checkpoints, trigger, fmt),
        "silver": start_silver(enriched, f"{base}/silver", checkpoints, trigger, fmt),
    }
    if "processingTime" not in trigger:
        drain(queries["silver"])
    stored = stored_stream(enriched, f"{base}/silver", fmt)
    queries["predictions"] = start_predictions(stored, checkpoints, trigger, **sink)
    queries["live"] = start_live(stored, LiveTables(f"{base}/live"), checkpoints, trigger)
    if gold:
        queries["gold"] = start_gold(stored, IncrementalGold(f"{base}/gold"), checkpoints, trigger)
    if console:
        queries["console"] = start_console(stored, checkpoints, trigger)
    return queries


def stored_stream(enriched: DataFrame, path: str, fmt: str = "parquet") -> DataFrame:
    """The silver table that ``enriched`` is stored in, as a stream."""
    spark = enriched.sparkSession
    reader = spark.readStream.format(fmt)
    if fmt != "delta":
        files.make_folder(spark, path)
        reader = reader.schema(layers.stored(enriched).schema)
    return reader.load(path)


def await_any(spark: SparkSession, queries: Mapping[str, StreamingQuery]) -> None:
    """Wait until one query ends or fails, then stop the others."""
    try:
        spark.streams.awaitAnyTermination()
    finally:
        for query in queries.values():
            query.stop()


def drain(*queries: StreamingQuery) -> None:
    """Wait for ``availableNow`` queries to finish; raises the error of one that failed."""
    for query in queries:
        query.awaitTermination()
