"""Message envelopes (key, value, timestamp) in and out, batch or stream."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tailwake import schemas as S


def read_envelope_stream(
    spark: SparkSession,
    fmt: str = "kafka",
    path: str | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Streaming envelopes from a broker (``fmt='kafka'``) or from a folder of files.

    The broker defaults are the live ones: start at the newest offset and keep going over lost
    data. The broker connector is a separate Spark package; file formats need none.
    """
    options = dict(options or {})
    if fmt == "kafka":
        defaults = {"startingOffsets": "latest", "failOnDataLoss": "false"}
        return spark.readStream.format("kafka").options(**{**defaults, **options}).load()
    return spark.readStream.schema(S.ENVELOPE).format(fmt).options(**options).load(path)


def decode_reports(envelopes: DataFrame) -> DataFrame:
    """Parsed and flattened reports; a message that is not JSON becomes an all-null row.

    The parsed record is unpacked by a generator of one row: filters on its fields are not pushed
    below a generator, where each would parse the message again.
    """
    event = F.from_json(F.col("value").cast("string"), S.EVENT)
    return envelopes.select(
        F.col("timestamp").alias("kafka_timestamp"), F.inline(F.array(event))
    ).select(
        "kafka_timestamp",
        *S.REPORT_COLUMNS,
        *[F.col("weather")[name].alias(name) for name in S.WEATHER_COLUMNS],
    )


def nest_weather(reports: DataFrame) -> DataFrame:
    """Reports in the nested wire shape, from the flattened one."""
    return reports.select(
        *S.REPORT_COLUMNS,
        F.struct(*S.WEATHER_COLUMNS).alias("weather"),
    )


def encode(rows: DataFrame, columns: Sequence[str], key: str = "flight_id") -> DataFrame:
    """One JSON message per row, keyed by flight; null fields are left out of the text."""
    return rows.select(
        F.col(key).alias("key"),
        F.to_json(F.struct(*columns)).alias("value"),
    )


def encode_predictions(enriched: DataFrame) -> DataFrame:
    return encode(enriched, S.PAYLOAD_COLUMNS)


def encode_events(events: DataFrame) -> DataFrame:
    """Messages of the input stream, from reports that carry a ``weather`` struct."""
    return encode(events, S.EVENT.names)


def write_envelopes(
    messages: DataFrame, fmt: str = "kafka", path: str | None = None, options=None
) -> None:
    """Batch write of messages to a broker topic or as files."""
    writer = messages.write.format(fmt).options(**dict(options or {})).mode("append")
    writer.save(path) if path else writer.save()
