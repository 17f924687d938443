"""The last report of each flight in each interval of event time, as a stream.

A flight is reported again with every poll; this keeps one report per flight and interval. The state is
one row for each flight and open interval: an interval closes when the watermark, the newest event time
less ``late``, passes its end; its rows are then sent and dropped. Reports that come later than that are
left out, repeated ones change nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tailwake.functions import timing

EVENT_TIME = "event_time"


def latest_reports(reports: DataFrame, every: str = "1 minute", late: str = "10 minutes") -> DataFrame:
    """``reports``, a stream or a table, with one row per flight and interval: the newest by time of the
    report, then by time of its arrival, then by the other columns. Reports without a plausible time
    have no interval and are left out."""
    dated = reports.filter(timing.utc_date(F.col("timestamp")).isNotNull())
    timed = dated.withColumn(EVENT_TIME, F.timestamp_seconds("timestamp")).withWatermark(EVENT_TIME, late)
    first = ["timestamp", "ingested_at"]
    order = F.struct(*first, *[c for c in reports.columns if c not in first])
    newest = timed.groupBy("flight_id", F.window(EVENT_TIME, every)).agg(F.max(order).alias("newest"))
    return newest.select(*[F.col("newest")[c].alias(c) for c in reports.columns])
