"""Bronze and silver layers; batch and stream share these functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tailwake import schemas as S
from tailwake.functions import timing
from tailwake.operators import reports as R
from tailwake.plans.training import apply_models


EVENT_DATE = "event_date"


def bronze(parsed: DataFrame) -> DataFrame:
    """Parsed reports as they came, with the UTC date of the report as partition."""
    return parsed.select(
        *S.BRONZE_COLUMNS, timing.utc_date(F.col("timestamp")).alias("ingestion_date")
    )


def enrich(
    parsed: DataFrame, delay: Column | None = None, delay_model=None, cluster_model=None
) -> DataFrame:
    """Cleaned reports with features, delay and impact.

    The delay is ``delay`` where given, else the model's, else the rule-based one; the spatial
    cluster is -1 without a model.
    """
    featured = R.add_features(R.clean_reports(parsed))
    delayed = apply_models(featured, delay_model, cluster_model, delay)
    return R.add_impact(delayed)


def silver(enriched: DataFrame) -> DataFrame:
    """The silver columns, with the date of processing as partition."""
    return enriched.select(*S.SILVER_COLUMNS, F.current_date().alias("processing_date"))


def stored(enriched: DataFrame) -> DataFrame:
    """Silver as it is stored: with all that the live view and the messages need, and the UTC date
    of the report, by which it is partitioned, so that a refresh of a few days finds them. The date
    of processing is a plain column."""
    more = [c for c in S.ENRICHED_COLUMNS if c not in S.SILVER_COLUMNS]
    return enriched.select(
        *S.SILVER_COLUMNS,
        *more,
        F.current_date().alias("processing_date"),
        timing.utc_date(F.col("timestamp")).alias(EVENT_DATE),
    )


def rebuild_silver(bronze_rows: DataFrame, **models) -> DataFrame:
    """Silver from bronze, for a replay after a change of rules or models."""
    return silver(enrich(bronze_rows, **models))
