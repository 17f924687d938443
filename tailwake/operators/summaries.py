"""One-row and few-row summaries. All are partial-then-final aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tailwake import constants as K
from tailwake.functions import bands, flight
from tailwake.operators.quantiles import exact_quantiles
from tailwake.sources.workspace import materialize


def _or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))


def batch_stats(rows: DataFrame) -> DataFrame:
    """Counts and averages of a batch of enriched reports; an empty batch gives zeros.

    The delay is averaged over all rows, index, passengers and compensation count delayed rows
    only.
    """
    category = F.col("delay_category")
    delayed = flight.is_delayed(category)

    def of_delayed(name: str) -> Column:
        return F.when(delayed, F.col(name))

    return rows.agg(
        F.count(F.lit(1)).alias("total_flights"),
        bands.count_where(delayed).alias("delayed_flights"),
        bands.count_where(category == K.CRITICAL_DELAY).alias("critical_flights"),
        bands.count_where(F.col("fdi_category").isin(*K.ELEVATED)).alias("high_fdi_flights"),
        F.round(_or_zero(F.avg(_or_zero(F.col("predicted_delay_minutes")))), 1).alias(
            "avg_delay_minutes"
        ),
        F.round(_or_zero(F.avg(of_delayed("fdi"))), 1).alias("avg_fdi"),
        _or_zero(F.sum(of_delayed("affected_passengers"))).alias("total_affected_passengers"),
        _or_zero(F.sum(of_delayed("estimated_compensation_eur"))).alias(
            "total_estimated_compensation_eur"
        ),
    )


def aggregate_impact(flights: DataFrame) -> DataFrame:
    """Fleet impact of a live view with ripple scores; delayed flights carry the sums."""
    delayed = flight.is_delayed_served(F.col("delay_category"))

    def of_delayed(name: str) -> Column:
        return F.when(delayed, F.col(name))

    return flights.agg(
        F.count(F.lit(1)).alias("total_flights"),
        bands.count_where(F.col("fdi_category").isin(*K.ELEVATED)).alias("high_fdi_flights"),
        bands.count_where(F.col("delay_category") == K.CRITICAL_DELAY).alias(
            "critical_delay_flights"
        ),
        bands.count_where(F.col("res_category").isin(*K.ELEVATED)).alias("high_res_flights"),
        _or_zero(F.sum(of_delayed("affected_passengers"))).alias("total_affected_passengers"),
        _or_zero(F.sum(of_delayed("estimated_compensation_eur"))).alias(
            "total_estimated_compensation_eur"
        ),
        _or_zero(F.avg(of_delayed("fdi"))).alias("avg_fdi"),
        _or_zero(F.avg("res")).alias("avg_res"),
    )


def kpi_header(impact: DataFrame, stats: DataFrame) -> DataFrame:
    """Headline figures: the impact value, else the batch value, else zero (both one row)."""
    pairs = {
        "critical_delay_flights": "critical_flights",
        "total_estimated_compensation_eur": "total_estimated_compensation_eur",
        "total_affected_passengers": "total_affected_passengers",
        "avg_fdi": "avg_fdi",
    }
    from_impact = impact.select(
        F.lit(1).alias("source"), *[F.col(a).alias(a) for a in pairs]
    )
    from_stats = stats.select(F.lit(2).alias("source"), *[F.col(b).alias(a) for a, b in pairs.items()])
    both = from_impact.unionByName(from_stats)

    def figure(name: str) -> Column:
        useful = (F.col(name) != 0) & F.col(name).isNotNull()
        return _or_zero(F.min_by(name, F.when(useful, F.col("source")))).alias(name)

    return both.agg(*[figure(name) for name in pairs])


def label_summary(rows: DataFrame, label: str = "delay_minutes"):
    """Mean, sample deviation, range and median of the label, to two decimals.

    The median is exact, the lower one of an even number of rows. It is found from counts per
    value; labels have one decimal, so there are a few thousand values at most.
    """
    value = F.col(label)
    return rows.agg(
        *[
            F.round(figure.cast("double"), 2).alias(name)
            for name, figure in {
                "mean": F.mean(value),
                "stddev": F.stddev(value),
                "min": F.min(value),
                "max": F.max(value),
                "median": F.expr(f"percentile_disc(0.5) WITHIN GROUP (ORDER BY `{label}`)"),
            }.items()
        ]
    )


def delay_category_distribution(rows: DataFrame, label: str = "delay_minutes") -> DataFrame:
    return (
        rows.groupBy(flight.delay_category(F.col(label)).alias("delay_category"))
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy("delay_category")
    )


def _error(label: str, prediction: str) -> Column:
    return F.col(label).cast("double") - F.col(prediction).cast("double")


def error_distribution(
    rows: DataFrame, label: str = "delay_minutes", prediction: str = "prediction"
) -> DataFrame:
    """Mean, median and 90th percentile of the absolute error, exact at any size
    (``operators.quantiles``)."""
    errors = materialize(rows.select(F.abs(_error(label, prediction)).alias("error")), "errors")
    median, p90 = exact_quantiles(errors, "error", (0.5, 0.9))
    return errors.agg(
        F.round(F.mean("error"), 2).alias("mean_abs_error"),
        F.round(F.lit(median).cast("double"), 2).alias("median_abs_error"),
        F.round(F.lit(p90).cast("double"), 2).alias("p90_abs_error"),
    )


def regression_metrics(
    rows: DataFrame, label: str = "delay_minutes", prediction: str = "prediction"
) -> DataFrame:
    """RMSE, MAE and R2 in one pass; R2 is null where all labels are equal."""
    error = _error(label, prediction)
    squares = F.sum(error * error)
    spread = F.var_pop(F.col(label).cast("double")) * F.count(F.lit(1))
    return rows.agg(
        F.round(F.sqrt(F.avg(error * error)), 4).alias("rmse"),
        F.round(F.avg(F.abs(error)), 4).alias("mae"),
        F.round(1 - F.try_divide(squares, spread), 4).alias("r2"),
    )


def prediction_sample(
    rows: DataFrame,
    n: int = 15,
    label: str = "delay_minutes",
    prediction: str = "prediction",
    key: tuple[str, ...] = ("flight_id", "ingested_at"),
) -> DataFrame:
    """``n`` rows of actual beside predicted minutes, the first by ``key``."""
    return rows.select(
        *key,
        "aircraft_model",
        "airline_icao",
        F.round(label, 1).alias("actual_min"),
        F.round(prediction, 1).alias("predicted_min"),
        F.round(F.abs(_error(label, prediction)), 1).alias("error_min"),
        flight.delay_category(F.col(prediction)).alias("pred_category"),
    ).orderBy(*key).limit(n)
