"""Exact quantiles against sorting."""

import math
import random

import pytest

from tailwake.operators import summaries
from tailwake.operators.quantiles import exact_quantiles

SHARES = (0.0, 0.1, 0.5, 0.9, 1.0)


def ranked(values, share):
    values = sorted(v for v in values if v is not None and not math.isnan(v))
    return values[max(1, math.ceil(share * len(values))) - 1] if values else None


def cases():
    rng = random.Random(2)
    return {
        "even": [rng.random() for _ in range(3000)],
        "skew": [rng.paretovariate(0.3) for _ in range(3000)],
        "one value": [7.25] * 1000,
        "ties": [rng.choice([0.0, 1.0, 1.0, 2.5]) for _ in range(2000)],
        "a third in one": [3.0] * 1000 + [rng.gauss(0, 1) for _ in range(2000)],
        "wide": [rng.choice([-1, 1]) * 10.0 ** rng.randint(-300, 300) for _ in range(2000)],
        "close": [1.0 + rng.randint(0, 50) * 2.0**-52 for _ in range(500)],
        "tiny": [rng.randint(0, 9) * 5e-324 for _ in range(100)],
        "largest": [-1.7976931348623157e308, 1.7976931348623157e308, 0.0, 1.0],
        "odd": [None, math.nan, 1.0, 2.0, None, 3.0, -0.5],
        "nothing": [None, math.nan],
        "empty": [],
    }


@pytest.mark.parametrize("name", sorted(cases()))
@pytest.mark.parametrize("bins", [16, 4096])
def test_against_sorting(spark, name, bins):
    values = cases()[name]
    if bins == 16 and name in ("skew", "wide"):
        values = values[:50]  # many passes
    table = spark.createDataFrame([(v,) for v in values], "v double").repartition(3)
    assert exact_quantiles(table, "v", SHARES, bins) == [ranked(values, s) for s in SHARES]


def test_more_rows_than_a_sketch_holds_exactly(spark):
    """200,000 distinct values: the sketch that was used before is inexact here."""
    from pyspark.sql import functions as F

    table = spark.range(200_000).select((F.pmod(F.col("id") * 7919, F.lit(200_003)) / 7).alias("delay_minutes"), F.lit(0.0).alias("prediction"))
    values = [r[0] for r in table.select("delay_minutes").collect()]
    got = summaries.error_distribution(table).first()
    assert got.median_abs_error == pytest.approx(ranked(values, 0.5), abs=0.006)
    assert exact_quantiles(table, "delay_minutes", (0.5, 0.9)) == [ranked(values, 0.5), ranked(values, 0.9)]
    assert got.p90_abs_error == pytest.approx(ranked(values, 0.9), abs=0.006)


def test_errors_of_no_rows(spark):
    table = spark.createDataFrame([], "delay_minutes double, prediction double")
    assert tuple(summaries.error_distribution(table).first()) == (None, None, None)
