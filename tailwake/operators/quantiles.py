"""Exact quantiles by counting into ever finer ranges.

Each pass counts the values between two bounds into ``bins`` equal ranges, with the smallest and
largest value of each, and keeps for every quantile the one range that holds its rank. Bounds are values
of the data, so a range of equal values ends the search, whatever share of the rows it holds, and every
other pass leaves at least two ranges. Passes divide the width by ``bins``, so a few are enough; no
sort, no shuffle of rows, and what comes to the driver is at most ``bins`` rows a quantile.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BINS = 4096
LARGEST = 1.7976931348623157e308


def _bin(value: Column, low: float, high: float, bins: int) -> Column:
    """Range of a value between the bounds, null outside. The lower bound is in the first, the upper
    in the last."""
    scale = 1.0 if math.isfinite(high - low) else 0.25
    share = (value * scale - low * scale) / F.lit(high * scale - low * scale)
    place = F.least(F.floor(share * bins), F.lit(bins - 1).cast("bigint"))
    return F.when(value.between(low, high), place)


def exact_quantiles(
    rows: DataFrame, value: str, shares: Sequence[float], bins: int = BINS
) -> list[float | None]:
    """For each share the smallest value whose rank reaches it; ``None`` without values.

    Nulls and NaN are left out; infinite values count as the largest finite ones. ``rows`` is read once
    for each pass, so it should start from a table.
    """
    number = F.col(value).cast("double")
    finite = F.greatest(F.least(number, F.lit(LARGEST)), F.lit(-LARGEST))
    values = rows.filter(number.isNotNull() & ~F.isnan(number)).select(finite.alias("value"))
    whole = values.agg(F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high")).first()
    if not whole["n"]:
        return [None] * len(shares)
    # For each share: the bounds that hold it, and its rank among the values between them.
    search = [(whole["low"], whole["high"], max(1, math.ceil(share * whole["n"]))) for share in shares]
    while True:
        todo = [i for i, (low, high, _) in enumerate(search) if low < high]
        if not todo:
            return [low for low, _, _ in search]
        places = F.array(
            *[F.struct(F.lit(i).alias("of"), _bin(F.col("value"), *search[i][:2], bins).alias("bin")) for i in todo]
        )
        counted = (
            values.select("value", F.explode(places).alias("place"))
            .filter("place.bin IS NOT NULL")
            .groupBy("place.of", "place.bin")
            .agg(F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))
            .collect()
        )
        ranges = {i: sorted((r["bin"], r["n"], r["low"], r["high"]) for r in counted if r["of"] == i) for i in todo}
        for i in todo:
            rank = search[i][2]
            for _, n, low, high in ranges[i]:
                if rank <= n:
                    search[i] = (low, high, rank)
                    break
                rank -= n
