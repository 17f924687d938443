"""Airline performance index (0-100)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tailwake import constants as K
from tailwake.functions.bands import at_least, capped, weighted


def performance_index(
    on_time: Column, delay_min: Column, critical: Column, fdi: Column, res: Column
) -> Column:
    """Rates are fractions, ``delay_min`` minutes, ``fdi`` and ``res`` 0-100 averages."""
    raw = weighted(
        [
            (on_time, 40.0),
            (1.0 - capped(delay_min / F.lit(120.0)), 25.0),
            (1.0 - critical, 20.0),
            (1.0 - capped(fdi / F.lit(100.0)), 10.0),
            (1.0 - capped(res / F.lit(100.0)), 5.0),
        ]
    )
    return F.round(F.least(F.greatest(raw, F.lit(0.0)), F.lit(100.0)), 1)


def performance_band(score: Column) -> Column:
    return at_least(score, [(80, K.EXCELLENT), (60, K.GOOD), (40, K.FAIR)], K.POOR)
