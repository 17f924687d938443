"""Classes the alert table and the headline figures are shown with."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tailwake import constants as K
from tailwake.functions.bands import at_least


def fdi_severity(fdi: Column) -> Column:
    """Alert colour; its limits are not those of the delay-index bands."""
    return at_least(fdi, [(30, "RED"), (15, "AMBER")], "NONE")


def ripple_advice(band: Column) -> Column:
    return (
        F.when(band.isin(*K.ELEVATED), "SPREADS")
        .when(band == K.MODERATE, "MAY SPREAD")
        .otherwise("SAFE")
    )


def first_nonzero(*values: Column) -> Column:
    """First value that is neither null nor zero, else zero."""
    return F.coalesce(*[F.nullif(value, F.lit(0)) for value in values], F.lit(0))
