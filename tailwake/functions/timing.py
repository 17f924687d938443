"""Clock features of an epoch-seconds column, independent of the session time zone."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from tailwake import constants as K
from tailwake.functions.bands import flag, within

DAY_S = 86400
#: 2100-01-01, the first time that no report can have.
PLAUSIBLE_END_S = 4102444800


def slice_of(ts: Column, width_s: int) -> Column:
    """Index of the ``width_s`` second slice that holds ``ts``."""
    return F.floor(ts / F.lit(width_s)).cast("long")


def hour_utc(ts: Column) -> Column:
    return F.floor(F.pmod(ts, F.lit(DAY_S)) / F.lit(3600)).cast("int")


def day_of_week(ts: Column) -> Column:
    """1 = Sunday ... 7 = Saturday (1970-01-01 was a Thursday)."""
    return (F.pmod(slice_of(ts, DAY_S) + 4, F.lit(7)) + 1).cast("int")


def utc_date(ts: Column) -> Column:
    """UTC date of epoch seconds; null outside 1970 to 2099.

    A time in milli- or microseconds, or a negative one, has no date: it would make partitions
    without end, or overflow the day number and stop a stream for good.
    """
    plausible = F.when((ts >= 0) & (ts < PLAUSIBLE_END_S), ts)
    return F.date_add(F.lit(date(1970, 1, 1)), slice_of(plausible, DAY_S).cast("int"))


def epoch_of_day(day: date) -> int:
    """Epoch second at which a UTC day starts."""
    return (day - date(1970, 1, 1)).days * DAY_S


def is_peak_hour(hour: Column) -> Column:
    return flag(within(hour, K.MORNING_PEAK, K.EVENING_PEAK))


def is_weekend(weekday: Column) -> Column:
    return flag(weekday.isin(1, 7))


def traffic_density(hour: Column, weekday: Column) -> Column:
    by_hour = (
        F.when(within(hour, K.MORNING_PEAK), 8)
        .when(within(hour, K.EVENING_PEAK), 9)
        .when(within(hour, K.MIDDAY), 6)
        .otherwise(3)
    )
    return by_hour + F.when(within(weekday, K.WEEKDAYS), 1).otherwise(0)


def iso_utc(ts: Column) -> Column:
    """ISO-8601 text with a ``Z`` for an epoch-seconds column."""
    day = F.date_format(utc_date(ts), "yyyy-MM-dd")
    second = F.pmod(ts, F.lit(DAY_S)).cast("int")
    clock = [
        F.lpad(F.floor(second / F.lit(unit)).cast("long") % size, 2, "0")
        for unit, size in ((3600, 24), (60, 60), (1, 60))
    ]
    return F.concat(day, F.lit("T"), F.concat_ws(":", *clock), F.lit("Z"))
