"""Small builders for banded values, flags and weighted sums."""

from __future__ import annotations

import operator
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tailwake import constants as K


def _ladder(compare, value: Column, rungs, otherwise) -> Column:
    chain = F
    for bound, result in rungs:
        chain = chain.when(compare(value, bound), result)
    return chain.otherwise(otherwise)


def below(value: Column, rungs, otherwise) -> Column:
    """First result whose bound is strictly above ``value``; null falls to ``otherwise``."""
    return _ladder(operator.lt, value, rungs, otherwise)


def up_to(value: Column, rungs, otherwise) -> Column:
    """First result whose bound is at or above ``value``; null falls to ``otherwise``."""
    return _ladder(operator.le, value, rungs, otherwise)


def at_least(value: Column, rungs, otherwise) -> Column:
    """First result whose bound is at or below ``value``; null falls to ``otherwise``."""
    return _ladder(operator.ge, value, rungs, otherwise)


def above(value: Column, rungs, otherwise) -> Column:
    """First result whose bound is strictly below ``value``; null falls to ``otherwise``."""
    return _ladder(operator.gt, value, rungs, otherwise)


def within(value: Column, *ranges) -> Column:
    """True inside any of the inclusive ranges."""
    return reduce(operator.or_, [value.between(lo, hi) for lo, hi in ranges])


def flag(condition: Column) -> Column:
    return condition.cast("int")


def capped(value: Column, top: float = 1.0) -> Column:
    """``value`` but never above ``top``; there is no lower bound, and null gives ``top``."""
    return F.least(value, F.lit(top))


def weighted(terms) -> Column:
    """Sum of column x weight, added in the order given."""
    return reduce(operator.add, [column * weight for column, weight in terms])


def count_where(condition: Column) -> Column:
    """Rows where the condition holds; 0 (not null) when there are none."""
    return F.count_if(condition)


def real(value: Column) -> Column:
    return value.cast("float")


def score_band(value: Column) -> Column:
    """LOW / MODERATE / HIGH / CRITICAL for a 0-100 score."""
    return up_to(value, [(25, K.LOW), (50, K.MODERATE), (75, K.HIGH)], K.CRITICAL)
