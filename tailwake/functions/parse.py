"""Tolerant number parsing for text that was never validated."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A number followed by a Java type suffix is text, not a number.
_TYPE_SUFFIX = r"(?i)[0-9.][df]\s*$"


def _number(text: Column) -> Column:
    return F.when(~text.rlike(_TYPE_SUFFIX), text).try_cast("double")


def to_double(text: Column, default: float = 0.0) -> Column:
    """Number in a text column, ``default`` when it is missing or not a number."""
    return F.coalesce(_number(text), F.lit(default))


def to_int(text: Column, default: int = 0) -> Column:
    """Whole part of a number in a text column, ``default`` when there is none."""
    return F.coalesce(_number(text).try_cast("int"), F.lit(default))
