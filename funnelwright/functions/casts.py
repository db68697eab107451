"""Casts that answer zero or NULL instead of failing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .keys import as_column


def int_or_zero(c: str | Column) -> Column:
    """Numeric text truncated toward zero; anything else is 0."""
    return F.coalesce(as_column(c).try_cast("double").try_cast("bigint"), F.lit(0).cast("bigint"))


def float_or_zero(c: str | Column) -> Column:
    """Numeric text as a double; NULL, NaN and bad text are 0."""
    return F.nanvl(F.coalesce(as_column(c).try_cast("double"), F.lit(0.0)), F.lit(0.0))


def rounded_int(c: str | Column) -> Column:
    """Number as an integer, rounded half away from zero (a bare cast truncates)."""
    return F.round(as_column(c)).cast("bigint")


def timestamp_or_null(c: str | Column) -> Column:
    return F.try_to_timestamp(as_column(c))


def day_or_null(c: str | Column) -> Column:
    return F.to_date(F.try_to_timestamp(as_column(c)))


def units_from_micros(c: str | Column) -> Column:
    return as_column(c) / F.lit(1_000_000.0)
