"""Ordered rules compiled to one CASE expression."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from .keys import as_column


def classify(rules: Iterable[tuple[Column, object]], default: object = None) -> Column:
    """The result of the first rule whose condition is true, else ``default``."""
    chain = None
    for condition, result in rules:
        value = result if isinstance(result, Column) else F.lit(result)
        chain = F.when(condition, value) if chain is None else chain.when(condition, value)
    fallback = default if isinstance(default, Column) else F.lit(default)
    return fallback if chain is None else chain.otherwise(fallback)


def remap(c: str | Column, mapping: Mapping[str, str]) -> Column:
    """Replace listed values, keep the others."""
    col = as_column(c)
    return classify([(col == old, new) for old, new in mapping.items()], default=col)


def capped(c: str | Column, limit: int, when: Column) -> Column:
    """``limit`` for larger values where ``when`` holds."""
    col = as_column(c)
    return F.when((col > limit) & when, F.lit(limit).cast("bigint")).otherwise(col)


def present(c: str | Column) -> Column:
    """Non-empty text; NULL counts as empty."""
    return F.coalesce(as_column(c) != "", F.lit(False))
