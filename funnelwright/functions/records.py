"""Lookups in repeated records carried by a row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .casts import int_or_zero
from .keys import as_column


def param(params: str | Column, key: str, field: str) -> Column:
    """``value.<field>`` of the first entry with this key, NULL when absent."""
    hit = F.get(F.filter(as_column(params), lambda p: p["key"] == key), 0)
    return hit["value"][field]


def action_count(actions: str | Column, action_type: str) -> Column:
    """Integer value of the last entry of this type; 0 when absent or unreadable."""
    same = F.filter(as_column(actions), lambda a: a["action_type"] == action_type)
    return int_or_zero(F.try_element_at(same, F.lit(-1))["value"])


def action_map(actions: str | Column) -> Column:
    """All types of the record as a map; the last entry of a type wins.

    Entries are sorted by type and place, so that the last of a type is the one before another type.
    """
    usable = F.filter(as_column(actions), lambda a: F.coalesce(a["action_type"] != "", F.lit(False)))
    placed = F.transform(usable, lambda a, i: F.struct(a["action_type"].alias("t"), i.alias("i"), a["value"].alias("v")))
    ordered = F.array_sort(placed)
    following = F.slice(ordered, F.lit(2), F.greatest(F.size(ordered), F.lit(1)))
    last = F.zip_with(
        ordered, following, lambda x, y: F.when(y.isNull() | (y["t"] != x["t"]), F.struct(x["t"], int_or_zero(x["v"])))
    )
    return F.map_from_entries(F.array_compact(last))
