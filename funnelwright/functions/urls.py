"""Page addresses and their query parameters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .keys import as_column

# Fixed value: the parts removed from an address.
SCHEME_OR_WWW = r"(http[s]?://|www\.)"


def bare_page(url: str | Column) -> Column:
    """Address without scheme, ``www.`` and everything from the first ``?``."""
    return F.regexp_replace(F.substring_index(as_column(url), "?", 1), SCHEME_OR_WWW, "")


def query_value(url: str | Column, name: str) -> Column:
    """First alphanumeric run after ``name=``; NULL when there is none."""
    return F.nullif(F.regexp_extract(as_column(url), f"{name}=([A-Za-z0-9]+)", 1), F.lit(""))


def host_part(page: str | Column) -> Column:
    """Text before the first ``/``."""
    return F.substring_index(as_column(page), "/", 1)


def is_not_matching(text: str | Column, pattern: str) -> Column:
    """True only when the text is present and does not match (three-valued IS FALSE)."""
    return F.coalesce(~as_column(text).rlike(pattern), F.lit(False))
