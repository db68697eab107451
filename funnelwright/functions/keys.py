"""Hash keys, text keys and defaults for missing text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

NOT_SET = "(not set)"


def as_column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def not_set(c: str | Column, default: str = NOT_SET) -> Column:
    """Text with a default for NULL."""
    return F.coalesce(as_column(c), F.lit(default))


def joined(*parts: str | Column, delimiter: str = "") -> Column:
    """Concatenated text; NULL as soon as one part is NULL.

    Without a delimiter ``ab``+``c`` and ``a``+``bc`` give the same key. That is the
    established form of the stored hashes; pass a delimiter for new tables.
    """
    texts = [as_column(p).cast("string") for p in parts]
    if delimiter:
        texts = reduce(lambda acc, t: acc + [F.lit(delimiter), t], texts[1:], texts[:1])
    return F.concat(*texts)


def utm_key(source, medium, campaign, term, content, delimiter: str = "") -> Column:
    """MD5 hex of the five campaign fields, missing ones defaulted."""
    return F.md5(joined(*map(not_set, (source, medium, campaign, term, content)), delimiter=delimiter))


def sha_key(*parts: str | Column, delimiter: str = "") -> Column:
    """SHA-256 hex of the concatenated parts; NULL when a part is NULL."""
    return F.sha2(joined(*parts, delimiter=delimiter), 256)


def first_present(*cols: str | Column) -> Column:
    return F.coalesce(*map(as_column, cols))
