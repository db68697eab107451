"""Joins that keep NULL and hot keys from gathering in one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .dedupe import any_null


def spread_null_keys(df: DataFrame, keys: Sequence[str], spread_by: Sequence[str] | None = None) -> DataFrame:
    """Add ``_spread``: 0 for complete keys, a row hash where a key is NULL.

    Rows with a NULL key match nothing but are shuffled by that key all the same. Joining on
    ``keys + ['_spread']`` distributes them and changes no result.
    """
    cols = spread_by or [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    return df.withColumn(
        "_spread", F.when(any_null(keys), F.xxhash64(*cols)).otherwise(F.lit(0).cast("long"))
    )


def keyed_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """``left``, ``left_anti`` or ``left_semi`` join by equality, NULL keys spread."""
    if how not in {"left", "left_anti", "left_semi"}:
        raise ValueError(f"unsupported join type {how!r}")
    on = [*keys, "_spread"]
    return spread_null_keys(left, keys).join(spread_null_keys(right, keys), on, how).drop("_spread")


def not_in(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``left`` whose key does not occur in ``right``; NULL keys always stay."""
    return keyed_join(left, right.select(*keys), keys, "left_anti").select(*left.columns)


def full_join_chain(frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Full outer joins one after the other; each key is the first present one so far."""
    return reduce(lambda acc, df: acc.join(df, list(keys), "full"), frames)


def candidate_full_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[tuple[str, str]],
    left_texts: Sequence[Column],
    right_texts: Sequence[Column],
    distinct: bool = False,
) -> DataFrame:
    """Full outer join on equal keys AND any left text equal to any right text.

    Written as an OR the join could only be distributed by the plain keys. Here every
    text becomes a row, so it is an ordinary full join on keys plus text, which reads each side once. A pair found
    also says of both its rows that they are matched; one grouping by (left row, right row) then
    leaves each pair once and each row without any pair once. Rows that a side repeats travel as
    one row with a count; ``distinct`` says that neither side repeats any.
    Column names of the two sides must not overlap, and no column may be a map.
    """
    lhs = _by_text(left, [l for l, _ in on], left_texts, "_l", distinct)
    rhs = _by_text(right, [r for _, r in on], right_texts, "_r", distinct)
    same = reduce(lambda a, b: a & b, (lhs[f"_l{n}"] == rhs[f"_r{n}"] for n in range(len(on) + 2)))
    none_l, none_r = (F.lit(None).cast(df.schema[c].dataType) for df, c in ((lhs, "_l"), (rhs, "_r")))
    outcome = lambda l, r, matched: F.struct(l.alias("l"), r.alias("r"), F.lit(matched).alias("matched"))
    l, r = F.col("_l"), F.col("_r")
    outcomes = F.when(
        l.isNotNull() & r.isNotNull(), F.array(outcome(l, r, True), outcome(l, none_r, True), outcome(none_l, r, True))
    ).otherwise(F.array(outcome(l, r, False)))
    found = (
        lhs.join(rhs, same, "full")
        .select(F.inline(outcomes))
        .groupBy("l", "r")
        .agg(F.bool_or("matched").alias("matched"))
        .where((F.col("l").isNotNull() & F.col("r").isNotNull()) | ~F.col("matched"))
    )
    if not distinct:
        copies = F.coalesce("l._copies", F.lit(1)) * F.coalesce("r._copies", F.lit(1))
        found = found.select("l", "r", F.explode(F.sequence(F.lit(1), copies)))
    return found.select(
        *(F.col("l").getField(c).alias(c) for c in left.columns), *(F.col("r").getField(c).alias(c) for c in right.columns)
    )


def _by_text(df: DataFrame, keys: Sequence[str], texts: Sequence[Column], row: str, distinct: bool) -> DataFrame:
    """A row per text (or one without any): the keys, the text and the spread of NULLs numbered, and the whole row."""
    rows = df if distinct else df.groupBy(*df.columns).agg(F.count(F.lit(1)).cast("int").alias("_copies"))
    every = F.array_distinct(F.array_compact(F.array(*texts)))
    exploded = rows.select(F.struct(*rows.columns).alias(row), *keys, F.explode_outer(every).alias("_t"))
    spread = spread_null_keys(exploded, [*keys, "_t"], [row])
    return spread.select(row, *(F.col(c).alias(f"{row}{n}") for n, c in enumerate([*keys, "_t", "_spread"])))
