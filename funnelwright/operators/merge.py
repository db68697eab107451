"""Upserts and other table changes as plain DataFrame expressions.

Every function takes the current content and the incoming rows and returns rows; writing
them is the job of ``sinks.tables``. Keys match by equality, so a NULL key matches nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .dedupe import any_null, latest_per_key
from .joins import keyed_join, not_in, spread_null_keys


def insert_new(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    dedup_batch: bool = False,
    compare_keyless: bool = False,
) -> DataFrame:
    """The source rows to append: those whose key the target lacks.

    A row with a NULL key matches nothing and is always new, unless ``compare_keyless``: then it is
    new if the target has no row equal to it in all columns.
    """
    rows = source
    if dedup_batch:
        rest = [c for c in source.columns if c not in keys]
        rows = latest_per_key(source, keys, rest)
    if not compare_keyless:
        return not_in(rows, target, keys)
    keyless = any_null(keys)
    known = target.where(keyless).select(*(F.col(c).alias(f"_k_{c}") for c in rows.columns))
    equal = F.lit(True)
    for c in rows.columns:
        equal = equal & F.col(c).eqNullSafe(F.col(f"_k_{c}"))
    unknown = rows.where(keyless).join(known, equal, "left_anti")
    return not_in(rows.where(~keyless), target, keys).unionByName(unknown)


def update_changed(target: DataFrame, source: DataFrame, key: str, attribute: str) -> DataFrame:
    """Target with ``attribute`` replaced where the source has a different value.

    Two values for one key in the source are an error for a target row having that key.
    """
    news = source.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.min(attribute).alias("_lo"), F.max(attribute).alias("_hi")
    )
    ambiguous = F.raise_error(F.concat(F.lit("several new values for key "), F.col(key))).cast("string")
    new_value = F.when(F.col("_lo") != F.col("_hi"), ambiguous).otherwise(F.col("_lo"))
    changed = F.col(attribute) != F.col("_new")
    return (
        keyed_join(target, news, [key], "left")
        .withColumn("_new", new_value)
        .withColumn(attribute, F.when(changed, F.col("_new")).otherwise(F.col(attribute)))
        .select(*target.columns)
    )


def checked_source(source: DataFrame, keys: Sequence[str], on_duplicate: str, order_by: Sequence[str]) -> DataFrame:
    """The source, reduced to the latest row of each key if repeated keys are no error."""
    if on_duplicate == "error":
        return source
    if on_duplicate == "latest":
        return latest_per_key(source, keys, order_by)
    raise ValueError(f"unknown on_duplicate {on_duplicate!r}")


def _side_by_side(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows (columns ``_t_*``) and source rows (``_s_*``) joined by key in one full join.

    Several source rows for a target row fail the job; source rows without one may repeat.
    Each side is shuffled once: the count of source rows per key uses the join's distribution.
    """
    of_key = Window.partitionBy(*(f"_s_{k}" for k in keys), "_s_spread")
    left = spread_null_keys(target, keys)
    right = spread_null_keys(source, keys)
    left = left.withColumnRenamed("_spread", "spread").select(*(F.col(c).alias(f"_t_{c}") for c in [*target.columns, "spread"]))
    right = right.withColumnRenamed("_spread", "spread").select(*(F.col(c).alias(f"_s_{c}") for c in [*source.columns, "spread"]))
    right = right.withColumn("_n", F.count(F.lit(1)).over(of_key))
    same = F.col("_t_spread") == F.col("_s_spread")
    for k in keys:
        same = same & (F.col(f"_t_{k}") == F.col(f"_s_{k}"))
    ambiguous = F.raise_error(F.lit("several source rows match one target row")).cast("boolean")
    met = F.col("_t_spread").isNotNull() & F.col("_s_spread").isNotNull()
    return left.join(right, same, "full").where(F.when(met & (F.col("_n") > 1), ambiguous).otherwise(F.lit(True)))


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    on_duplicate: str = "error",
    order_by: Sequence[str] = (),
) -> DataFrame:
    """Source rows replace target rows of the same key; all source rows are inserted.

    A target row matched by several source rows fails the job (``on_duplicate='error'``),
    or the last row by ``order_by`` is taken (``'latest'``).
    """
    return upsert_partial(target, source, keys, target.columns, on_duplicate, order_by)


def upsert_partial(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str],
    on_duplicate: str = "error",
    order_by: Sequence[str] = (),
) -> DataFrame:
    """As ``upsert``, but matched rows take only ``update_cols`` from the source."""
    source = checked_source(source, keys, on_duplicate, order_by).select(*target.columns)
    rows = _side_by_side(target, source, keys)
    stored, incoming = F.col("_t_spread").isNotNull(), F.col("_s_spread").isNotNull()

    def value(c: str) -> Column:
        from_source = incoming if c in update_cols else incoming & ~stored
        return F.when(from_source, F.col(f"_s_{c}")).otherwise(F.col(f"_t_{c}")).alias(c)

    return rows.select(*(value(c) for c in target.columns))


def replace_range(target: DataFrame, source: DataFrame, column: str, lower, upper=None, also: Sequence = ()) -> DataFrame:
    """Target without ``column >= lower`` (and ``<= upper`` if given) and without the values ``also``, plus the source."""
    outside = F.col(column) < F.lit(lower)
    if upper is not None:
        outside = outside | (F.col(column) > F.lit(upper))
    if also:
        outside = outside & ~F.col(column).isin(*also)
    keep = target.where(F.coalesce(outside, F.lit(True)))
    return keep.unionByName(source.select(*target.columns))


def conform(df: DataFrame, schema: T.StructType, load_time: datetime | None = None) -> DataFrame:
    """Columns of ``schema`` in order and type, extras dropped.

    ``load_time`` fills ``etl_load_date`` when the rows lack it. A missing column is an
    error, and so is a NULL in a column the schema declares as not nullable.
    """
    if load_time is not None and "etl_load_date" not in df.columns:
        df = df.withColumn("etl_load_date", F.lit(load_time).cast("timestamp"))
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df.select(*(_checked(f) for f in schema.fields))


def _checked(field: T.StructField):
    value = F.col(field.name).cast(field.dataType)
    if not field.nullable:
        absent = F.raise_error(F.lit(f"NULL in required column {field.name}")).cast(field.dataType)
        value = F.coalesce(value, absent)
    return value.alias(field.name)
