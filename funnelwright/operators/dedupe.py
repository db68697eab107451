"""Duplicate removal and load audits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.rules import present


def first_seen(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The first row per key in landing order; rows without a key are dropped.

    ``row_number = 1`` lets Spark keep one row per key and map task before the shuffle
    (WindowGroupLimit), so a key with many copies does not fill one task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    usable = df.where(" AND ".join(f"`{k}` IS NOT NULL" for k in keys))
    return usable.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row per key by ``order``; NULL keys are all kept, since they equal nothing.

    A row with a NULL key is a group of its own, so the input is read once and such rows are
    spread over all tasks.
    """
    rest = [c for c in df.columns if c not in {*keys, *order}]
    newest_first = [F.desc(c) for c in (*order, *rest)]
    alone = F.when(any_null(keys), F.monotonically_increasing_id()).otherwise(F.lit(0))
    rank = F.row_number().over(Window.partitionBy(*keys, "_alone").orderBy(*newest_first))
    return df.withColumn("_alone", alone).withColumn("_rank", rank).where("_rank = 1").drop("_alone", "_rank")


def any_null(keys: Sequence[str]) -> Column:
    """True where at least one key is NULL."""
    condition = F.lit(False)
    for k in keys:
        condition = condition | F.col(k).isNull()
    return condition


def load_audit(df: DataFrame, slice_cols: Sequence[str], key: str, required: Sequence[Column]) -> DataFrame:
    """Counters per slice: fetched, without key, duplicates, rejected, loaded.

    ``required`` are conditions a fetched row must meet. Rows are first reduced to one per
    key, which is also what keeps a much repeated key from filling one task.
    """
    ok = F.lit(True)
    for condition in required:
        ok = ok & F.coalesce(condition, F.lit(False))
    per_key = df.groupBy(*slice_cols, key).agg(
        F.count(F.lit(1)).alias("_copies"),
        F.bool_and(ok).alias("_ok"),
    )
    keyed = present(F.col(key).cast("string"))
    return per_key.groupBy(*slice_cols).agg(
        F.sum("_copies").alias("fetched"),
        F.sum(F.when(~keyed, F.col("_copies")).otherwise(0)).alias("without_key"),
        F.sum(F.when(keyed, F.col("_copies") - 1).otherwise(0)).alias("duplicates"),
        F.sum(F.when(keyed & ~F.col("_ok"), 1).otherwise(0)).alias("rejected"),
        F.sum(F.when(keyed & F.col("_ok"), 1).otherwise(0)).alias("loaded"),
    )
