"""Measures by a channel that depends on both the fact row and the campaign dimension."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def resolve_channel(override: Column, channel: Column, paid: Sequence[str]) -> Column:
    """Paid campaign channels win, then the fact's override, then the campaign channel."""
    return F.when(channel.isin(*paid), channel).otherwise(F.coalesce(override, channel))


def measures_by_channel(
    fact: DataFrame,
    dim: DataFrame,
    keys: Sequence[str],
    join_key: str,
    entity: str,
    overrides: Sequence[str],
    paid: Sequence[str],
    count_as: str,
    amount: str | None = None,
    sum_as: str | None = None,
) -> DataFrame:
    """Distinct ``entity`` and optionally the sum of ``amount`` per keys, join key and channel.

    The fact (columns keys, join_key, ``override``, entity, amount) is read once and reduced
    to one row per entity, then to one row per combination of overrides an entity occurs
    with. Only these meet the dimension, so neither a frequent campaign nor the size of the
    dimension matters.
    """
    cases = [None, *overrides]
    flags = [f"_o{i}" for i in range(len(cases))]
    sums = [f"_s{i}" for i in range(len(cases))] if amount else []
    by = [*keys, join_key]

    is_case = [F.col("override").eqNullSafe(F.lit(o)) for o in cases]
    per_entity = fact.groupBy(*by, entity).agg(
        *(F.bool_or(c).alias(f) for c, f in zip(is_case, flags)),
        *(F.sum(F.when(c, F.col(amount))).alias(s) for c, s in zip(is_case, sums)),
    )
    per_mix = per_entity.groupBy(*by, *flags).agg(F.count(entity).alias("_n"), *(F.sum(s).alias(s) for s in sums))

    resolved = [
        F.struct(
            F.col(f).alias("used"),
            resolve_channel(F.lit(o).cast("string"), F.col("channel"), paid).alias("channel"),
            (F.col(sums[i]) if sums else F.lit(None).cast("double")).alias("amount"),
        )
        for i, (o, f) in enumerate(zip(cases, flags))
    ]
    joined = per_mix.join(dim.select(join_key, "channel"), join_key, "left")
    cells = joined.select(*by, *flags, "_n", F.explode(F.filter(F.array(*resolved), lambda c: c["used"])).alias("_c"))
    # an entity counts once per channel, by however many overrides or dimension rows it got there
    per_channel = cells.groupBy(*by, *flags, F.col("_c.channel").alias("channel")).agg(
        F.max("_n").alias("_n"), F.sum("_c.amount").alias("_amount")
    )
    results = [F.sum("_n").alias(count_as)] + ([F.sum("_amount").alias(sum_as)] if amount else [])
    return per_channel.groupBy(*by, "channel").agg(*results)
