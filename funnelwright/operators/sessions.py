"""Running and whole-session columns over time-ordered events.

A plain window over the session key puts each session into one task. Events without a
session id all share the NULL session, and one automated visitor can send a large share
of the traffic, so sessions of more than ``hot_rows`` rows are cut in time into chunks of about that many rows,
however many those are and however the rows lie in time. The window runs inside a chunk, and what earlier chunks
carry forward comes from one summary row per chunk.

The cuts are made at two levels. Rows picked by a hash of their content stand for all rows. A few of them per session
give coarse ranges, about as many as there are chunks in a range; more of them per range give the chunks. So a row is
compared with twice the square root of the number of chunks, no array holds a whole session, and the
cuts are the same however often and in whatever order they are computed.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.keys import as_column

HOT_ROWS = 1_000_000

# Picked rows per cut: the more, the more even the chunks.
PICKED = 256

# Columns the rows are distributed by after session_columns(keep_layout=True).
LAYOUT = ["_sid", "_no_sid", "_chunk"]


def session_columns(
    events: DataFrame,
    session: str,
    ts: str,
    ties: Sequence[str],
    latest: Mapping[str, str | Column] | None = None,
    first: Mapping[str, str | Column] | None = None,
    peak: Mapping[str, str | Column] | None = None,
    hot_rows: int = HOT_ROWS,
    keep_layout: bool = False,
) -> DataFrame:
    """Add per-session columns to ``events``.

    latest: newest non-NULL value up to and including rows of the same time.
    first:  value of the session's first row, also when NULL.
    peak:   maximum over the whole session.

    Rows of equal time are ordered by ``ties``, which makes the result independent of
    how the data is split.
    """
    latest, first, peak = (
        {out: as_column(c) for out, c in (given or {}).items()} for given in (latest, first, peak)
    )
    chunked = _with_chunks(events, session, ts, ties, max(hot_rows, 1))
    at = F.struct(ts, *ties)

    # each running value travels with its position, so max() finds the newest one
    positioned = {f"_l_{out}": F.when(c.isNotNull(), F.struct(at.alias("at"), c.alias("v"))) for out, c in latest.items()}
    starts = {f"_f_{out}": F.struct(at.alias("at"), c.alias("v")) for out, c in first.items()}
    peaks = {f"_p_{out}": c for out, c in peak.items()}

    within = Window.partitionBy(*LAYOUT)
    so_far = within.orderBy(ts).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    # distributed before the positioned values are built, so that these are not shuffled
    rows = chunked.repartition(*LAYOUT).withColumns(
        {name: F.max(c).over(so_far) for name, c in positioned.items()}
        | {name: F.min(c).over(within) for name, c in starts.items()}
        | {name: F.max(c).over(within) for name, c in peaks.items()}
    )

    # one row per chunk of the hot sessions only
    per_chunk = (
        chunked.where("_hot")
        .groupBy(*LAYOUT)
        .agg(
            F.lit(True).alias("_c"),
            *(F.max(c).alias(name) for name, c in positioned.items()),
            *(F.min(c).alias(name) for name, c in starts.items()),
            *(F.max(c).alias(name) for name, c in peaks.items()),
        )
    )
    whole = Window.partitionBy("_sid", "_no_sid")
    before = whole.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = per_chunk.select(
        *LAYOUT,
        F.col("_c"),
        *(F.max(name).over(before).alias(f"{name}_c") for name in positioned),
        *(F.min(name).over(whole).alias(f"{name}_c") for name in starts),
        *(F.max(name).over(whole).alias(f"{name}_c") for name in peaks),
    )

    joined = rows.join(carried, LAYOUT, "left")
    is_hot = F.col("_c").isNotNull()
    results = (
        {out: F.coalesce(f"_l_{out}", f"_l_{out}_c")["v"] for out in latest}
        | {out: F.when(is_hot, F.col(f"_f_{out}_c")).otherwise(F.col(f"_f_{out}"))["v"] for out in first}
        | {out: F.when(is_hot, F.col(f"_p_{out}_c")).otherwise(F.col(f"_p_{out}")) for out in peak}
    )
    kept = [F.col(c) for c in events.columns if c not in results and c != session]
    layout = [F.col(c) for c in LAYOUT] if keep_layout else []
    return joined.select(
        F.when(~F.col("_no_sid"), F.col("_sid")).alias(session),
        *kept,
        *(c.alias(out) for out, c in results.items()),
        *layout,
    )


def _with_chunks(events: DataFrame, session: str, ts: str, ties: Sequence[str], hot_rows: int) -> DataFrame:
    """Replace the session column by the layout columns: NULL-safe key and time chunk.

    Rows of equal time stay together.
    """
    sid = ["_sid", "_no_sid"]
    safe = events.withColumns(
        {"_sid": F.coalesce(F.col(session), F.lit("")), "_no_sid": F.col(session).isNull()}
    ).drop(session)
    # sessions that are hot are few; so are the rows that stand for theirs
    sizes = safe.groupBy(*sid).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_rows)
    chunks = F.ceil(F.col("_n") / F.lit(hot_rows))
    per_range = F.ceil(F.sqrt(chunks))
    sizes = sizes.select(*sid, "_n", (per_range * hot_rows).alias("_range_rows"))

    hashed = safe.select(*sid, F.unix_micros(ts).alias("_at"), F.xxhash64(ts, *ties).alias("_h")).join(sizes, sid)
    every = F.greatest(F.floor(F.col("_range_rows") / PICKED), F.lit(1))
    ranges = _cuts(hashed.withColumn("_every", every), sid, F.col("_range_rows")).withColumnRenamed("_ends", "_starts")
    ranged = hashed.join(ranges, sid, "left").withColumn("_range", _after("_starts", F.col("_at")))
    every = F.lit(max(hot_rows // PICKED, 1)).cast("long")
    ends = _cuts(ranged.withColumn("_every", every), [*sid, "_range"], F.lit(hot_rows))

    hot = sizes.select(*sid, F.lit(True).alias("_is_hot")).join(ranges, sid, "left")
    known = safe.join(hot, sid, "left").withColumn("_range", _after("_starts", F.unix_micros(ts)))
    fine = known.join(ends, [*sid, "_range"], "left")
    chunk = (F.col("_range") * F.lit(1 << 32) + _after("_ends", F.unix_micros(ts))).cast("long")
    return fine.select(*safe.columns, F.coalesce("_is_hot", F.lit(False)).alias("_hot"), chunk.alias("_chunk"))


def _cuts(hashed: DataFrame, group: Sequence[str], rows: Column) -> DataFrame:
    """Times at which a group of rows is cut into parts of about so many rows (``_ends``), from every ``_every``-th row."""
    picked = hashed.where(F.pmod("_h", "_every") == 0)
    gathered = picked.groupBy(*group).agg(
        F.sort_array(F.collect_list("_at")).alias("_picked"), F.any_value("_every").alias("_every"), F.any_value(rows).alias("_rows")
    )
    # a part is so many of the picked rows, as whole numbers where all are picked
    step = F.col("_rows") / F.col("_every")
    parts = F.greatest(F.round(F.size("_picked") / step), F.lit(1)).cast("int")
    places = F.transform(
        F.slice(F.sequence(F.lit(1), parts), F.lit(1), parts - 1), lambda i: F.least(F.ceil(i * step).cast("int"), F.size("_picked"))
    )
    return gathered.select(*group, F.array_distinct(F.transform(places, lambda p: F.get("_picked", p - 1))).alias("_ends"))


def _after(ends: str, at: Column) -> Column:
    """How many of the ends lie before a time; 0 without any."""
    return F.coalesce(F.size(F.filter(ends, lambda end: end < at)), F.lit(0)).cast("long")
