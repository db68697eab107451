"""Cumulative-snapshot collapse of logged conversations, and rendering of what stays.

A log often holds a conversation once per turn, each time one turn longer. Every turn gets a hash of
itself and its position; the running sum of these down to a turn is the hash of the prefix that ends there
(128 bits, as two sums). A conversation whose whole hash is that of a shorter prefix of another
goes, by an anti-join; of equal conversations the one with the smallest id stays. The
rest is rendered.

Results in special cases: rows with a NULL conversation id belong to no conversation and are left
out; turns are ordered by turn (NULLs first), role and text; repeated turns count as turns; a
NULL role or text is told from an empty one when comparing and renders as empty; an empty table gives
an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .batches import pick

BEGIN, END = "<|im_start|>", "<|im_end|>"


def prefixes(conversations: DataFrame) -> DataFrame:
    """One row per turn: conv_id, position from 1, role, text, the hash (h1, h2) of the conversation so
    far, and whether the turn is the last."""
    turns = pick(conversations, "conv_id", "turn", "role", "text").where(F.col("conv_id").isNotNull())
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    placed = turns.withColumn("position", F.row_number().over(order))
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    parts = ["position", F.col("role").isNull(), "role", F.col("text").isNull(), "text"]

    def running(salt: int) -> Column:
        own = F.xxhash64(F.lit(salt), *parts).cast("decimal(20,0)")
        # unsigned 64-bit arithmetic by remainder: sums of hashes of (position, turn) stay below 38 digits
        return F.sum(own).over(so_far)

    return placed.select(
        "conv_id",
        "position",
        "role",
        "text",
        running(1).alias("h1"),
        running(2).alias("h2"),
        F.lead(F.lit(1)).over(order).isNull().alias("last"),
    )


def maximal(conversations: DataFrame) -> DataFrame:
    """conv_id, n_turns and n_copies of each conversation that is no proper prefix of another and the
    first of its equals."""
    rows = prefixes(conversations).select("conv_id", "position", "h1", "h2", "last")
    key = ["position", "h1", "h2"]
    wholes = rows.where("last").groupBy(*key).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_copies"))
    inner = rows.where("NOT last").select(*key).distinct()
    return wholes.join(inner, key, "left_anti").select("conv_id", F.col("position").alias("n_turns"), "n_copies")


def rendered(role: Column, text: Column) -> Column:
    """One turn in the template; the markers' own strings within it are broken by a space."""
    plain = lambda c: F.regexp_replace(F.coalesce(c, F.lit("")), r"<\|(im_start|im_end)\|>", "< |$1| >")
    return F.concat(F.lit(BEGIN), plain(role), F.lit("\n"), plain(text), F.lit(END), F.lit("\n"))


def chat_texts(conversations: DataFrame) -> DataFrame:
    """conv_id, n_turns, n_copies and the rendered text of the maximal conversations."""
    stay = maximal(conversations)
    turns = prefixes(conversations).select("conv_id", "position", rendered(F.col("role"), F.col("text")).alias("line"))
    lines = F.array_sort(F.collect_list(F.struct("position", "line")))
    texts = (
        turns.join(stay.select("conv_id"), "conv_id", "left_semi")
        .groupBy("conv_id")
        .agg(F.array_join(F.transform(lines, lambda x: x["line"]), "").alias("chat"))
    )
    return stay.join(texts, "conv_id").select(
        "conv_id", F.col("n_turns").cast("long").alias("n_turns"), F.col("n_copies").cast("long").alias("n_copies"), "chat"
    )


# By comparing the turns themselves: the lists of all proper prefixes against the whole lists.
CHAT_SQL = """
WITH turns AS (
    SELECT conv_id, role, text, row_number() OVER w AS position, count(*) OVER (PARTITION BY conv_id) AS n_turns,
           array_agg({'r': role, 't': text}) OVER (w ROWS UNBOUNDED PRECEDING) AS so_far
    FROM conversations WHERE conv_id IS NOT NULL
    WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST)
), wholes AS (
    SELECT so_far, min(conv_id) AS conv_id, count(*) AS n_copies, any_value(n_turns) AS n_turns
    FROM turns WHERE position = n_turns GROUP BY so_far
), stay AS (
    SELECT * FROM wholes WHERE NOT EXISTS (
        SELECT 1 FROM turns WHERE turns.position < turns.n_turns AND turns.so_far = wholes.so_far)
), lines AS (
    SELECT conv_id, position, '<|im_start|>'
        || regexp_replace(coalesce(role, ''), '<\\|(im_start|im_end)\\|>', '< |\\1| >', 'g') || chr(10)
        || regexp_replace(coalesce(text, ''), '<\\|(im_start|im_end)\\|>', '< |\\1| >', 'g') || '<|im_end|>' || chr(10)
        AS line
    FROM turns
)
SELECT conv_id, any_value(stay.n_turns)::BIGINT AS n_turns, any_value(n_copies)::BIGINT AS n_copies,
       string_agg(line, '' ORDER BY position) AS chat
FROM stay JOIN lines USING (conv_id) GROUP BY conv_id
"""
