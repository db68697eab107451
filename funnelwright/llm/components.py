"""Connected components of a link table by alternating large and small stars.

Every round is two aggregations and two joins; tables between rounds are written to the shared
folder, so no lineage grows and nothing but two numbers a round reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import staged


def _large_star(links: DataFrame) -> DataFrame:
    """Hang the larger neighbours of each node on the smallest of its neighbours and itself."""
    both = links.union(links.select(F.col("b"), F.col("a")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """Hang the smaller neighbours of each node, and the node, on the smallest of them."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    rest = links.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return rest.union(least.select("a", F.col("m").alias("b")))


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node with a link: root is the smallest node of its component.

    ``links`` has two columns of one orderable type. Loops and NULLs are ignored, repeated and
    reversed links count once; an empty table gives an empty result.
    """
    plain = links.toDF("x", "y").where("x <> y")
    oriented = plain.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b"))
    current = staged(oriented.distinct(), "links")
    state = _state(current)
    while state[0]:
        current = staged(_small_star(_large_star(current)).distinct(), "links")
        after = _state(current)
        if after == state:
            break
        state = after
    return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
