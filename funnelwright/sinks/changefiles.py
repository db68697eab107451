"""Change files of a stored table: upserts that are appended now and folded into the table later.

Changes that fall into many partitions would rewrite all of them for a few rows. Here a batch of changes is
written once, beside the data, in folders of a hash bucket of the key: ``_changes/batch=<n>/bucket=<b>``. A reader takes
the newest change of a key in place of the stored row. Folding a bucket's changes into the data, and
dropping them, is one exchange; buckets may be folded one at a time, so the cost of a run is bounded.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..operators.dedupe import latest_per_key
from ..operators.joins import spread_null_keys
from . import exchange

FOLDER = "_changes"
BUCKETS = 8


def batches(spark: SparkSession, path: str) -> list[str]:
    """Names of the batches not folded yet, oldest first."""
    return [n for n in exchange.names(spark, f"{path}/{FOLDER}") if n.startswith("batch=")]


def unique_keys(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows; a key that occurs twice fails the job. NULL keys may repeat."""
    spread = spread_null_keys(rows, keys)
    place = F.row_number().over(Window.partitionBy(*keys, "_spread").orderBy("_spread"))
    repeated = (place > 1) & (F.col("_spread") == 0)
    failed = F.raise_error(F.lit("several changes for one key")).cast("boolean")
    checked = spread.withColumn("_repeated", repeated)
    return checked.where(F.when(F.col("_repeated"), failed).otherwise(F.lit(True))).drop("_spread", "_repeated")


def append(spark: SparkSession, path: str, rows: DataFrame, keys: Sequence[str], buckets: int = BUCKETS) -> None:
    """Store a batch of changes: rows as the table holds them, one per key."""
    folder = f"{path}/{FOLDER}"
    before = batches(spark, path)
    number = int(before[-1].partition("=")[2]) + 1 if before else 1
    for name in exchange.names(spark, folder):
        if name.startswith(exchange.NEW):
            exchange.remove(spark, f"{folder}/{name}")  # of a run that died
    new = exchange.new_folder(folder)
    bucket = F.pmod(F.xxhash64(*keys, "_spread"), F.lit(buckets)).cast("int")
    dealt = spread_null_keys(rows, keys).withColumn("bucket", bucket).drop("_spread")
    dealt.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(new)
    exchange.rename(spark, new, f"{folder}/batch={number:012d}")


def folders(spark: SparkSession, path: str, buckets: Sequence[int] | None = None) -> list[str]:
    """The folders of the changes in some buckets, or in all, relative to the table."""
    found = []
    for batch in batches(spark, path):
        for name in exchange.names(spark, f"{path}/{FOLDER}/{batch}"):
            if name.startswith("bucket=") and (buckets is None or int(name.partition("=")[2]) in buckets):
                found.append(f"{FOLDER}/{batch}/{name}")
    return found


def latest(
    spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], buckets: Sequence[int] | None = None
) -> DataFrame | None:
    """The newest change of every key, all rows with a NULL key; None if there are no changes."""
    if not batches(spark, path):
        return None
    known = T.StructType([*schema.fields, T.StructField("batch", T.LongType()), T.StructField("bucket", T.IntegerType())])
    rows = spark.read.schema(known).parquet(f"{path}/{FOLDER}")
    if buckets is not None:
        rows = rows.where(F.col("bucket").isin(*buckets))
    return latest_per_key(rows, keys, ["batch"]).select(*schema.names)


def drop_empty(spark: SparkSession, path: str) -> None:
    """Remove the batches all of whose buckets have been folded."""
    for batch in batches(spark, path):
        folder = f"{path}/{FOLDER}/{batch}"
        if not any(n.startswith("bucket=") for n in exchange.names(spark, folder)):
            exchange.remove(spark, folder)
