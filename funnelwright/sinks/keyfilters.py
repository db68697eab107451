"""Bloom filters of a stored table's keys, one per partition, beside its data.

An upsert has to find the partitions that hold one of its keys. The filters say which may: only those are
opened. A filter is a row of words per block; a key sets four bits of one word, found by two hashes of the
key columns. A filter also names the data files it was made of (by a hash of their names): after any
change of the partition it no longer fits, and is made again from the partition's key columns when next needed.

Sizes are powers of two, so the keys asked for are hashed once per size and not once per partition. Rows with
a NULL key equal no key and are in no filter.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedupe import any_null
from . import exchange

# Folder value Spark gives a NULL partition.
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"
FOLDER = "_keys"
# Words of 64 bits in a block, and bits per key, from which a filter is sized: about one stranger in a hundred passes.
BLOCK, BITS_PER_KEY = 512, 16

STORED = "part string, files string, blocks int, block int, words array<bigint>, folder string"


def part_of(partition: str) -> Column:
    """A partition value as its folder writes it."""
    return F.coalesce(F.col(partition).cast("string"), F.lit(NULL_FOLDER))


def in_parts(partition: str, parts: Sequence[str]) -> Column:
    """Whether a row's partition is one of those; decided on the folder names, before any file is opened."""
    return part_of(partition).isin(*parts) if parts else F.lit(False)


def _listed(base: DataFrame, partition: str) -> dict[str, str]:
    """Of every partition a hash of the names of its files."""
    files = defaultdict(list)
    for path in base.inputFiles():
        folder, _, name = path.rpartition("/")
        label = folder.rpartition("/")[2]
        if label.startswith(f"{partition}="):
            files[unquote(label.partition("=")[2])].append(name)
    return {part: hashlib.md5("\n".join(sorted(found)).encode()).hexdigest() for part, found in files.items()}


def _place(keys: Sequence[str], blocks: Column) -> list[Column]:
    """The block and word of a key in a filter of that size, and its bits in the word."""
    word = F.pmod(F.xxhash64(*keys), blocks.cast("long") * BLOCK)
    other = F.xxhash64(F.lit(1), *keys)
    mask = F.lit(0).cast("long")
    for n in range(4):
        bit = F.shiftrightunsigned(other, 6 * n).bitwiseAND(F.lit(63).cast("long")).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), bit))
    return [F.floor(word / BLOCK).cast("int").alias("block"), (word % BLOCK).cast("int").alias("slot"), mask.alias("mask")]


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    folder = f"{path}/{FOLDER}"
    return spark.read.schema(STORED).parquet(folder) if exchange.names(spark, folder) else None


def _fitting(spark: SparkSession, path: str, listed: dict[str, str]) -> dict[str, int]:
    """Partitions whose filter is complete and made of the files that are there now, and the blocks of each."""
    stored = _stored(spark, path)
    if stored is None:
        return {}
    found = stored.groupBy("part").agg(F.min("files"), F.max("files"), F.min("blocks"), F.max("blocks"), F.count("*"))
    return {
        part: least
        for part, one, other, least, most, rows in found.collect()
        if one == other == listed.get(part) and least == most == rows
    }


def refresh(base: DataFrame, path: str, partition: str, keys: Sequence[str]) -> dict[str, int]:
    """Make the filters that are missing or no longer fit; returns the blocks of every partition's filter."""
    spark = base.sparkSession
    listed = _listed(base, partition)
    fitting = _fitting(spark, path, listed)
    stale = sorted(set(listed) - set(fitting))
    if not stale:
        return fitting
    part = part_of(partition).alias("part")
    rows = base.where(in_parts(partition, stale)).select(part, *keys).where(~any_null(keys))
    counted = dict(rows.groupBy("part").count().collect())  # one row per partition
    sizes = {p: _blocks(counted.get(p, 0)) for p in stale}
    known = spark.createDataFrame([(p, listed[p], n) for p, n in sizes.items()], "part string, files string, blocks int")
    words = (
        rows.join(known, "part")
        .select("part", *_place(keys, F.col("blocks")))
        .groupBy("part", "block", "slot")
        .agg(F.bit_or("mask").alias("mask"))
        .groupBy("part", "block")
        .agg(F.map_from_entries(F.collect_list(F.struct("slot", "mask"))).alias("set"))
    )
    every = known.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    zero = F.lit(0).cast("long")
    filled = F.transform(F.sequence(F.lit(0), F.lit(BLOCK - 1)), lambda slot: F.coalesce(F.try_element_at("set", slot), zero))
    folder = F.concat(F.lit("of "), F.col("part")).alias("folder")
    filters = every.join(words, ["part", "block"], "left").select("part", "files", "blocks", "block", filled.alias("words"), folder)
    writer = filters.hint("rebalance", "folder").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("folder").parquet(f"{path}/{FOLDER}")
    return fitting | sizes


def _blocks(keys: int) -> int:
    blocks = 1
    while blocks * BLOCK * 64 < keys * BITS_PER_KEY:
        blocks *= 2
    return blocks


def may_hold(base: DataFrame, path: str, partition: str, keys: Sequence[str], asked: DataFrame) -> list[str]:
    """The partitions that may hold one of the keys asked for; all that do are among them."""
    sizes = refresh(base, path, partition, keys)
    if not sizes:
        return []
    spark = base.sparkSession
    current = spark.createDataFrame(list(sizes.items()), "part string, blocks int")
    filters = _stored(spark, path).join(current, ["part", "blocks"], "left_semi")  # not those of partitions that are gone
    wanted = asked.select(*keys).where(~any_null(keys)).distinct()
    wanted = wanted.withColumn("blocks", F.explode(F.array(*(F.lit(n) for n in sorted(set(sizes.values()))))))
    wanted = wanted.select("blocks", *_place(keys, F.col("blocks")))
    held = F.element_at("words", F.col("slot") + 1).bitwiseAND(F.col("mask")) == F.col("mask")
    return sorted(r.part for r in wanted.join(filters, ["blocks", "block"]).where(held).select("part").distinct().collect())
