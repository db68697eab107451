"""Files in the shared folder that tasks read and write themselves.

The folder is the one of ``spark.checkpoint.dir``; its address may name any store that pyarrow
knows (a mounted path, hdfs, s3, gs). Nothing is written to a machine's own folders.
"""

from __future__ import annotations

import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path


def opened(address: str) -> tuple[fs.FileSystem, str]:
    """The file system of an address, and the path in it."""
    scheme, colon, rest = address.partition(":")
    if not colon or scheme == "file":
        return fs.LocalFileSystem(), "/" + (rest if colon else address).lstrip("/")
    if scheme in ("s3a", "s3n"):
        address = f"s3:{rest}"
    return fs.FileSystem.from_uri(address)


def written_blocks(df: DataFrame, label: str, blocks: int) -> list[str]:
    """Write the frame as ``blocks`` Parquet files or fewer; returns their addresses."""
    path = scratch_path(df.sparkSession, label)
    df.repartition(blocks).write.parquet(path)
    return sorted(df.sparkSession.read.schema(df.schema).parquet(path).inputFiles())


def read_block(address: str):
    """One such file as an Arrow table, read inside a task."""
    store, path = opened(address)
    return pq.read_table(path, filesystem=store)


def shared_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder address below the shared folder, for tasks that write files."""
    return scratch_path(spark, label)
