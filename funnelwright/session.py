"""Session settings shared by every job, and the place for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the results depend on; everything else is tuning.
REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# AQE picks the final partition count and splits skewed join partitions at run time.
TUNING = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # no stack inspection per Column call on the driver
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings results depend on to a session somebody else built."""
    for key, value in REQUIRED.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = 8, memory: str = "8g", shared: str | None = None) -> SparkSession:
    """Single-machine session for tests and the benchmark, ``shared`` as its checkpoint folder."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("funnelwright")
    for key, value in {**REQUIRED, **TUNING}.items():
        builder = builder.config(key, value)
    if shared:
        builder = builder.config("spark.checkpoint.dir", shared)
    return (
        builder.config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path for an intermediate table.

    The folder is the one named by ``spark.checkpoint.dir``, which every executor can
    reach. Only a local-mode session without that setting gets a temporary one.
    """
    context = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not shared:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="funnelwright-"))
        shared = context.getCheckpointDir()
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back, cutting its lineage."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
