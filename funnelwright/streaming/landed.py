"""Load each landed file once, as it appears.

Structured Streaming keeps track of the files already read, so a run does not list and
re-read the whole landing folder. Batches go through the same plans and upserts as a full
load; an upsert makes a batch that is replayed after a failure harmless. Objects carry the file
they landed in (``fetch``), and files are read in the order they landed: of several copies of an id
the one of the newest file wins, inside a file the first, however the files fall into batches.

Objects that never change are loaded when first seen: the state store knows the ids that have been, so copies
that land again reach no table (``load_first_seen``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..session import prepare
from ..sources.readers import landed_text, page_objects

# Fixed value: the state store that keeps its keys on disk, not in memory.
ON_DISK_STATE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Fixed value: the columns of Spark's reader of whole files.
BINARY_FILE = "path string, modificationTime timestamp, length long, content binary"


def load_new_pages(
    spark: SparkSession,
    folder: str,
    checkpoint: str,
    load: Callable[[DataFrame], None],
    files_per_batch: int = 1000,
    on_broken: str = "error",
) -> StreamingQuery:
    """Start a run over all files landed since the last one and hand each batch of
    objects (``fetch, page, pos, raw``) to ``load``; the run ends when none is left."""
    lines = landed_text(spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(folder))
    return (
        lines.writeStream.foreachBatch(lambda batch, _: load(page_objects(batch, "value", "fetch", on_broken=on_broken)))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def load_first_seen(
    spark: SparkSession,
    folder: str,
    checkpoint: str,
    heads: Callable[[DataFrame], DataFrame],
    load: Callable[[DataFrame], None],
    files_per_batch: int = 1000,
    on_broken: str = "error",
    remember: str | None = None,
) -> StreamingQuery:
    """As ``load_new_pages`` for the objects whose id is new; ``heads`` picks the usable objects and adds ``id``.

    Of copies in one batch any one is loaded. Ids are remembered for ever, or with ``remember`` (an
    interval such as ``30 days``) at least that long after they were read, which bounds the state. A batch whose run died may
    come again, so ``load`` has to pass over stored ids; so it does over those no longer remembered.
    """
    own = prepare(spark.newSession())
    own.conf.set("spark.sql.streaming.stateStore.providerClass", ON_DISK_STATE)
    lines = landed_text(own.readStream.option("maxFilesPerTrigger", files_per_batch).text(folder))
    usable = heads(page_objects(lines, "value", "fetch", on_broken=on_broken)).where("id IS NOT NULL")
    if remember is None:
        new = usable.dropDuplicates(["id"])
    else:
        # by the time of reading, so no row is ever too late
        timed = usable.withColumn("read_at", F.current_timestamp()).withWatermark("read_at", remember)
        new = timed.dropDuplicatesWithinWatermark(["id"]).drop("read_at")
    return (
        new.writeStream.foreachBatch(lambda batch, _: load(batch))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def load_new_files(
    spark: SparkSession, folder: str, checkpoint: str, load: Callable[[list[str]], None], files_per_batch: int = 1000
) -> StreamingQuery:
    """As ``load_new_pages`` for files that are read by path: ``load`` gets the paths of a batch. No content is read here."""
    reader = spark.readStream.format("binaryFile").schema(BINARY_FILE).option("maxFilesPerTrigger", files_per_batch)
    files = reader.load(folder).select("path")

    def each(batch: DataFrame, _: int) -> None:
        # at most files_per_batch names
        paths = sorted(r.path for r in batch.collect())
        if paths:
            load(paths)

    return files.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
