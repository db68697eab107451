"""Feeding text columns to functions on Arrow batches, a bounded number of bytes at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Bytes of text a task handles at once; a longer text is a chunk of its own.
CHUNK_BYTES = 4 << 20
# Rows Spark puts into one Arrow batch: bounds the JVM's and the worker's buffers.
BATCH_ROWS = 1000


def small_batches(df: DataFrame) -> None:
    """Bound the Arrow batches of the session: texts may be long."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def pick(df: DataFrame, *names: str) -> DataFrame:
    """The named columns only, whatever else the frame holds.

    A name is matched exactly first, then without regard to case, so columns that differ
    from it only in case do no harm; of columns of the same name the first counts.
    """
    columns = df.columns
    places = []
    for name in names:
        same = [i for i, c in enumerate(columns) if c == name]
        alike = [i for i, c in enumerate(columns) if c.lower() == name.lower()]
        if not same + alike:
            raise ValueError(f"no column {name} among {columns}")
        places.append((same + alike)[0])
    numbered = df.toDF(*[f"_c{i}" for i in range(len(columns))])
    return numbered.select(*[F.col(f"_c{i}").alias(n) for i, n in zip(places, names, strict=True)])


def in_remainder(doc_id: Column, divisor: int, remainder: int) -> Column:
    """Whether crc32 of the id as text leaves the remainder; false for a NULL id."""
    crc = F.crc32(doc_id.cast("string").cast("binary"))
    return F.coalesce(crc % F.lit(divisor) == F.lit(remainder), F.lit(False))


def chunks(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in slices of at most ``limit`` bytes of text, or of one row."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start = held = 0
    for i, n in enumerate(lengths):
        if held and held + n > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < batch.num_rows:
        yield batch.slice(start)


def merged(batches: Iterable[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Chunks of about ``limit`` bytes, joining small batches, for work that has a fixed cost a chunk."""
    held: list[pa.RecordBatch] = []
    total = 0
    for batch in batches:
        for part in chunks(batch, column, limit):
            n = pc.sum(pc.binary_length(part.column(column))).as_py() or 0
            if held and total + n > limit:
                yield _one(held)
                held, total = [], 0
            held.append(part)
            total += n
    if held:
        yield _one(held)


def _one(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return parts[0] if len(parts) == 1 else pa.concat_batches(parts)


def map_text(
    df: DataFrame,
    work: Callable[[list[str | None]], dict[str, list]],
    added: T.StructType,
    text: str = "text",
) -> DataFrame:
    """Each row's other columns, with what ``work`` makes of the texts in place of the text."""
    small_batches(df)
    kept = [f for f in df.schema.fields if f.name != text]
    schema = T.StructType(kept + added.fields)
    names = [f.name for f in added.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for batch in batches:
            for part in chunks(batch, text):
                made = work(part.column(text).to_pylist())
                columns = [part.column(f.name) for f in kept]
                columns += [pa.array(made[n], arrow.field(n).type) for n in names]
                yield pa.RecordBatch.from_arrays(columns, names=arrow.names)

    return df.mapInArrow(run, schema)
