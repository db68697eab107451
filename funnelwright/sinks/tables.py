"""Changes to stored Parquet tables.

Parquet has no row updates, so a change rewrites the partitions it touches. New content is written
once, to a hidden folder beside or inside the table, and moved into place folder by folder after a commit record
(``exchange``). A table that was being changed when a run died is put back, or completed, when it is next
read or written. Which partitions hold a key is known from filters beside the data (``keyfilters``), and
changes scattered over many partitions may be stored apart and folded in later (``changefiles``).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import contextmanager
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import merge
from ..operators.joins import keyed_join, not_in
from ..schemas import TableSpec
from ..session import scratch_path
from . import changefiles, exchange, keyfilters
from .exchange import exists, remove
from .exchange import rename as _rename
from .keyfilters import NULL_FOLDER


def table_path(root: str, spec: TableSpec) -> str:
    return f"{root.rstrip('/')}/{spec.name}"


def read_table(spark: SparkSession, root: str, spec: TableSpec) -> DataFrame:
    """The stored rows under the declared schema; no rows when there is no table yet."""
    return _stored(spark, root, spec).select(*spec.schema.names)


def _base(spark: SparkSession, root: str, spec: TableSpec) -> DataFrame:
    """The rows of the data files, with the partition column also where it is derived."""
    path = table_path(root, spec)
    schema = _nullable(spec.stored_schema)
    if not exists(spark, path):
        recover(spark, path)
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    exchange.complete(spark, path)
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def _stored(spark: SparkSession, root: str, spec: TableSpec) -> DataFrame:
    """The data files' rows, changed by the change files if there are any."""
    base = _base(spark, root, spec)
    changed = changefiles.latest(spark, table_path(root, spec), base.schema, spec.keys) if spec.keys else None
    return base if changed is None else not_in(base, changed, spec.keys).unionByName(changed)


def _incoming(rows: DataFrame, spec: TableSpec, load_time: datetime | None = None) -> DataFrame:
    """Rows in the declared schema, with a derived partition column added."""
    conformed = merge.conform(rows, spec.schema, load_time)
    return conformed.withColumn(spec.partition, F.expr(spec.partition_expr)) if spec.partition_expr else conformed


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


def create_table(spark: SparkSession, root: str, spec: TableSpec) -> None:
    """Create the table if it is absent."""
    path = table_path(root, spec)
    if not exists(spark, path):
        recover(spark, path)
    if not exists(spark, path):
        spark.createDataFrame([], _nullable(spec.stored_schema)).write.parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """A function writing frames to the shared folder and reading them back; what it wrote
    is removed afterwards unless the block fails."""
    paths = []

    def stage(df: DataFrame, label: str) -> DataFrame:
        paths.append(scratch_path(spark, label))
        df.write.parquet(paths[-1])
        return spark.read.schema(df.schema).parquet(paths[-1])

    yield stage
    for path in paths:
        remove(spark, path)


@contextmanager
def staging(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """``df`` written to the shared folder; removed afterwards unless the block fails."""
    with scratch(df.sparkSession) as stage:
        yield stage(df, label)


def _laid_out(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Files of even size, sorted by the cluster columns for tight min/max statistics.

    Rebalancing gathers a day in few files, but splits a day that is large.
    """
    order = [c for c in (spec.partition, *spec.cluster) if c]
    df = df.hint("rebalance") if spec.partition is None else df.hint("rebalance", spec.partition)
    return df.sortWithinPartitions(*order) if order else df


def _write(df: DataFrame, path: str, spec: TableSpec, mode: str) -> None:
    writer = _laid_out(df, spec).write.mode(mode)
    if spec.partition is not None:
        writer = writer.partitionBy(spec.partition)
    writer.parquet(path)


def _beside(path: str, label: str) -> str:
    """A folder next to the table that no reader takes for one: its name begins with a dot."""
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/.{name}.{label}"


def recover(spark: SparkSession, path: str) -> None:
    """Finish or undo the replacement of a whole table that a failed run left half done."""
    new, old = _beside(path, "new"), _beside(path, "old")
    if not exists(spark, path) and exists(spark, old):
        # the new content was complete before the old was moved away
        _rename(spark, new if exists(spark, new) else old, path)
    for folder in (new, old):
        remove(spark, folder)


def _replace_folder(spark: SparkSession, path: str, spec: TableSpec, content: DataFrame) -> None:
    """Write the whole table beside the old one, then exchange the two."""
    recover(spark, path)
    new, old = _beside(path, "new"), _beside(path, "old")
    _write(content, new, spec, "overwrite")
    if exists(spark, path):
        _rename(spark, path, old)
    _rename(spark, new, path)
    remove(spark, old)


def _in_values(column: str, values: Iterable) -> Column:
    known = [v for v in values if v is not None]
    condition = F.col(column).isin(*known)
    return condition | F.col(column).isNull() if len(known) < len(set(values)) else condition


def _values(df: DataFrame, column: str) -> set:
    """Distinct partition values: one per day, so small enough for the driver."""
    return {row[0] for row in df.select(column).distinct().collect()}


def _folder(spec: TableSpec, value) -> str:
    return f"{spec.partition}={NULL_FOLDER if value is None else value}"


def _swap(
    spark: SparkSession, root: str, spec: TableSpec, content: DataFrame, touched: set, drop: Iterable[str] = ()
) -> None:
    """Make ``content`` the whole content of the touched partitions, and drop folders, in one exchange."""
    path = table_path(root, spec)
    exchange.clear(spark, path)
    new = exchange.new_folder(path)
    _write(content, new, spec, "overwrite")
    produced = {name for name in exchange.names(spark, new) if name.startswith(f"{spec.partition}=")}
    emptied = {_folder(spec, value) for value in touched} - produced
    exchange.exchange(spark, path, new, produced, [*emptied, *drop])
    if _filtered(spec):
        keyfilters.refresh(_base(spark, root, spec), path, spec.partition, spec.keys)


def _filtered(spec: TableSpec) -> bool:
    """Whether partitions that hold a key have to be looked for."""
    return bool(spec.keys) and spec.partition is not None and not spec.partition_from_key


def _may_hold(base: DataFrame, root: str, spec: TableSpec, source: DataFrame) -> DataFrame:
    """The stored rows of those partitions that may hold a key of the source."""
    path = table_path(root, spec)
    if not exists(base.sparkSession, path):
        return base
    parts = keyfilters.may_hold(base, path, spec.partition, spec.keys, source)
    return base.where(keyfilters.in_parts(spec.partition, parts))


def rebuild(spark: SparkSession, root: str, spec: TableSpec, rows: DataFrame) -> None:
    """Replace the whole content by the rows, which may be made from the table itself."""
    _replace_folder(spark, table_path(root, spec), spec, _incoming(rows, spec))


def append_new(
    spark: SparkSession,
    root: str,
    spec: TableSpec,
    rows: DataFrame,
    dedup_batch: bool = False,
    compare_keyless: bool = False,
) -> None:
    """Append the rows whose key is not stored; with ``compare_keyless`` rows without a key are
    appended only if no equal row is stored.

    Only partitions are looked at that may hold a key of the rows, or an equal row.
    """
    compact(spark, root, spec)
    with staging(_incoming(rows, spec), spec.name) as source:
        if source.isEmpty():
            return
        stored = _stored(spark, root, spec)
        if spec.partition is not None and (spec.partition_from_key or compare_keyless):
            own = stored.where(_in_values(spec.partition, _values(source, spec.partition)))
        if spec.partition_from_key:
            stored = own
        elif _filtered(spec):
            keyed = _may_hold(stored, root, spec, source)
            keyless = own.where(merge.any_null(spec.keys)) if compare_keyless else None
            stored = keyed if keyless is None else keyed.where(~merge.any_null(spec.keys)).unionByName(keyless)
        new = merge.insert_new(stored, source, spec.keys, dedup_batch, compare_keyless)
        _write(new, table_path(root, spec), spec, "append")


def update_changed(spark: SparkSession, root: str, spec: TableSpec, rows: DataFrame, attribute: str) -> None:
    """Overwrite one attribute where the rows bring another value."""
    target = _stored(spark, root, spec)
    changed = merge.update_changed(target, rows, spec.keys[0], attribute)
    _replace_folder(spark, table_path(root, spec), spec, changed)


def replace_range(spark: SparkSession, root: str, spec: TableSpec, rows: DataFrame, lower, also: Sequence = ()) -> None:
    """Replace everything from ``lower`` on in the partition column, and the partitions ``also``, by the rows."""
    compact(spark, root, spec)
    target = _stored(spark, root, spec)
    with staging(_incoming(rows, spec), spec.name) as source:
        replaced = F.col(spec.partition) >= F.lit(lower)
        if also:
            replaced = replaced | F.col(spec.partition).isin(*also)
        touched = _values(target.where(replaced), spec.partition)
        touched |= _values(source, spec.partition)
        current = target.where(_in_values(spec.partition, touched))
        _swap(spark, root, spec, merge.replace_range(current, source, spec.partition, lower, also=also), touched)


def upsert(
    spark: SparkSession,
    root: str,
    spec: TableSpec,
    rows: DataFrame,
    on_duplicate: str = "error",
    order_by: Sequence[str] = (),
    update_cols: Sequence[str] | None = None,
    load_time: datetime | None = None,
) -> None:
    """Update stored rows by key, insert the others.

    Only partitions are rewritten that the rows fall into or that hold one of their keys. Of the others
    those are opened, for their key columns, whose filter lets one of the keys pass; none when the key
    decides the partition. With ``update_cols`` matched rows keep their other columns.
    """
    compact(spark, root, spec)
    with staging(_incoming(rows, spec, load_time), spec.name) as source:
        if source.isEmpty():
            return

        def merged(current: DataFrame) -> DataFrame:
            if update_cols is None:
                return merge.upsert(current, source, spec.keys, on_duplicate, order_by)
            return merge.upsert_partial(current, source, spec.keys, update_cols, on_duplicate, order_by)

        if spec.partition is None:
            _replace_folder(spark, table_path(root, spec), spec, merged(_stored(spark, root, spec)))
        else:
            _merge_in(spark, root, spec, source, merged)


def _merge_in(
    spark: SparkSession,
    root: str,
    spec: TableSpec,
    source: DataFrame,
    merged: Callable[[DataFrame], DataFrame],
    drop: Iterable[str] = (),
) -> None:
    """Rewrite the partitions that rows fall into or that hold one of their keys."""
    base = _base(spark, root, spec)
    touched = _values(source, spec.partition)
    if not spec.partition_from_key:
        near = _may_hold(base, root, spec, source).select(*spec.keys, spec.partition)
        touched |= _values(keyed_join(near, source.select(*spec.keys), spec.keys, "left_semi"), spec.partition)
    _swap(spark, root, spec, merged(base.where(_in_values(spec.partition, touched))), touched, drop)


def upsert_later(
    spark: SparkSession,
    root: str,
    spec: TableSpec,
    rows: DataFrame,
    on_duplicate: str = "error",
    order_by: Sequence[str] = (),
    load_time: datetime | None = None,
    buckets: int = changefiles.BUCKETS,
) -> None:
    """As ``upsert`` of whole rows, but stored as change files: no partition is read or rewritten.

    ``read_table`` shows the changed rows at once; a key that the rows repeat is an error also if it is new.
    Other changes of the table fold the changes in first, ``compact`` does nothing else.
    """
    create_table(spark, root, spec)
    changes = _incoming(rows, spec, load_time)
    if on_duplicate == "error":
        changes = changefiles.unique_keys(changes, spec.keys)
    else:
        changes = merge.checked_source(changes, spec.keys, on_duplicate, order_by)
    with staging(changes, spec.name) as source:
        if not source.isEmpty():
            changefiles.append(spark, table_path(root, spec), source, spec.keys, buckets)


def compact(spark: SparkSession, root: str, spec: TableSpec, buckets: Sequence[int] | None = None) -> None:
    """Fold the change files, or those of some buckets, into the data files."""
    path = table_path(root, spec)
    if not spec.keys or not changefiles.batches(spark, path):
        return
    if spec.partition is None:
        _replace_folder(spark, path, spec, _stored(spark, root, spec))
        return
    exchange.clear(spark, path)
    folded = changefiles.folders(spark, path, buckets)
    if folded:
        changes = changefiles.latest(spark, path, _nullable(spec.stored_schema), spec.keys, buckets)
        with staging(changes, spec.name) as source:
            _merge_in(spark, root, spec, source, lambda current: merge.upsert(current, source, spec.keys), folded)
    changefiles.drop_empty(spark, path)


def write_contacts(spark: SparkSession, root: str, rows: DataFrame, name: str = "contacts") -> None:
    """Upsert contacts by id into folders of their creation day, adding new columns.

    The column names are kept beside the table, so no run reads the footers of all files; a table
    without that list has its footers read once. A longer list is in place, in one rename, before the rows: a
    run that dies between leaves a list ahead of the table, whose new columns read as NULL.
    """
    path = f"{root.rstrip('/')}/{name}"
    rows = rows.withColumn("created_day", F.replace("created_path", F.lit("/"), F.lit("-")))
    names = list(rows.columns)
    stored = _contact_columns(spark, path)
    names += [c for c in stored if c not in names]
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in names])
    spec = TableSpec(name, schema, keys=("id",), partition="created_day", cluster=("id",))
    padded = rows.withColumns({c: F.lit(None).cast("string") for c in names if c not in rows.columns})
    if set(names) != set(stored):
        _list_columns(spark, path, [*stored, *(c for c in names if c not in stored)])
    upsert(spark, root, spec, padded, on_duplicate="latest", order_by=["updated_at"])


def _contact_columns(spark: SparkSession, path: str) -> list[str]:
    """The columns of the newest complete list, or of the files, or none without a table."""
    lists = [n for n in exchange.names(spark, _beside(path, "columns")) if n.startswith("v")]
    if lists:
        listed = spark.read.schema("value string, n int").json(f"{_beside(path, 'columns')}/{lists[-1]}")
        return [r.value for r in listed.orderBy("n").collect()]
    return spark.read.option("mergeSchema", True).parquet(path).columns if exists(spark, path) else []


def _list_columns(spark: SparkSession, path: str, names: Sequence[str]) -> None:
    """Add a version of the list of columns; the older ones go when it is there."""
    folder = _beside(path, "columns")
    before = [n for n in exchange.names(spark, folder) if n.startswith("v")]
    number = int(before[-1][1:]) + 1 if before else 1
    pending = f"{folder}/_pending"
    columns = spark.createDataFrame([(c, n) for n, c in enumerate(names)], "value string, n int")
    columns.coalesce(1).write.mode("overwrite").json(pending)
    _rename(spark, pending, f"{folder}/v{number:09d}")
    for old in before:
        remove(spark, f"{folder}/{old}")
