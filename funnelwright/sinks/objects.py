"""One stored object per record, under ``yyyy/MM/dd/<id>.json`` or ``unknown/<id>.json``.

The records are written by a data source of its own. Every task attempt writes its objects under hidden names into the
folders they belong to, and an index of them below a hidden folder of the target. Only when all tasks are done a commit
record names the attempts that count; then a job gives their objects the final names, each in one rename that replaces an
older object. Such a rename stays inside its folder: a local disk makes renames across folders one after the other, however
many tasks ask for them. A run that dies before its record leaves nothing to be read, one that dies after it is completed by
whoever next reads or writes; objects of failed or repeated attempts never show. Their hidden folder tells that they may have
left objects under hidden names: the next write, or the completion of theirs, lists all folders and removes them. One run at a
time may work on a target, and its store must rename files in one step.

Objects are found and read by tasks too: each lists whole folders (a day's, or ``unknown``) into a table of names. Then every
task reads the objects of a stretch of time in the order they were written, since a local disk keeps such files side by side
and reads neighbours many times faster than files here and there; it is asked for some objects ahead. The driver sees the
folders of days, no object.

A name is the id in percent encoding; it may not be longer than the store allows.
"""

from __future__ import annotations

import json
import os
import re
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import AbstractContextManager, nullcontext, suppress
from dataclasses import dataclass
from functools import partial
from itertools import islice
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark import RDD
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from ..operators.dedupe import latest_per_key
from ..session import staged
from . import exchange

FORMAT = "daily_objects"
COLUMNS = "day string, id string, body string"
INDEX = "index.txt"
UNKNOWN = "unknown"
# What a task holds at a time: names it lists, bytes it reads or writes.
NAMES, READ, BUFFER = 10_000, 1 << 22, 1 << 16
# Objects that a local disk is asked for before they are read.
AHEAD = 1_000
# Tasks that write or move objects of one folder.
SHARES = 2
# How the names of files that are no objects begin and end, as Spark's readers have it.
HIDDEN, COPYING = ("_", "."), "._COPYING_"


def _store(path: str) -> tuple[arrow_fs.FileSystem, str]:
    """The file system of a path, from inside a task."""
    if path.startswith("file:"):
        path = "/" + path[len("file:") :].lstrip("/")
    return arrow_fs.FileSystem.from_uri(path)


def _hidden(token: str, value: str) -> tuple[str, str]:
    """An index line's object below the target: its hidden name and its final one."""
    attempt, number, name = value.split("/", 2)
    return f"{name.rpartition('/')[0]}/{exchange.NEW}{token}-{attempt}-{number}", name


def object_name(day: str | None, key: str | None) -> str:
    """The place of an object below the target; a name never begins like a hidden file's."""
    name = quote(key or UNKNOWN, safe="")
    if name[:1] in ("_", "."):
        name = f"%{ord(name[0]):02X}{name[1:]}"
    return f"{day or UNKNOWN}/{name}.json"


@dataclass
class Written(WriterCommitMessage):
    attempt: str


class DailyObjects(DataSource):
    """The format ``daily_objects``: rows ``day, id, body`` with the options ``path`` and ``token``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return COLUMNS

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        if overwrite:
            raise ValueError("objects are replaced one by one; use mode append")
        return _ObjectWriter(self.options["path"], self.options["token"])


class _ObjectWriter(DataSourceWriter):
    def __init__(self, path: str, token: str):
        self.path, self.token = path, token

    def write(self, rows: Iterator[Row]) -> Written:
        store, path = _store(self.path)
        attempt = uuid.uuid4().hex
        own = f"{path}/{exchange.NEW}{self.token}/{attempt}"
        store.create_dir(own)
        known = set()
        with store.open_output_stream(f"{own}/{INDEX}", buffer_size=BUFFER) as index:
            for number, row in enumerate(rows):
                line = f"{attempt}/{number}/{object_name(row['day'], row['id'])}"
                hidden = f"{path}/{_hidden(self.token, line)[0]}"
                folder = hidden.rpartition("/")[0]
                if folder not in known:
                    store.create_dir(folder)
                    known.add(folder)
                with store.open_output_stream(hidden) as stream:
                    stream.write((row["body"] or "null").encode())
                index.write(f"{line}\n".encode())
        store.create_dir(own)  # if it is gone, the run has ended without this attempt: the next one has to clear up
        return Written(attempt)

    def commit(self, messages: list[Written | None]) -> None:
        store, path = _store(self.path)
        pending = f"{path}/{exchange.PENDING}{self.token}"
        with store.open_output_stream(pending) as stream:
            stream.write(json.dumps({"token": self.token, "attempts": [m.attempt for m in messages if m]}).encode())
        store.move(pending, f"{path}/{exchange.RECORD}{self.token}")

    def abort(self, messages: list[Written | None]) -> None:
        """Nothing: tasks may still be writing, so the hidden folder stays and the next write clears up."""


def _held(store: arrow_fs.FileSystem, name: str) -> AbstractContextManager:
    """An object kept open while it is replaced: a local disk then frees it at the end, not while its folder is locked."""
    try:
        return open(name, "rb", buffering=0) if store.type_name == "local" else nullcontext()
    except FileNotFoundError:
        return nullcontext()


def _move(path: str, token: str, rows: Iterable[Row]) -> None:
    """Give objects their final names; those that an earlier try has moved are passed over."""
    store, path = _store(path)
    for row in rows:
        hidden, name = _hidden(token, row.value)
        try:
            with _held(store, f"{path}/{name}"):
                store.move(f"{path}/{hidden}", f"{path}/{name}")
        except FileNotFoundError:
            if store.get_file_info(f"{path}/{name}").type != arrow_fs.FileType.File:
                raise


def _drop(path: str, entries: Iterable[str]) -> None:
    """Remove the objects under hidden names at and below entries."""
    store = _store(path)[0]

    def left(info: arrow_fs.FileInfo) -> bool:
        return info.base_name.startswith(exchange.NEW) if info.is_file else _seen(info)

    for entry in entries:
        for info in _files(store, entry, left):
            if info.base_name.startswith(exchange.NEW):
                store.delete_file(info.path)


def _spread(spark: SparkSession, entries: list[str]) -> RDD:
    """A folder to a task, as far as that goes."""
    context = spark.sparkContext
    return context.parallelize(entries, max(1, min(len(entries), 4 * context.defaultParallelism)))


def _dealt(names: DataFrame, *keys: Column) -> DataFrame:
    """Names spread over all cores: they are few bytes, but every one is an object to write, move or read."""
    return names.repartition(4 * names.sparkSession.sparkContext.defaultParallelism, *(keys or names.columns))


def _by_folder(folder: Column, name: Column) -> tuple[Column, Column]:
    """Keys that keep a folder to ``SHARES`` tasks: one at a time changes it, others wait for its lock."""
    return folder, F.pmod(F.hash(name), F.lit(SHARES))


def _by_time(listed: DataFrame) -> DataFrame:
    """Names in the order their files were written, a stretch of time to each of as many tasks as ``_dealt`` makes."""
    order = ("written", "path")
    parts = 4 * listed.sparkSession.sparkContext.defaultParallelism
    return listed.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("path")


def complete(spark: SparkSession, path: str) -> None:
    """Make the moves of the writes on record that are missing, as a job over their indexes."""
    strays = False
    for name in exchange.names(spark, path):
        if name.startswith(exchange.RECORD):
            record = json.loads(exchange.read_text(spark, f"{path}/{name}"))
            new = f"{path}/{exchange.NEW}{record['token']}"
            indexes = [f"{new}/{attempt}/{INDEX}" for attempt in record["attempts"]]
            if indexes:
                folder = F.regexp_extract("value", "^[^/]*/[^/]*/(.*)/[^/]*$", 1)
                names = _dealt(spark.read.text(indexes), *_by_folder(folder, F.col("value")))
                names.foreachPartition(partial(_move, path, record["token"]))
            others = set(exchange.names(spark, new)) - set(record["attempts"])
            exchange.remove(spark, f"{path}/{name}")
            if others:
                strays = True
            else:
                exchange.remove(spark, new)
    if strays:
        _clear(spark, path)


def _clear(spark: SparkSession, path: str) -> None:
    """Remove what attempts left that are on no record, if there are any; all that are on record have been moved."""
    left = [name for name in exchange.names(spark, path) if name.startswith((exchange.NEW, exchange.PENDING))]
    if any(name.startswith(exchange.NEW) for name in left):
        _spread(spark, list(_entries(*_store(path)))).foreachPartition(partial(_drop, path))
    for name in left:
        exchange.remove(spark, f"{path}/{name}")


def write_objects(spark: SparkSession, path: str, rows: DataFrame, order_by: list[str] | None = None) -> None:
    """Store each row ``day, id, body``, in place of the older object of its day and id.

    Of rows of equal day and id the last by ``order_by`` and body stays; a NULL or empty day or id is ``unknown``, a NULL or
    empty body the JSON text ``null``, since readers pass over empty files.
    """
    complete(spark, path)
    _clear(spark, path)  # after runs that died before their record
    named = rows.withColumns({c: F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit(UNKNOWN)) for c in ("day", "id")})
    newest = latest_per_key(named, ["day", "id"], order_by or []).select("day", "id", "body")
    spark.dataSource.register(DailyObjects)
    dealt = _dealt(newest, *_by_folder(F.col("day"), F.col("id")))
    dealt.write.format(FORMAT).mode("append").options(path=path, token=uuid.uuid4().hex).save()
    complete(spark, path)


def _seen(info: arrow_fs.FileInfo) -> bool:
    return not info.base_name.startswith(HIDDEN) and not info.base_name.endswith(COPYING)


def _entries(store: arrow_fs.FileSystem, folder: str, levels: int = 2) -> Iterator[str]:
    """What a target holds, with years and months opened down to the folders of days."""
    for info in filter(_seen, store.get_file_info(arrow_fs.FileSelector(folder))):
        if levels and info.type == arrow_fs.FileType.Directory and re.fullmatch(r"\d+", info.base_name):
            yield from _entries(store, info.path, levels - 1)
        else:
            yield info.path


def _files(
    store: arrow_fs.FileSystem, entry: str, wanted: Callable[[arrow_fs.FileInfo], bool] = _seen
) -> Iterator[arrow_fs.FileInfo]:
    """The files at and below an entry."""
    found = [store.get_file_info(entry)]
    while found:
        info = found.pop()
        if info.type == arrow_fs.FileType.Directory:
            found.extend(filter(wanted, store.get_file_info(arrow_fs.FileSelector(info.path))))
        elif info.type == arrow_fs.FileType.File:
            yield info


def _list(path: str, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The files of folders and when they were written, in batches of names."""
    store = _store(path)[0]
    for batch in batches:
        for entry in batch.column(0).to_pylist():
            files = _files(store, entry)
            while infos := list(islice(files, NAMES)):
                names = pa.array([info.path for info in infos], pa.string())
                written = pa.array([info.mtime_ns or 0 for info in infos], pa.int64())
                yield pa.RecordBatch.from_arrays([names, written], ["path", "written"])


def _asked(store: arrow_fs.FileSystem, names: list[str]) -> Iterator[str]:
    """Names, while a local disk is asked for the files ahead: it joins requests for neighbours."""
    local = store.type_name == "local" and hasattr(os, "posix_fadvise")
    for at, name in enumerate(names):
        if local and at % AHEAD == 0:
            for later in names[at + AHEAD if at else 0 : at + 2 * AHEAD]:
                with suppress(OSError), open(later, "rb", buffering=0) as file:
                    os.posix_fadvise(file.fileno(), 0, BUFFER, os.POSIX_FADV_WILLNEED)
        yield name


def _read(path: str, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Files with their content, in batches of some megabytes; empty ones are passed over."""
    store = _store(path)[0]

    def packed(names: list[str], contents: list[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(contents, pa.binary())], ["path", "content"])

    for batch in batches:
        names, contents, held = [], [], 0
        for name in _asked(store, batch.column(0).to_pylist()):
            with store.open_input_stream(name) as stream:
                content = stream.read()
            if not content:
                continue
            names.append(name)
            contents.append(content)
            held += len(content)
            if held >= READ:
                yield packed(names, contents)
                names, contents, held = [], [], 0
        if names:
            yield packed(names, contents)


def read_objects(spark: SparkSession, path: str) -> DataFrame:
    """The stored objects as rows ``day, id, body``; none when there is no target yet.

    They are listed at once, into the shared folder, and read when the rows are asked for.
    """
    if not exchange.exists(spark, path):
        return spark.createDataFrame([], COLUMNS)
    complete(spark, path)
    entries = list(_entries(*_store(path)))
    if not entries:
        return spark.createDataFrame([], COLUMNS)
    dealt = _spread(spark, entries).map(lambda entry: (entry,))
    listed = spark.createDataFrame(dealt, "path string").mapInArrow(partial(_list, path), "path string, written long")
    found = _by_time(staged(listed, "names")).mapInArrow(partial(_read, path), "path string, content binary")
    day = F.regexp_extract("path", rf"/({UNKNOWN}|\d+/\d\d/\d\d)/[^/]+$", 1)
    name = F.url_decode(F.regexp_extract("path", r"/([^/]+)\.json$", 1))
    return found.select(day.alias("day"), name.alias("id"), F.decode("content", "UTF-8").alias("body"))
