"""Exchanges of folders inside a stored table that a crash cannot leave half done.

New content is written to a hidden folder of the table. Then a commit record is written, in one rename: the
list of folders to take in and of those to drop. From there on the exchange is only ever completed: whoever
next reads or changes the table finds the record and makes the moves that are missing. A run that dies before
its record leaves the old rows, one that dies after it the new ones; nothing in between is read.

The store must rename a folder in one step (a local disk, HDFS; not a plain object store), and one run at a
time may work on a table.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from pyspark.sql import SparkSession

# Readers pass over names with an underscore.
NEW, OLD, PENDING, RECORD = "_new-", "_old-", "_pending-", "_exchange-"


def _filesystem(spark: SparkSession, path: str):
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


def exists(spark: SparkSession, path: str) -> bool:
    fs, location = _filesystem(spark, path)
    return fs.exists(location)


def remove(spark: SparkSession, path: str) -> None:
    fs, location = _filesystem(spark, path)
    fs.delete(location, True)


def rename(spark: SparkSession, source: str, target: str) -> None:
    """Move a file or folder to a name that is free, making the folders above it."""
    fs, location = _filesystem(spark, source)
    aim = _filesystem(spark, target)[1]
    fs.mkdirs(aim.getParent())
    if not fs.rename(location, aim):
        raise OSError(f"cannot move {source} to {target}")


def names(spark: SparkSession, path: str) -> list[str]:
    """What a folder holds; nothing if there is none."""
    fs, location = _filesystem(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(location)) if fs.exists(location) else []


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, location = _filesystem(spark, path)
    stream = fs.create(location, True)
    stream.write(bytearray(text.encode()))
    stream.close()


def read_text(spark: SparkSession, path: str) -> str:
    fs, location = _filesystem(spark, path)
    stream = fs.open(location)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def new_folder(table: str) -> str:
    """A fresh hidden folder of the table for content to come."""
    return f"{table}/{NEW}{uuid.uuid4().hex}"


def commit(spark: SparkSession, table: str, new: str, take: Iterable[str], drop: Iterable[str]) -> None:
    """Record that the folders ``take`` of ``new`` replace the table's, and that those in ``drop`` go."""
    token = new.rpartition(NEW)[2]
    record = {"token": token, "take": sorted(take), "drop": sorted(drop)}
    pending = f"{table}/{PENDING}{token}"
    _write_text(spark, pending, json.dumps(record))
    rename(spark, pending, f"{table}/{RECORD}{token}")


def complete(spark: SparkSession, table: str) -> None:
    """Make the moves of the exchanges on record that are missing."""
    for name in names(spark, table):
        if name.startswith(RECORD):
            _complete(spark, table, name)


def _complete(spark: SparkSession, table: str, name: str) -> None:
    record = json.loads(read_text(spark, f"{table}/{name}"))
    new, old = f"{table}/{NEW}{record['token']}", f"{table}/{OLD}{record['token']}"
    for folder in record["take"] + record["drop"]:
        taken = folder in record["take"]
        if taken and not exists(spark, f"{new}/{folder}"):
            continue  # has been moved
        if exists(spark, f"{table}/{folder}") and not exists(spark, f"{old}/{folder}"):
            rename(spark, f"{table}/{folder}", f"{old}/{folder}")
        if taken:
            rename(spark, f"{new}/{folder}", f"{table}/{folder}")
    remove(spark, f"{table}/{name}")
    remove(spark, new)
    remove(spark, old)


def clear(spark: SparkSession, table: str) -> None:
    """Complete what is on record, and remove what runs left that died before their record or after their moves."""
    complete(spark, table)
    for name in names(spark, table):
        if name.startswith((NEW, OLD, PENDING)):
            remove(spark, f"{table}/{name}")


def exchange(spark: SparkSession, table: str, new: str, take: Iterable[str], drop: Iterable[str]) -> None:
    """Commit and complete."""
    commit(spark, table, new, take, drop)
    complete(spark, table)
