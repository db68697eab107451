"""Objects by day: replaced one by one, nothing of failed runs to be seen."""

import json
import os
from datetime import date

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from funnelwright import jobs
from funnelwright.sinks import exchange, objects

ROWS = "day string, id string, body string, n int"


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "objects")


def write(spark, path, *rows):
    objects.write_objects(spark, path, spark.createDataFrame(rows, ROWS), ["n"])


def stored(spark, path):
    return sorted(tuple(r) for r in objects.read_objects(spark, path).select("day", "id", "body").collect())


def test_objects_replace_older_ones(spark, path):
    assert stored(spark, path) == []
    write(spark, path, ("2024/01/31", "a", "1", 1), ("2024/01/31", "b", "é\nx", 1), ("2024/02/01", "a", "other", 1))
    write(spark, path, ("2024/01/31", "a", "old", 1), ("2024/01/31", "a", "new", 2), ("2024/01/31", "c", None, 1))
    write(spark, path)
    expected = [("2024/01/31", "a", "new"), ("2024/01/31", "b", "é\nx"), ("2024/01/31", "c", "null"), ("2024/02/01", "a", "other")]
    assert stored(spark, path) == expected
    assert sorted(os.listdir(path)) == ["2024"]  # nothing hidden is left


def test_odd_ids_and_missing_ones(spark, path):
    ids = ["_hidden", ".dot", "..", "a/b", "50% + x", "ü", "x.json", "index.txt"]
    write(spark, path, *[("unknown" if i % 2 else None, k, str(i), 1) for i, k in enumerate(ids)], (None, None, "none", 1), ("", "", "no", 2))
    assert stored(spark, path) == sorted([("unknown", k, str(i)) for i, k in enumerate(ids)] + [("unknown", "unknown", "no")])


def test_a_failed_task_leaves_nothing(spark, path):
    write(spark, path, ("2024/01/31", "a", "1", 1))
    rows = spark.range(0, 40, 1, 8).select(
        F.lit("2024/01/31").alias("day"),
        F.when(F.col("id") == 39, F.raise_error(F.lit("broken row"))).otherwise(F.col("id")).cast("string").alias("id"),
        F.lit("2").alias("body"),
    )
    with pytest.raises(PySparkException):
        rows.write.format(objects.FORMAT).mode("append").options(path=path, token="t").save()
    # tasks that were still running may leave hidden files, which the next write removes
    assert stored(spark, path) == [("2024/01/31", "a", "1")]
    assert not any(n.startswith((exchange.RECORD, exchange.PENDING)) for n in os.listdir(path))
    write(spark, path, ("2024/01/31", "b", "3", 1))
    assert stored(spark, path) == [("2024/01/31", "a", "1"), ("2024/01/31", "b", "3")]


@pytest.mark.parametrize("moved", [0, 1, 2, 3])
def test_a_run_that_dies_after_its_record_is_completed(spark, path, monkeypatch, moved):
    write(spark, path, ("2024/01/31", "a", "old", 1), ("2024/01/31", "z", "kept", 1))
    plain = objects.complete
    calls = []

    def dying(spark, path):
        calls.append(1)
        if len(calls) > 1:
            raise RuntimeError("killed")

    monkeypatch.setattr(objects, "complete", dying)
    with pytest.raises(RuntimeError):
        write(spark, path, ("2024/01/31", "a", "new", 1), ("2024/02/01", "b", "new", 1), ("unknown", "c", "new", 1))
    monkeypatch.setattr(objects, "complete", plain)
    (record,) = (n for n in os.listdir(path) if n.startswith(exchange.RECORD))
    token = json.loads(open(os.path.join(path, record), encoding="utf8").read())["token"]
    lines = spark.read.text(f"{path}/{exchange.NEW}{token}/*/{objects.INDEX}").orderBy("value").collect()
    assert len(lines) == 3
    objects._move(path, token, lines[:moved])
    for _ in range(2):
        assert stored(spark, path) == [("2024/01/31", "a", "new"), ("2024/01/31", "z", "kept"), ("2024/02/01", "b", "new"), ("unknown", "c", "new")]
    assert sorted(os.listdir(path)) == ["2024", "unknown"]


def test_a_run_that_dies_before_its_record_leaves_the_old(spark, path):
    write(spark, path, ("2024/01/31", "a", "old", 1))
    rows = spark.createDataFrame([("2024/01/31", "a", "new")], objects.COLUMNS)
    writer = objects._ObjectWriter(path, "dead")
    message = writer.write(iter(rows.collect()))
    assert stored(spark, path) == [("2024/01/31", "a", "old")]
    write(spark, path, ("2024/01/31", "b", "x", 1))
    assert stored(spark, path) == [("2024/01/31", "a", "old"), ("2024/01/31", "b", "x")]
    assert sorted(os.listdir(path)) == ["2024"] and message.attempt


def test_contacts_as_objects(spark, path):
    kind = "id string, created_at long, updated_at long, `a b` struct<`c-d`: string>"
    rows = [("1", 1706700000, 1706700000, ("x",)), ("1", 1706700000, 1706700001, ("y",)), ("2", None, 1706700000, None), ("3", 0, 1606700000, None)]
    for _ in range(2):
        jobs.store_contacts(spark, path, spark.createDataFrame(rows, kind), date(2024, 1, 31))
    got = stored(spark, path)
    assert [r[:2] for r in got] == [("2024/01/31", "1"), ("unknown", "2")]
    assert json.loads(got[0][2])["a_b"] == {"c_d": "y"}


def hidden(path):
    return [n for _, folders, files in os.walk(path) for n in folders + files if n.startswith("_")]


def test_objects_are_moved_inside_their_folder(spark, path, monkeypatch):
    # renames across folders are made one after the other by a local disk, whatever the number of tasks
    write(spark, path, ("2024/01/31", "a", "old", 1))
    writer = objects._ObjectWriter(path, "t")
    rows = [("2024/01/31", "a", "new"), ("2024/02/01", "b", "x"), ("unknown", "c", "y")]
    message = writer.write(iter(spark.createDataFrame(rows, objects.COLUMNS).collect()))
    lines = spark.read.text(f"{path}/{exchange.NEW}t/{message.attempt}/{objects.INDEX}").collect()
    moves = []

    class Store:
        type_name = "other"

        def move(self, source, target):
            moves.append((os.path.dirname(source), os.path.dirname(target)))
            os.rename(source, target)

    monkeypatch.setattr(objects, "_store", lambda path: (Store(), path))
    objects._move(path, "t", lines)
    assert len(moves) == 3 and all(source == target for source, target in moves)


def test_a_late_copy_of_the_moves_changes_nothing(spark, path):
    write(spark, path, ("2024/01/31", "a", "1", 1))
    writer = objects._ObjectWriter(path, "t")
    message = writer.write(iter(spark.createDataFrame([("2024/01/31", "a", "2")], objects.COLUMNS).collect()))
    lines = spark.read.text(f"{path}/{exchange.NEW}t/{message.attempt}/{objects.INDEX}").collect()
    writer.commit([message])
    assert stored(spark, path) == [("2024/01/31", "a", "2")]
    write(spark, path, ("2024/01/31", "a", "3", 1))
    objects._move(path, "t", lines)
    assert stored(spark, path) == [("2024/01/31", "a", "3")] and hidden(path) == []


def test_attempts_that_do_not_count_are_cleared(spark, path):
    write(spark, path, ("2024/01/31", "a", "old", 1))
    (row,) = spark.createDataFrame([("2024/01/31", "a", "new")], objects.COLUMNS).collect()
    writer = objects._ObjectWriter(path, "t")
    first, second = writer.write(iter([row])), writer.write(iter([row, row]))
    assert first.attempt != second.attempt and len(hidden(path)) == 4
    writer.commit([first, None])
    assert stored(spark, path) == [("2024/01/31", "a", "new")] and hidden(path) == []
    objects._ObjectWriter(path, "dead").write(iter([row]))  # and of a run without a record, with the next write
    assert stored(spark, path) == [("2024/01/31", "a", "new")] and hidden(path) != []
    write(spark, path, ("2024/01/31", "b", "x", 1))
    assert stored(spark, path) == [("2024/01/31", "a", "new"), ("2024/01/31", "b", "x")] and hidden(path) == []


def test_a_folder_is_changed_by_few_tasks(spark):
    rows = spark.range(2000).select(F.lit("2024/01/31").alias("day"), F.col("id").cast("string"))
    dealt = objects._dealt(rows, *objects._by_folder(F.col("day"), F.col("id")))
    assert 1 < dealt.select(F.spark_partition_id()).distinct().count() <= objects.SHARES


def test_objects_are_read_in_the_order_they_were_written(spark, path):
    # neighbours on the disk, whatever their folders and names; dealt by name they lie all over it
    write(spark, path, *[(("2024/01/31", "2024/02/01", "unknown")[i % 3], f"c{i}", str(i), 1) for i in range(60)])
    order = sorted(range(60), key=lambda i: (i * 37) % 60)
    for at, i in enumerate(order):
        os.utime(f"{path}/{('2024/01/31', '2024/02/01', 'unknown')[i % 3]}/c{i}.json", (1_706_700_000, 1_706_700_000 + at))
    assert [int(r.body) for r in objects.read_objects(spark, path).collect()] == order


def test_folders_without_objects(spark, path):
    os.makedirs(f"{path}/2024/01/31")
    assert stored(spark, path) == []


def test_files_are_asked_for_ahead(path, monkeypatch):
    os.makedirs(path)
    names = [f"{path}/{i}" for i in range(7)]
    for name in names[:6]:
        open(name, "w", encoding="utf8").write(name)
    asked = []
    monkeypatch.setattr(objects, "AHEAD", 2)
    monkeypatch.setattr(os, "posix_fadvise", lambda file, *_: asked.append(os.read(file, 99).decode()))
    store, seen = objects._store(path)[0], []
    for name in objects._asked(store, names):  # the last one is gone: whoever reads it says so
        seen.append(name)
        assert set(seen) - {names[6]} <= set(asked)
    assert seen == names and asked == names[:6]
