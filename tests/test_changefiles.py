"""Upserts stored as change files, and their folding into the data."""

import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import types as T

from funnelwright.schemas import TableSpec
from funnelwright.sinks import changefiles, tables

FIELDS = [T.StructField(n, T.StringType()) for n in ("id", "day")] + [T.StructField("n", T.LongType())]
SPEC = TableSpec("facts", T.StructType(FIELDS), keys=("id",), partition="day", cluster=("id",))
FLAT = TableSpec("flat", SPEC.schema, keys=("id",), cluster=("id",))


def rows(spark, *data):
    return spark.createDataFrame(data, SPEC.schema)


def stored(spark, root, spec=SPEC):
    return sorted((tuple(r) for r in tables.read_table(spark, root, spec).collect()), key=repr)


def files(root):
    return {os.path.join(d, f) for d, _, names in os.walk(f"{root}/facts") for f in names if f.endswith(".parquet")}


def test_scattered_changes_write_one_small_set_of_files(spark, tmp_path):
    root = str(tmp_path)
    base = spark.range(20_000).selectExpr("concat('k', id) AS id", "concat('d', id % 100) AS day", "id AS n")
    tables.rebuild(spark, root, SPEC, base)
    before = files(root)
    changes = spark.range(100).selectExpr("concat('k', id) AS id", "concat('d', id % 100) AS day", "-1L AS n")
    tables.upsert_later(spark, root, SPEC, changes)
    added = files(root) - before
    assert before <= files(root) and 1 <= len(added) <= changefiles.BUCKETS
    table = tables.read_table(spark, root, SPEC)
    assert (table.count(), table.where("n = -1").count()) == (20_000, 100)
    tables.compact(spark, root, SPEC)
    table = tables.read_table(spark, root, SPEC)
    assert (table.count(), table.where("n = -1").count()) == (20_000, 100)
    assert not changefiles.batches(spark, f"{root}/facts")


@pytest.mark.parametrize("spec", [SPEC, FLAT])
def test_newest_wins_before_and_after_folding(spark, tmp_path, spec):
    root = str(tmp_path)
    tables.rebuild(spark, root, spec, rows(spark, ("a", "d1", 1), ("b", "d1", 2)))
    tables.upsert_later(spark, root, spec, rows(spark, ("a", "d2", 10), ("c", "d3", 3)))
    tables.upsert_later(spark, root, spec, rows(spark, ("a", "d3", 100)))
    expected = [("a", "d3", 100), ("b", "d1", 2), ("c", "d3", 3)]
    assert stored(spark, root, spec) == expected
    tables.compact(spark, root, spec)
    tables.compact(spark, root, spec)
    assert stored(spark, root, spec) == expected


def test_buckets_may_be_folded_one_at_a_time(spark, tmp_path):
    root = str(tmp_path)
    tables.rebuild(spark, root, SPEC, rows(spark, *((f"k{i}", "d1", i) for i in range(40))))
    for n in (100, 200):
        tables.upsert_later(spark, root, SPEC, rows(spark, *((f"k{i}", f"d{i % 3}", n + i) for i in range(30))), buckets=4)
    expected = sorted([(f"k{i}", f"d{i % 3}", 200 + i) for i in range(30)] + [(f"k{i}", "d1", i) for i in range(30, 40)], key=repr)
    for bucket in range(4):
        assert stored(spark, root) == expected
        tables.compact(spark, root, SPEC, [bucket])
        assert not any(f.endswith(f"bucket={bucket}") for f in changefiles.folders(spark, f"{root}/facts"))
    assert stored(spark, root) == expected and not changefiles.batches(spark, f"{root}/facts")


def test_other_changes_see_them(spark, tmp_path):
    root = str(tmp_path)
    tables.rebuild(spark, root, SPEC, rows(spark, ("a", "d1", 1), ("b", "d2", 2)))
    tables.upsert_later(spark, root, SPEC, rows(spark, ("a", "d2", 10)))
    tables.upsert(spark, root, SPEC, rows(spark, ("a", "d3", 20)))
    assert stored(spark, root) == [("a", "d3", 20), ("b", "d2", 2)]
    tables.upsert_later(spark, root, SPEC, rows(spark, ("c", "d1", 3)))
    tables.append_new(spark, root, SPEC, rows(spark, ("c", "d2", 4), ("e", "d2", 5)))
    assert stored(spark, root) == [("a", "d3", 20), ("b", "d2", 2), ("c", "d1", 3), ("e", "d2", 5)]
    tables.upsert_later(spark, root, SPEC, rows(spark, ("b", "d3", 6)))
    tables.replace_range(spark, root, SPEC, rows(spark, ("z", "d3", 9)), "d3")
    assert stored(spark, root) == [("c", "d1", 3), ("e", "d2", 5), ("z", "d3", 9)]
    tables.upsert_later(spark, root, SPEC, rows(spark, ("c", "d5", 7)))
    tables.rebuild(spark, root, SPEC, tables.read_table(spark, root, SPEC))
    assert stored(spark, root) == [("c", "d5", 7), ("e", "d2", 5), ("z", "d3", 9)]


def test_null_keys_and_repeated_keys(spark, tmp_path):
    root = str(tmp_path)
    tables.upsert_later(spark, root, SPEC, rows(spark, (None, "d1", 1), (None, "d1", 2), ("a", "d1", 3)))
    assert len(stored(spark, root)) == 3
    tables.upsert_later(spark, root, SPEC, rows(spark))
    with pytest.raises(PySparkException):
        tables.upsert_later(spark, root, SPEC, rows(spark, ("a", "d1", 4), ("a", "d2", 5)))
    tables.upsert_later(spark, root, SPEC, rows(spark, ("a", "d1", 4), ("a", "d2", 5)), "latest", ["n"])
    expected = [("a", "d2", 5), (None, "d1", 1), (None, "d1", 2)]
    assert stored(spark, root) == expected
    tables.compact(spark, root, SPEC)
    assert stored(spark, root) == expected
