"""Writes to stored tables, each run into a fresh folder."""

import os
from datetime import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from funnelwright.schemas import DIM_UTM, PAYMENT_REPORT, TableSpec
from funnelwright.sinks import tables

SPEC = TableSpec(
    "facts",
    T.StructType([T.StructField(n, T.StringType()) for n in ("id", "day", "name")] + [T.StructField("n", T.LongType())]),
    keys=("id",),
    partition="day",
    cluster=("id",),
)
FLAT = TableSpec("flat", SPEC.schema, keys=("id",), cluster=("id",))
KEYED = TableSpec("keyed", SPEC.schema, keys=("id", "day"), partition="day", partition_from_key=True)


@pytest.fixture
def root(tmp_path):
    return str(tmp_path)


def frame(spark, *data):
    return spark.createDataFrame(data, SPEC.schema)


def stored(spark, root, spec=SPEC):
    return sorted((tuple(r) for r in tables.read_table(spark, root, spec).collect()), key=repr)


def folders(root, spec=SPEC):
    return sorted(f for f in os.listdir(os.path.join(root, spec.name)) if "=" in f)


@pytest.mark.parametrize("spec", [SPEC, FLAT, KEYED])
def test_create_then_upsert_twice(spark, root, spec):
    tables.create_table(spark, root, spec)
    tables.create_table(spark, root, spec)
    assert stored(spark, root, spec) == []
    batch = frame(spark, ("a", "d1", "x", 1), ("b", "d2", "y", 2))
    for _ in range(2):
        tables.upsert(spark, root, spec, batch)
        assert stored(spark, root, spec) == [("a", "d1", "x", 1), ("b", "d2", "y", 2)]
    tables.upsert(spark, root, spec, frame(spark, ("b", "d2", "z", 3), ("c", "d1", "w", 4)))
    assert stored(spark, root, spec) == [("a", "d1", "x", 1), ("b", "d2", "z", 3), ("c", "d1", "w", 4)]


def test_moved_row_leaves_no_copy_and_empties_its_partition(spark, root):
    tables.upsert(spark, root, SPEC, frame(spark, ("a", "d1", "x", 1), ("b", "d2", "y", 2), ("c", "d3", "q", 3)))
    before = os.stat(os.path.join(root, "facts", "day=d3")).st_mtime_ns
    tables.upsert(spark, root, SPEC, frame(spark, ("a", "d2", "x", 9)))
    assert stored(spark, root) == [("a", "d2", "x", 9), ("b", "d2", "y", 2), ("c", "d3", "q", 3)]
    assert folders(root) == ["day=d2", "day=d3"]
    assert os.stat(os.path.join(root, "facts", "day=d3")).st_mtime_ns == before  # not rewritten


def test_null_partition(spark, root):
    tables.upsert(spark, root, SPEC, frame(spark, ("a", None, "x", 1), ("b", "d1", "y", 2)))
    tables.upsert(spark, root, SPEC, frame(spark, ("a", "d1", "x", 3)))
    assert stored(spark, root) == [("a", "d1", "x", 3), ("b", "d1", "y", 2)]
    assert folders(root) == ["day=d1"]


def test_partial_upsert_keeps_other_columns(spark, root):
    tables.upsert(spark, root, KEYED, frame(spark, ("a", "d1", "old name", 1)))
    batch = frame(spark, ("a", "d1", "new name", 2), ("b", "d1", "new", 3))
    tables.upsert(spark, root, KEYED, batch, update_cols=["n"])
    assert stored(spark, root, KEYED) == [("a", "d1", "old name", 2), ("b", "d1", "new", 3)]


def test_failed_upsert_changes_nothing(spark, root):
    tables.upsert(spark, root, SPEC, frame(spark, ("a", "d1", "x", 1)))
    with pytest.raises(PySparkException):
        tables.upsert(spark, root, SPEC, frame(spark, ("a", "d1", "y", 2), ("a", "d1", "z", 3)))
    assert stored(spark, root) == [("a", "d1", "x", 1)]
    tables.upsert(spark, root, SPEC, frame(spark, ("a", "d1", "y", 2), ("a", "d1", "z", 3)), "latest", ["n"])
    assert stored(spark, root) == [("a", "d1", "z", 3)]


def test_append_new_is_idempotent(spark, root):
    batch = frame(spark, ("a", "d1", "x", 1), (None, "d1", "n", 0))
    tables.append_new(spark, root, SPEC, batch.where("id IS NOT NULL"))
    tables.append_new(spark, root, SPEC, batch.where("id IS NOT NULL"))
    assert stored(spark, root) == [("a", "d1", "x", 1)]
    tables.append_new(spark, root, SPEC, frame(spark, ("a", "d2", "late", 5), ("b", "d1", "y", 2)))
    assert stored(spark, root) == [("a", "d1", "x", 1), ("b", "d1", "y", 2)]
    tables.append_new(spark, root, KEYED, frame(spark, ("a", "d1", "x", 1)))
    tables.append_new(spark, root, KEYED, frame(spark, ("a", "d1", "x", 1), ("a", "d2", "x", 1)))
    assert len(stored(spark, root, KEYED)) == 2


def test_replace_range_drops_days_without_rows(spark, root):
    tables.upsert(spark, root, SPEC, frame(spark, *[(d, d, "x", 1) for d in ("d1", "d2", "d3")]))
    tables.replace_range(spark, root, SPEC, frame(spark, ("n", "d3", "y", 2)), "d2")
    assert stored(spark, root) == [("d1", "d1", "x", 1), ("n", "d3", "y", 2)]
    assert folders(root) == ["day=d1", "day=d3"]


def test_rebuild(spark, root):
    tables.rebuild(spark, root, SPEC, frame(spark, ("a", "d1", "x", 1)))
    tables.rebuild(spark, root, SPEC, frame(spark, ("b", "d2", "y", 2)))
    assert stored(spark, root) == [("b", "d2", "y", 2)]
    tables.rebuild(spark, root, FLAT, frame(spark, ("a", "d1", "x", 1)))
    tables.rebuild(spark, root, FLAT, frame(spark, ("b", "d2", "y", 2)))
    assert stored(spark, root, FLAT) == [("b", "d2", "y", 2)]


def test_dimension_refresh(spark, root):
    def dim(*data):
        return spark.createDataFrame([(h, c, *["v"] * 5) for h, c in data], DIM_UTM.schema)

    tables.append_new(spark, root, DIM_UTM, dim(("h1", "old"), ("h2", "same")))
    news = dim(("h1", "new"), ("h2", "same"), ("h3", "added"))
    tables.append_new(spark, root, DIM_UTM, news)
    tables.update_changed(spark, root, DIM_UTM, news, "channel")
    assert [r[:2] for r in stored(spark, root, DIM_UTM)] == [("h1", "new"), ("h2", "same"), ("h3", "added")]


def test_derived_partition_column(spark, root):
    def report(*data):
        return spark.createDataFrame(data, PAYMENT_REPORT.schema)

    at = datetime(2024, 1, 1, 5)
    tables.create_table(spark, root, PAYMENT_REPORT)
    tables.upsert(spark, root, PAYMENT_REPORT, report(("a", at, "{}", at), ("b", None, "{}", at)))
    tables.upsert(spark, root, PAYMENT_REPORT, report(("b", datetime(2024, 1, 2, 5), "{}", at)))
    assert folders(root, PAYMENT_REPORT) == ["created_day=2024-01-01", "created_day=2024-01-02"]
    assert [r[0] for r in stored(spark, root, PAYMENT_REPORT)] == ["a", "b"]
    assert tables.read_table(spark, root, PAYMENT_REPORT).columns == PAYMENT_REPORT.schema.names


def test_load_time_is_added(spark, root):
    schema = T.StructType([*SPEC.schema.fields, T.StructField("etl_load_date", T.TimestampType())])
    spec = TableSpec("stamped", schema, keys=("id",))
    tables.upsert(spark, root, spec, frame(spark, ("a", "d", "x", 1)), load_time=datetime(2024, 1, 1))
    assert stored(spark, root, spec) == [("a", "d", "x", 1, datetime(2024, 1, 1))]


def test_staging_is_removed_after_success_and_kept_after_failure(spark, root):
    df = spark.range(3)
    with tables.staging(df, "label") as copy:
        path = copy.inputFiles()[0].rsplit("/", 1)[0]
        assert copy.count() == 3
    assert not tables.exists(spark, path)
    with pytest.raises(RuntimeError), tables.staging(df, "label") as copy:
        path = copy.inputFiles()[0].rsplit("/", 1)[0]
        raise RuntimeError
    assert tables.exists(spark, path)


def test_contacts_gain_columns(spark, root):
    first = spark.createDataFrame([("a", "1", "2024/01/02", "x")], "id string, updated_at string, created_path string, one string")
    tables.write_contacts(spark, root, first)
    second = spark.createDataFrame(
        [("a", "2", "2024/01/02", "y"), ("b", "1", "unknown", "z")], "id string, updated_at string, created_path string, two string"
    )
    tables.write_contacts(spark, root, second)
    df = spark.read.option("mergeSchema", True).parquet(f"{root}/contacts")
    got = sorted(tuple(r) for r in df.select("id", "updated_at", F.col("created_day").cast("string"), F.coalesce("one", F.lit("-")), "two").collect())
    assert got == [("a", "2", "2024-01-02", "-", "y"), ("b", "1", "unknown", "-", "z")]


def test_replacement_that_died_is_completed_or_undone(spark, root):
    path = tables.table_path(root, FLAT)
    old, new = tables._beside(path, "old"), tables._beside(path, "new")
    tables.rebuild(spark, root, FLAT, frame(spark, ("a", "d1", "x", 1)))
    os.rename(path, old)
    assert stored(spark, root, FLAT) == [("a", "d1", "x", 1)]  # died before the new content was there
    os.rename(path, old)
    tables._write(frame(spark, ("b", "d2", "y", 2)), new, FLAT, "overwrite")
    assert stored(spark, root, FLAT) == [("b", "d2", "y", 2)]  # died between the two moves
    assert not os.path.exists(old) and not os.path.exists(new)


def test_content_may_come_from_the_table_itself(spark, root):
    for spec in (SPEC, FLAT):
        tables.rebuild(spark, root, spec, frame(spark, ("a", "d1", "x", 1), ("b", "d2", "y", 2)))
        tables.rebuild(spark, root, spec, tables.read_table(spark, root, spec).withColumn("n", F.col("n") + 1))
        assert stored(spark, root, spec) == [("a", "d1", "x", 2), ("b", "d2", "y", 3)]


def test_contacts_without_a_column_list(spark, root):
    rows = spark.createDataFrame([("a", "1", "2024/01/02", "x")], "id string, updated_at string, created_path string, one string")
    tables.write_contacts(spark, root, rows)
    tables.remove(spark, tables._beside(f"{root}/contacts", "columns"))
    tables.write_contacts(spark, root, rows.withColumn("id", F.lit("b")).drop("one"))
    got = spark.read.parquet(f"{root}/contacts").select("id", "one").collect()
    assert sorted(map(tuple, got), key=repr) == [("a", "x"), ("b", None)]
