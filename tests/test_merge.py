"""Merges against dict models, and their errors."""

import random
from datetime import date, datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from funnelwright.operators.dedupe import first_seen, latest_per_key, load_audit
from funnelwright.operators.merge import (
    conform,
    insert_new,
    replace_range,
    update_changed,
    upsert,
    upsert_partial,
)

KV = "k string, a string, b int"


def frame(spark, data):
    return spark.createDataFrame(data, KV)


@pytest.mark.parametrize("seed", range(3))
def test_upserts_equal_dict_model(spark, rows, seed):
    rng = random.Random(seed)
    target = {f"k{i}": (f"t{i}", i) for i in rng.sample(range(40), 25)}
    source = {f"k{i}": (f"s{i}", -i) for i in rng.sample(range(40), 25)}
    t = frame(spark, [(k, *v) for k, v in target.items()]).repartition(3)
    s = frame(spark, [(k, *v) for k, v in source.items()]).repartition(4)
    assert rows(upsert(t, s, ["k"])) == sorted(((k, *v) for k, v in {**target, **source}.items()), key=repr)
    partial = {k: (target[k][0] if k in target else v[0], v[1]) for k, v in source.items()}
    assert rows(upsert_partial(t, s, ["k"], ["b"])) == sorted(
        ((k, *v) for k, v in {**target, **partial}.items()), key=repr
    )
    assert rows(insert_new(t, s, ["k"])) == sorted(((k, *v) for k, v in source.items() if k not in target), key=repr)


def test_null_keys_always_insert(spark, rows):
    t = frame(spark, [(None, "old", 1), ("x", "old", 2)])
    s = frame(spark, [(None, "new", 3)])
    both = [("x", "old", 2), (None, "new", 3), (None, "old", 1)]
    assert rows(upsert(t, s, ["k"])) == sorted(both, key=repr)
    assert rows(upsert_partial(t, s, ["k"], ["b"])) == sorted(both, key=repr)
    assert rows(insert_new(t, s, ["k"])) == [(None, "new", 3)]


@pytest.mark.parametrize("merge", [upsert, lambda t, s, k, **o: upsert_partial(t, s, k, ["b"], **o)])
def test_repeated_source_keys(spark, rows, merge):
    t = frame(spark, [("x", "old", 1)])
    matched = frame(spark, [("x", "n", 2), ("x", "n", 3)])
    with pytest.raises(PySparkException, match="several source rows"):
        merge(t, matched, ["k"]).collect()
    latest = rows(merge(t, matched, ["k"], on_duplicate="latest", order_by=["b"]), "k", "b")
    assert latest == [("x", 3)]
    unmatched = frame(spark, [("y", "n", 2), ("y", "n", 3)])
    assert len(rows(merge(t, unmatched, ["k"]))) == 3
    with pytest.raises(ValueError):
        merge(t, matched, ["k"], on_duplicate="first")


def test_update_changed(spark, rows):
    t = frame(spark, [("x", "old", 1), ("y", None, 2), ("z", "same", 3), (None, "old", 4)])
    s = spark.createDataFrame([("x", "new"), ("x", "new"), ("y", "new"), ("z", "same"), (None, "new")], "k string, a string")
    assert rows(update_changed(t, s, "k", "a")) == rows(frame(spark, [("x", "new", 1), ("y", None, 2), ("z", "same", 3), (None, "old", 4)]))
    twice = spark.createDataFrame([("x", "new"), ("x", "newer")], "k string, a string")
    with pytest.raises(PySparkException, match="several new values"):
        update_changed(t, twice, "k", "a").collect()


def test_insert_new_within_batch(spark, rows):
    t = frame(spark, [("x", "old", 1)])
    s = frame(spark, [("n", "a", 1), ("n", "b", 2), (None, "c", 3), (None, "c", 3)])
    assert len(rows(insert_new(t, s, ["k"]))) == 4
    assert rows(insert_new(t, s, ["k"], dedup_batch=True)) == rows(frame(spark, [("n", "b", 2), (None, "c", 3), (None, "c", 3)]))


def test_replace_range(spark, rows):
    t = frame(spark, [("a", "t", 1), ("b", "t", 2), ("c", "t", 3), (None, "t", 4)])
    s = frame(spark, [("b", "s", 5)])
    assert rows(replace_range(t, s, "k", "b"), "k", "b") == rows(frame(spark, [("a", "t", 1), (None, "t", 4), ("b", "s", 5)]), "k", "b")
    assert rows(replace_range(t, s, "k", "b", "b"), "k", "b") == rows(
        frame(spark, [("a", "t", 1), ("c", "t", 3), (None, "t", 4), ("b", "s", 5)]), "k", "b"
    )


def test_conform(spark):
    schema = T.StructType(
        [
            T.StructField("id", T.StringType(), False),
            T.StructField("day", T.DateType()),
            T.StructField("etl_load_date", T.TimestampType()),
        ]
    )
    df = spark.createDataFrame([("2024-01-02", 5, 1)], "day string, id int, extra int")
    row = conform(df, schema, load_time=datetime(2024, 1, 1)).first()
    assert tuple(row) == ("5", date(2024, 1, 2), datetime(2024, 1, 1))
    with pytest.raises(ValueError, match="etl_load_date"):
        conform(df, schema)
    with pytest.raises(PySparkException, match="required column id"):
        conform(df.withColumn("id", F.lit(None)), schema, load_time=datetime(2024, 1, 1)).collect()


def test_first_seen_is_independent_of_partitions(spark, rows):
    data = [(f"k{i % 5}", i // 7, i % 7, f"v{i}") for i in range(100)] + [(None, 0, 0, "dropped")]
    df = spark.createDataFrame(data, "k string, page int, pos int, v string")
    results = [rows(first_seen(df.repartition(n), ["k"], ["page", "pos"])) for n in (1, 3, 8)]
    assert results[0] == results[1] == results[2] == [(f"k{i}", 0, i, f"v{i}") for i in range(5)]
    plan = first_seen(df, ["k"], ["page", "pos"])._jdf.queryExecution().executedPlan().toString()
    partial = [line for line in plan.splitlines() if "WindowGroupLimit" in line]
    assert any("Partial" in line for line in partial)  # one row per key leaves a map task


def test_latest_per_key(spark, rows):
    df = frame(spark, [("x", "a", 1), ("x", "b", 2), (None, "c", 1), (None, "c", 1)])
    assert rows(latest_per_key(df, ["k"], ["b"])) == rows(frame(spark, [("x", "b", 2), (None, "c", 1), (None, "c", 1)]))


def test_audit(spark):
    data = [("d", "a", 1), ("d", "a", 1), ("d", "b", 0), ("d", None, 1), ("d", "", 1), ("e", "a", 1)]
    df = spark.createDataFrame(data, "day string, id string, created int")
    audit = {r["day"]: tuple(r)[1:] for r in load_audit(df, ["day"], "id", [F.col("created") > 0]).collect()}
    assert audit == {"d": (5, 2, 1, 1, 1), "e": (1, 0, 0, 0, 1)}
