"""Which partitions an upsert opens."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from funnelwright.schemas import TableSpec
from funnelwright.sinks import keyfilters, tables

SPEC = TableSpec(
    "facts",
    T.StructType([T.StructField(n, T.StringType()) for n in ("id", "day", "name")]),
    keys=("id",),
    partition="day",
    cluster=("id",),
)


def filled(spark, root, days=20, rows=50):
    data = [(f"{d}-{i}", f"d{d:02d}", "x") for d in range(days) for i in range(rows)]
    tables.rebuild(spark, root, SPEC, spark.createDataFrame(data, SPEC.schema))
    return data


def parts(spark, root, *ids):
    asked = spark.createDataFrame([(i,) for i in ids], "id string")
    return keyfilters.may_hold(tables._base(spark, root, SPEC), f"{root}/facts", "day", ["id"], asked)


def spoil(root, day):
    """Replace the bytes of a partition's files: whoever opens them fails."""
    folder = f"{root}/facts/day={day}"
    for name in os.listdir(folder):
        if name.endswith(".parquet"):
            with open(f"{folder}/{name}", "wb") as file:
                file.write(b"no parquet")
            crc = f"{folder}/.{name}.crc"
            if os.path.exists(crc):
                os.remove(crc)


def test_holders_are_found_and_few_others(spark, tmp_path):
    root = str(tmp_path)
    data = filled(spark, root)
    for key, day, _ in data[::97]:
        assert day in parts(spark, root, key)
    passed = sum(len(parts(spark, root, *(f"strange {n}-{i}" for i in range(5)))) for n in range(3))
    assert passed <= 12  # of 300 (key, partition) pairs
    assert parts(spark, root, None) == [] and parts(spark, root) == []


def test_an_upsert_opens_only_what_may_hold_its_keys(spark, tmp_path):
    root = str(tmp_path)
    data = filled(spark, root)
    key = data[5 * 50][0]
    may = set(parts(spark, root, key))
    others = {day for _, day, _ in data} - may - {"d19"}
    assert len(others) >= 15
    for day in others:
        spoil(root, day)
    tables.upsert(spark, root, SPEC, spark.createDataFrame([(key, "d19", "moved")], SPEC.schema))
    for day in ("d05", "d19"):
        found = spark.read.schema(tables._nullable(SPEC.schema)).parquet(f"{root}/facts").where(F.col("day") == day)
        assert found.where(F.col("id") == key).count() == (day == "d19")
        assert found.count() == (51 if day == "d19" else 49)


def test_filters_follow_every_change(spark, tmp_path):
    root = str(tmp_path)
    filled(spark, root, days=3, rows=4)
    assert "d01" in parts(spark, root, "1-0")
    # a file is added past the filter, as an append or another program would
    extra = spark.createDataFrame([("late", "x")], "id string, name string")
    extra.write.mode("append").parquet(f"{root}/facts/day=d02")
    assert "d02" in parts(spark, root, "late")
    tables.append_new(spark, root, SPEC, spark.createDataFrame([("late", "d00", "y"), ("new", "d00", "y")], SPEC.schema))
    assert "d00" in parts(spark, root, "new")
    assert tables.read_table(spark, root, SPEC).where("id = 'late'").count() == 1
    tables.replace_range(spark, root, SPEC, spark.createDataFrame([], SPEC.schema), "d02")
    assert "d02" not in parts(spark, root, "late", "2-0")


def test_a_damaged_filter_is_made_again(spark, tmp_path):
    root = str(tmp_path)
    filled(spark, root, days=3, rows=4)
    tables.upsert(spark, root, SPEC, spark.createDataFrame([("0-0", "d00", "y")], SPEC.schema))
    folder = f"{root}/facts/{keyfilters.FOLDER}"
    for name in os.listdir(folder):
        if name.startswith("folder=of d01") or "d01" in name:
            for file in os.listdir(f"{folder}/{name}"):
                os.remove(f"{folder}/{name}/{file}")
    assert "d01" in parts(spark, root, "1-3")


@pytest.mark.parametrize("block", [1, 512])
def test_filters_of_several_blocks_and_null_partitions(spark, tmp_path, monkeypatch, block):
    monkeypatch.setattr(keyfilters, "BLOCK", block)
    root = str(tmp_path)
    data = [(f"k{i}", None if i % 2 else "d1", "x") for i in range(300)] + [(None, "d2", "no key")]
    tables.upsert(spark, root, SPEC, spark.createDataFrame(data, SPEC.schema))
    found = {i: parts(spark, root, f"k{i}") for i in range(0, 300, 61)}
    assert all((keyfilters.NULL_FOLDER if i % 2 else "d1") in where for i, where in found.items())
    tables.upsert(spark, root, SPEC, spark.createDataFrame([("k7", "d2", "moved")], SPEC.schema))
    assert tables.read_table(spark, root, SPEC).where("id = 'k7'").collect()[0].day == "d2"
    assert tables.read_table(spark, root, SPEC).count() == 301
