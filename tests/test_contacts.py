"""Contacts of unknown fields: one parse, the same rows as the JSON reader's."""

import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from funnelwright.plans.contacts import contact_pages, contacts

PEOPLE = [
    {"id": "1", "created_at": 1700000000, "n": 1.5, "big": 12345678901234567890, "e": 1e3, "flag": True, "none": None},
    {"id": "2", "created_at": 1700000000, "n": 2, "custom": {"a b": "x", "nothing": None, "deep": {"VOID": 1, "OBJECT": "y"}}},
    {"id": "3", "tags": ["x", "y"], "mixed": {"z": [1, "two"]}, "list": [{"q": 1}, {"q": "z"}], "empty": []},
    {"id": "4", "mixed": "text", "tags": [], "custom": {"a b": "y"}, "hollow": {}, "odd`OBJECT<name": 5},
    {"id": "5", "mixed": 7, "list": [], "data": {"Kept Name": [1, 2]}, "line": "two\nlines ​"},
    {},
]


def objects(spark, rows):
    return spark.createDataFrame([(json.dumps(r, separators=(",", ":")),) for r in rows], "raw string")


def as_maps(df):
    flat = contacts(df)
    return sorted(({k: v for k, v in r.asDict().items() if v is not None} for r in flat.collect()), key=repr)


def test_same_rows_as_the_json_reader(spark, tmp_path):
    source = objects(spark, PEOPLE)
    source.write.text(str(tmp_path / "raw"))
    got = as_maps(contact_pages(source))
    assert got == as_maps(spark.read.json(str(tmp_path / "raw")))
    by_id = {r.get("id"): r for r in got}
    assert [by_id[i].get("mixed") for i in "12345"] == [None, None, '{"z":[1,"two"]}', "text", "7"]
    assert by_id["5"]["data"] == '{"Kept Name":[1,2]}' and by_id["5"]["line"] == "two\nlines "
    assert by_id["2"]["n"] == "2.0" and by_id["3"]["list"] == '[{"q":"1"},{"q":"z"}]' and len(got) == len(PEOPLE)


def test_objects_are_parsed_once(spark):
    calls = spark.sparkContext.accumulator(0)

    def counted(raw):
        calls.add(1)
        return raw

    source = objects(spark, PEOPLE)
    seen = source.select(F.udf(counted)("raw").alias("raw"))
    contacts(contact_pages(seen)).collect()
    assert calls.value == len(PEOPLE)


def test_no_objects_and_objects_without_fields(spark):
    assert contact_pages(objects(spark, [])).columns == []
    assert contact_pages(objects(spark, [{}, {"a": {}}])).columns == []


@pytest.mark.parametrize("raw", ["5", '"text"', "[1]", "{broken", '{"a": 1, "a": 2}', None])
def test_what_is_no_object_fails(spark, raw):
    with pytest.raises(PySparkException, match="landed object does not parse|USER_RAISED"):
        contact_pages(spark.createDataFrame([(raw,)], "raw string"))
