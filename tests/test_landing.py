"""Landed feeds: edge rows of pages, reports, ads, contacts and file formats."""

import csv
import json
import os
import random
from datetime import date, datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from funnelwright import jobs
from funnelwright.functions.times import DayRange
from funnelwright.operators.reshape import clean_records, flatten_structs, keep_columns, keys_and_rest, text_columns
from funnelwright.plans.ads import search_ads_hourly, social_ads_hourly
from funnelwright.plans.billing import billing_audit, billing_events, billing_objects
from funnelwright.plans.contacts import contacts
from funnelwright.plans.reports import payment_report, payment_report_history
from funnelwright.schemas import BILLING_EVENTS, SOCIAL_ADS_ROWS, billing_object
from funnelwright.sinks import tables
from funnelwright.sources.readers import blank_missing, broken_pages, page_objects, read_landed, read_pages, read_report
from funnelwright.sources.slices import EVENT_TYPES, INTENT_EVENT_TYPES, OBJECT_EVENT_TYPES
from funnelwright.streaming.landed import load_new_pages

LOADED = datetime(2024, 2, 1)
DAY = DayRange(date(2023, 11, 14), date(2023, 11, 14))


def pages(*documents):
    return [json.dumps({"page": n, "data": data}, ensure_ascii=False) for n, data in enumerate(documents)]


def objects(spark, *documents):
    return page_objects(spark.createDataFrame([(p,) for p in pages(*documents)], "value string"), "value")


def test_billing_objects(spark):
    first = [
        {"id": "a", "created": 1700000000, "note": "é", "sub": {"x": None}},
        {"id": "", "created": 1700000000},
        {"created": 1700000000},
        {"id": "zero", "created": 0},
        {"id": "none"},
    ]
    second = [
        {"id": "a", "created": 1700000000, "note": "later copy"},
        {"id": "end", "created": 1700006399},
        {"id": "next", "created": 1700006400},
    ]
    source = objects(spark, first, second)
    got = {r.id: r for r in billing_objects(source, LOADED, DAY).collect()}
    assert set(got) == {"a", "end"}
    assert json.loads(got["a"].data) == first[0]
    assert got["a"].created_at == date(2023, 11, 14) and got["a"].etl_load_date == LOADED
    assert {r.id for r in billing_objects(source, LOADED).collect()} == {"a", "end", "next"}
    assert billing_objects(source, LOADED).columns == billing_object("charges").schema.names
    audit = {r.created_at: r for r in billing_audit(source).collect()}
    day = audit[date(2023, 11, 14)]
    assert (day.fetched, day.without_key, day.duplicates, day.rejected, day.loaded) == (5, 2, 1, 0, 2)
    assert audit[None].rejected == 2


def test_billing_events(spark):
    def event(id_, kind, inner):
        return {"id": id_, "type": kind, "created": 1700000000, "data": {"object": inner}}

    source = objects(
        spark,
        [
            event("e1", "charge.updated", {"id": "c1", "nested": {"k": [1, 2]}}),
            event("e2", "charge.updated", {"no": "id"}),
            event("e3", "other.type", {"id": "c3"}),
            {"id": "e4", "type": "charge.updated", "created": 1700000000},
            event("e5", "payment_intent.succeeded", {"id": "p5"}),
        ],
    )
    got = {r.id: r for r in billing_events(source, LOADED, DAY).collect()}
    assert set(got) == {"e1", "e5"}
    assert got["e1"].object_id == "c1" and json.loads(got["e1"].data) == {"id": "c1", "nested": {"k": [1, 2]}}
    assert got["e1"].event_timestamp == 1700000000
    assert billing_events(source, LOADED).columns == BILLING_EVENTS.schema.names
    intents = billing_events(source, LOADED, types=INTENT_EVENT_TYPES)
    assert [r.id for r in intents.collect()] == ["e5"]
    assert len(OBJECT_EVENT_TYPES) == 20 and len(INTENT_EVENT_TYPES) == 8 and len(set(EVENT_TYPES)) == 28


def test_streamed_pages_are_loaded_once(spark, tmp_path):
    landing, root, checkpoint = (str(tmp_path / n) for n in ("landing", "root", "checkpoint"))
    spec = billing_object("charges")
    sizes = []

    def load(batch):
        sizes.append(batch.count())
        tables.upsert(spark, root, spec, billing_objects(batch, LOADED))

    def land(*documents):
        spark.createDataFrame([(p,) for p in pages(*documents)], "value string").write.mode("append").text(landing)
        load_new_pages(spark, landing, checkpoint, load).awaitTermination()

    land([{"id": "a", "created": 1700000000, "v": 1}])
    land([{"id": "a", "created": 1700000000, "v": 2}, {"id": "b", "created": 1700000000}])
    load_new_pages(spark, landing, checkpoint, load).awaitTermination()
    assert sizes == [1, 2]
    assert read_pages(spark, landing).count() == 3
    got = {r.id: json.loads(r.data).get("v") for r in tables.read_table(spark, root, spec).collect()}
    assert got == {"a": 2, "b": None}


def test_payment_reports(spark, tmp_path):
    one, two = tmp_path / "one.csv", tmp_path / "two.csv"
    one.write_text('Charge ID,Created At,Some Text\nc1,2024-01-02T03:04:05Z,"line\nbreak, ""q"""\nc2,bad,NA\n', encoding="utf8")
    two.write_text("charge-id,created_at,Extra,transaction_request_id\nc3,2024-01-03,é,t3\n,2024-01-03,null,t4\n", encoding="utf8")
    report = read_report(spark, [str(one), str(two)])
    got = {r.charge_id: r for r in payment_report(report, LOADED).collect()}
    assert set(got) == {"c1", "c2", "c3", None}
    assert got["c1"].created_at == datetime(2024, 1, 2, 3, 4, 5) and got["c2"].created_at is None
    assert json.loads(got["c1"].data) == {"some_text": 'line\nbreak, "q"', "extra": None, "transaction_request_id": None}
    assert json.loads(got["c3"].data)["extra"] == "é" and json.loads(got[None].data)["extra"] is None
    history = payment_report_history(report, LOADED).where("charge_id = 'c3'").first()
    assert history.transaction_request_id == "t3" and "transaction_request_id" not in json.loads(history.data)
    day = DayRange(date(2024, 1, 3), date(2024, 1, 3))
    assert payment_report(report, LOADED, days=day).count() == 2


def test_missing_tokens_and_rest(spark):
    df = spark.createDataFrame([("NA", "None", 1), ("na", "x", 2)], "a string, b string, n int")
    assert [tuple(r) for r in blank_missing(df).collect()] == [(None, None, 1), ("na", "x", 2)]
    kept = keys_and_rest(df, ["a", "absent"]).first()
    assert tuple(kept) == ("NA", None, '{"b":"None","n":1}')
    assert keep_columns(df, ["n", "zzz", "a"]).columns == ["n", "a"]


def test_social_ads(spark):
    base = {f.name: None for f in SOCIAL_ADS_ROWS.fields}
    given = [
        {**base, "date_start": "2024-01-02", "ad_id": "1", "spend": "1.25", "impressions": "7", "inline_link_clicks": "2.9",
         "actions": [{"action_type": "lead", "value": "1"}, {"action_type": "lead", "value": "3"}, {"action_type": None, "value": "9"}]},
        {**base, "date_start": "bad", "ad_id": "2", "spend": "x"},
    ]
    a, b = social_ads_hourly(spark.createDataFrame(given, SOCIAL_ADS_ROWS), LOADED).orderBy("ad_id").collect()
    assert (a.id_date, a.cost, a.impressions, a.inline_link_clicks, a.act_lead, a.act_purchase) == ("20240102", 1.25, 7, 2, 3, 0)
    assert (b.id_date, b.cost, b.impressions, b.act_lead) == (None, 0.0, 0, 0)


def test_search_ads(spark):
    schema = (
        "cost_micros bigint, impressions bigint, clicks bigint, date string, hour int, campaign_id bigint, "
        "campaign_name string, conversions double, all_conversions double"
    )
    df = spark.createDataFrame([(2500000, 1, 2, "2024-01-02", 3, 4, "n", 0.5, 1.5), (0, 1, 2, "2024-01-03", 3, 4, "n", 0.0, 0.0)], schema)
    got = search_ads_hourly(df, LOADED, DayRange(date(2024, 1, 1), date(2024, 1, 2))).collect()
    assert [(r.id_date, r.date, r.hour, r.cost) for r in got] == [("20240102", date(2024, 1, 2), 3, 2.5)]


def test_contacts(spark):
    lines = [
        {"id": "1", "created_at": 1700000000, "updated_at": 1700000000, "Full Name": "a​b", "9x": True, "n": 1.5,
         "tags": {"data": [{"k-1": "v"}], "list": []}, "empty": [], "data": {"Raw Key": 1}},
        {"id": "2", "updated_at": 1700000000, "tags": {"list": ["x﻿"]}},
        {"id": "3", "updated_at": 1600000000},
    ]
    df = spark.read.json(spark.sparkContext.parallelize([json.dumps(x) for x in lines]))
    got = {r.id: r for r in contacts(df, DAY).collect()}
    assert set(got) == {"1", "2"}
    one, two = got["1"], got["2"]
    assert (one.full_name, one._9x, one.n, one.empty, one.created_path) == ("ab", "true", "1.5", None, "2023/11/14")
    assert json.loads(one.data) == {"Raw Key": 1}
    assert json.loads(json.loads(one.tags)["data"]) == [{"k-1": "v"}]
    assert two.created_path == "unknown" and json.loads(two.tags) == {"list": ["x"]} and two.data is None


def test_names_that_become_alike(spark):
    df = spark.createDataFrame([("first", "last", 1)], "`a b` string, `a-b` string, c int")
    assert clean_records(df).first().asDict() == {"a_b": "last", "c": 1}
    nested = df.select(F.struct("`a b`", "c").alias("s"), F.array(F.struct("`a-b`")).alias("l"))
    assert flatten_structs(nested).columns == ["s_a b", "s_c", "l"]
    assert text_columns(clean_records(nested)).first().asDict() == {"s": '{"a_b":"first","c":1}', "l": '[{"a_b":"last"}]'}


def test_formats(spark, tmp_path):
    df = spark.createDataFrame([("a", 1)], "k string, n bigint")
    for ext in ("csv", "json", "parquet", "orc"):
        path = str(tmp_path / f"x.{ext.upper()}")
        df.write.format(ext).option("header", True).save(path)
        row = read_landed(spark, path, None if ext == "csv" else df.schema).select("k", "n").first()
        assert tuple(row) == (("a", "1") if ext == "csv" else ("a", 1))
    for ext in ("dat", "txt"):
        df.select("k").write.text(str(tmp_path / f"x.{ext}"))
        assert read_landed(spark, str(tmp_path / f"x.{ext}")).first().value == "a"
    with pytest.raises(ValueError, match="not allowed"):
        read_landed(spark, "x.exe")
    with pytest.raises(RuntimeError, match="spark-avro"):
        read_landed(spark, str(tmp_path / "x.avro"))


@pytest.mark.parametrize("files_per_batch", [1, 1000])
def test_batching_does_not_decide_which_copy_wins(spark, tmp_path, files_per_batch):
    folder = tmp_path / "pages"
    folder.mkdir()
    for n, status in enumerate(["first", "second", "third"]):
        page = {"page": 1, "data": [{"id": "a", "created": 1700000000, "s": f"{status} {i}"} for i in range(2)]}
        (folder / f"{n}.json").write_text(json.dumps(page) + "\n", encoding="utf8")
        os.utime(folder / f"{n}.json", (1_700_000_000 + n, 1_700_000_000 + n))
    root, spec = str(tmp_path / "root"), billing_object("charges")
    for _ in range(2):
        jobs.follow_billing(spark, root, str(folder), str(tmp_path / "checkpoint"), "charges", LOADED, files_per_batch)
    stored = tables.read_table(spark, root, spec).collect()
    assert [json.loads(r.data)["s"] for r in stored] == ["third 0"]


def test_pages_that_do_not_parse(spark, tmp_path):
    lines = [json.dumps({"page": n, "data": [{"id": str(n)}]}) for n in range(3)]
    texts = [lines[0], lines[1][:-4], lines[2], "", '{"page": 4}', '{"page": 5, "data": []}']
    (tmp_path / "p.json").write_text("\n".join(texts), encoding="utf8")
    with pytest.raises(PySparkException, match="does not parse"):
        read_pages(spark, str(tmp_path)).collect()
    assert [r.page for r in read_pages(spark, str(tmp_path), on_broken="skip").orderBy("page").collect()] == [0, 2]
    assert sorted(r.text for r in broken_pages(spark.read.text(str(tmp_path)), "value").collect()) == sorted([texts[1], texts[4]])
    with pytest.raises(ValueError):
        read_pages(spark, str(tmp_path), on_broken="ignore")


def test_indented_pages(spark, tmp_path):
    (tmp_path / "p.json").write_text(json.dumps({"page": 1, "data": [{"id": "a"}, {"id": "b"}]}, indent=2), encoding="utf8")
    assert read_pages(spark, str(tmp_path), whole_files=True).count() == 2


@pytest.mark.parametrize("multi_line", [True, False])
def test_reports_of_one_folder_are_united_by_name(spark, tmp_path, multi_line):
    for n, text in enumerate(["a,b,c\n1,2,3\n", "b,a,c\n5,4,6\n", "a,c\n7,8\n", "a,b,c\n9,10,11\n"]):
        (tmp_path / f"{n}.csv").write_text(text, encoding="utf8")
    got = {tuple(r[c] for c in "abc") for r in read_report(spark, [str(tmp_path)], multi_line).collect()}
    assert got == {("1", "2", "3"), ("4", "5", "6"), ("7", None, "8"), ("9", "10", "11")}


@pytest.mark.parametrize("block", [40, 300, 10**8])
def test_quoted_line_breaks_are_read_in_blocks(spark, tmp_path, block):
    rng = random.Random(block)
    words = ["plain", "", "a,b", 'q "x" q', "two\nlines", "\n\n", '"', "é", "end\n", '"\n"', "NA"]
    for name in ("one", "two", "empty"):
        with open(tmp_path / f"{name}.csv", "w", encoding="utf8", newline="") as file:
            writer = csv.writer(file, lineterminator="\r\n" if name == "two" else "\n")
            writer.writerow(["Id", "First Text", "Other"] if name == "one" else ["Other", "Id"])
            for i in range(0 if name == "empty" else 200):
                cells = [rng.choice(words) for _ in range(2)]
                writer.writerow([f"{name}{i}", *cells] if name == "one" else [cells[0], f"{name}{i}"])
    expected = set()
    for name in ("one", "two"):
        with open(tmp_path / f"{name}.csv", encoding="utf8", newline="") as file:
            for row in csv.DictReader(file):
                cells = [row["Id"], row.get("First Text"), row["Other"]]
                expected.add(tuple(None if c in ("", "NA") else c for c in cells))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(block))
    try:
        report = read_report(spark, [str(tmp_path)])
        names = [next(c for c in report.columns if c.lower().startswith(n)) for n in ("id", "first", "other")]
        assert {tuple(r) for r in report.select(*names).collect()} == expected
        assert report.count() == 400
        if block == 40:
            assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 20
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
