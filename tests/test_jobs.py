"""The scheduled runs end to end, each repeated to show that nothing changes."""

import json
import os
from datetime import date, datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from funnelwright import jobs, schemas
from funnelwright.plans.ads import social_pages
from funnelwright.plans.contacts import contact_pages
from funnelwright.plans.conversion import campaign_conversion, late_days
from funnelwright.queries import inputs, marts
from funnelwright.queries.registry import Tables
from funnelwright.sinks import tables
from funnelwright.sources.readers import read_pages

AS_OF = date(2024, 1, 31)
LOADED = datetime(2024, 2, 1)


@pytest.fixture
def t(spark):
    return Tables(spark, "/root/testdata/sf0.001")


def content(spark, root, spec):
    return sorted((tuple(r) for r in tables.read_table(spark, root, spec).collect()), key=repr)


def test_marts(spark, t, tmp_path, rows):
    root = str(tmp_path)
    web, forms, raw = inputs.web_events(t), inputs.raw_forms(t), inputs.raw_transactions(t)
    transactions, search, social = marts.transactions(t), inputs.search_stats(t), inputs.social_insights(t)

    last = inputs.EVENT_DAYS.last
    back = (last - inputs.EVENT_DAYS.first).days

    def run():
        jobs.refresh_funnel(spark, root, web, last, back, 0, marts.SITE)
        jobs.refresh_campaigns(spark, root, web, forms, raw, last, back, 0, marts.SITE)
        jobs.load_precheckouts(spark, root, forms, last, back, 0)
        jobs.refresh_conversion(spark, root, transactions, search, social, last, back, 0, inputs.RULES)

    run()
    specs = [schemas.HISTORICAL_FUNNEL, schemas.DIM_UTM, schemas.PRECHECKOUT]
    first = [content(spark, root, s) for s in specs]
    assert all(first)
    mart = content(spark, root, schemas.CAMPAIGN_CONVERSION)
    expected = campaign_conversion(
        marts.funnel(t), marts.forms(t), transactions, marts.dimension(t), search, social, inputs.EVENT_DAYS, inputs.RULES,
        late_days(social, inputs.EVENT_DAYS),
    )
    assert [r[:5] for r in mart] == [tuple(r)[:5] for r in rows(expected)]

    # also the events without a session, which have no event id, are stored once
    assert any(r[0] is None for r in first[0])
    for _ in range(2):
        run()
        assert [content(spark, root, s) for s in specs] == first
        assert [r[:5] for r in content(spark, root, schemas.CAMPAIGN_CONVERSION)] == [r[:5] for r in mart]

    jobs.refresh_funnel(spark, root, web, last, back, 0, marts.SITE, rebuild=True)
    assert content(spark, root, schemas.HISTORICAL_FUNNEL) == first[0]


def test_late_loaded_ads_are_counted_once(spark, t, tmp_path):
    root = str(tmp_path)
    ad = ("c", "n", "s", "n", "a", "n", 10, 1, 5.0)
    social = spark.createDataFrame(
        [(date(2024, 1, 9), date(2024, 1, 2), *ad), (date(2024, 1, 9), date(2024, 1, 8), *ad)],
        "_load_date date, datestart date, CampaignId string, CampaignName string, AdSetId string, AdSetName string, "
        "AdId string, AdName string, Impressions long, LinkClicks long, Spend double",
    )
    transactions, search = marts.transactions(t).limit(0), inputs.search_stats(t).limit(0)
    day3 = spark.createDataFrame([(date(2024, 1, 3), date(2024, 1, 3), *ad), (date(2024, 1, 3), date(2024, 1, 2), *ad[:2], "other", *ad[3:])], social.schema)
    jobs.refresh_conversion(spark, root, transactions, search, day3, date(2024, 1, 4), rules=inputs.RULES)
    written = [f"{root}/campaign_conversion/id_date=2024010{d}" for d in (2, 3)]
    untouched = os.stat(written[1]).st_mtime_ns
    social = social.unionByName(day3)
    for _ in range(3):
        jobs.refresh_conversion(spark, root, transactions, search, social, date(2024, 1, 10), rules=inputs.RULES)
        stored = tables.read_table(spark, root, schemas.CAMPAIGN_CONVERSION).collect()
        # the ad that came late is added to its day, beside the one that was there
        assert sorted((r.id_date, r.cost) for r in stored) == [("20240102", 10.0), ("20240103", 5.0), ("20240108", 5.0)]
        assert os.stat(written[1]).st_mtime_ns == untouched


def test_billing(spark, tmp_path):
    root, pages = str(tmp_path / "root"), str(tmp_path / "pages")
    stamp = int(datetime(2024, 1, 31, 12).timestamp())
    data = [{"id": "a", "created": stamp, "type": "charge.updated", "data": {"object": {"id": "c"}}}]
    line = json.dumps({"page": 1, "data": data})
    spark.createDataFrame([(line,)], "value string").write.text(pages)
    for _ in range(2):
        audit = jobs.load_billing(spark, root, pages, "charges", AS_OF, LOADED)
        jobs.load_billing_events(spark, root, pages, AS_OF, LOADED)
        assert [tuple(r)[1:] for r in audit] == [(1, 0, 0, 0, 1)]
    assert [r[0] for r in content(spark, root, schemas.billing_object("charges"))] == ["a"]
    assert [r[:3] for r in content(spark, root, schemas.BILLING_EVENTS)] == [("a", stamp, "c")]
    with pytest.raises(ValueError, match="unknown billing entity"):
        jobs.load_billing(spark, root, pages, "refunds", AS_OF, LOADED)


def test_pages_are_read_once_and_rejects_are_kept(spark, tmp_path, monkeypatch):
    root, pages = str(tmp_path / "root"), str(tmp_path / "pages")
    stamp = int(datetime(2024, 1, 31, 12).timestamp())
    data = [{"id": "a", "created": stamp}, {"created": stamp}, {"id": "late"}, {"id": "a", "created": stamp}]
    lines = [json.dumps({"page": 1, "data": data}), "{broken"]
    spark.createDataFrame([(line,) for line in lines], "value string").write.text(pages)
    sources = []
    for name in ("objects_of_heads", "rejected_objects", "audit_of_heads"):
        plain = getattr(jobs, name)
        monkeypatch.setattr(jobs, name, lambda heads, *rest, plain=plain: sources.append(heads.inputFiles()) or plain(heads, *rest))
    for _ in range(2):
        audit = jobs.load_billing(spark, root, pages, "charges", AS_OF, LOADED, on_broken="skip")
        assert [tuple(r)[1:] for r in audit] == [(3, 1, 1, 0, 1)]
    assert len(sources) == 6 and all(files and not any("pages" in f for f in files) for files in sources)
    rejected = tables.read_table(spark, root, schemas.REJECTED_OBJECTS).collect()
    assert sorted((r.reason, r.data) for r in rejected) == [
        ("no creation time", '{"id":"late"}'), ("no id", f'{{"created":{stamp}}}'), ("page does not parse", "{broken"),
    ]
    with pytest.raises(PySparkException):
        jobs.load_billing(spark, root, pages, "charges", AS_OF, LOADED)


def test_changed_objects_stored_for_later(spark, tmp_path):
    root, pages = str(tmp_path / "root"), str(tmp_path / "pages")
    stamp = int(datetime(2024, 1, 31, 12).timestamp())
    for version in (1, 2):
        line = json.dumps({"page": 1, "data": [{"id": "a", "created": stamp, "v": version}]})
        spark.createDataFrame([(line,)], "value string").write.mode("overwrite").text(pages)
        jobs.load_billing(spark, root, pages, "charges", AS_OF, LOADED, later=True)
    for _ in range(2):
        (row,) = tables.read_table(spark, root, schemas.billing_object("charges")).collect()
        assert json.loads(row.data)["v"] == 2
        jobs.compact_billing(spark, root, "charges")


def test_reports(spark, tmp_path):
    report = tmp_path / "r.csv"
    report.write_text("Charge Id,Transaction Request Id,created_at,x\nc,t,2024-01-31,1\n", encoding="utf8")
    root = str(tmp_path / "root")
    for _ in range(2):
        jobs.load_payment_report(spark, root, [str(report)], LOADED)
        jobs.load_payment_report(spark, root, [str(report)], LOADED, history=True)
    assert [r[0] for r in content(spark, root, schemas.PAYMENT_REPORT)] == ["c"]
    assert [r[:2] for r in content(spark, root, schemas.PAYMENT_REPORT_HISTORY)] == [("t", "c")]


def test_ads(spark, tmp_path):
    root = str(tmp_path)
    search = spark.createDataFrame(
        [("2024-01-31", 1, 5, "name", 10, 1, 2000000, 0.0, 0.0)],
        "date string, hour int, campaign_id bigint, campaign_name string, impressions bigint, clicks bigint, "
        "cost_micros bigint, conversions double, all_conversions double",
    )
    jobs.load_search_ads(spark, root, search, AS_OF, LOADED)
    renamed = search.withColumn("campaign_name", F.lit("renamed")).withColumn("clicks", F.lit(9).cast("bigint"))
    jobs.load_search_ads(spark, root, renamed, AS_OF, LOADED)
    row = tables.read_table(spark, root, schemas.SEARCH_ADS_HOURLY).first()
    assert (row.campaign_name, row.clicks, row.cost) == ("name", 9, 2.0)

    nothing = {f.name: "v" for f in schemas.SOCIAL_ADS_ROWS.fields} | {"actions": None, "date_start": "2024-01-31"}
    social = spark.createDataFrame([nothing], schemas.SOCIAL_ADS_ROWS)
    for _ in range(2):
        jobs.load_social_ads(spark, root, social, LOADED)
    assert tables.read_table(spark, root, schemas.SOCIAL_ADS_HOURLY).count() == 1
    jobs.load_social_ads(spark, root, social.union(social), LOADED, on_duplicate="latest")
    assert tables.read_table(spark, root, schemas.SOCIAL_ADS_HOURLY).count() == 1


def test_search_ads_of_a_named_range(spark, tmp_path):
    feed = spark.createDataFrame(
        [(f"2024-01-{d:02}", 1, 5, "name", 10, 1, 2000000, 0.0, 0.0) for d in range(1, 32)],
        "date string, hour int, campaign_id bigint, campaign_name string, impressions bigint, clicks bigint, "
        "cost_micros bigint, conversions double, all_conversions double",
    )
    jobs.load_search_ads(spark, str(tmp_path), feed, AS_OF, LOADED, date_range="LAST_WEEK_MON_SUN")
    stored = tables.read_table(spark, str(tmp_path), schemas.SEARCH_ADS_HOURLY).collect()
    assert sorted(r.id_date for r in stored) == [f"202401{d}" for d in range(22, 29)]


def test_ads_and_contacts_from_landed_pages(spark, tmp_path):
    root, ads, people = str(tmp_path / "root"), tmp_path / "ads", tmp_path / "people"
    ids = {c: "v" for c in ("account_id", "campaign_id", "adset_id", "ad_id", "hourly_stats_aggregated_by_advertiser_time_zone")}
    ad = {"date_start": "2024-01-31", **ids, "spend": "1.5", "actions": [{"action_type": "lead", "value": "2"}]}
    person = {"id": "1", "created_at": 1706700000, "updated_at": 1706700000, "custom": {"a b": "x"}}
    for folder, data in ((ads, [ad]), (people, [person, person | {"id": "2", "extra": 1}])):
        folder.mkdir()
        (folder / "p.json").write_text(json.dumps({"page": 1, "data": data}, indent=1), encoding="utf8")
    for _ in range(2):
        jobs.load_social_ads(spark, root, social_pages(read_pages(spark, str(ads), whole_files=True)), LOADED)
        jobs.load_contacts(spark, root, contact_pages(read_pages(spark, str(people), whole_files=True)), AS_OF)
    row = tables.read_table(spark, root, schemas.SOCIAL_ADS_HOURLY).collect()
    assert [(r.id_date, r.cost, r.act_lead) for r in row] == [("20240131", 1.5, 2)]
    stored = spark.read.option("mergeSchema", True).parquet(f"{root}/contacts").collect()
    assert sorted((r.id, r.custom, r.extra) for r in stored) == [("1", '{"a_b":"x"}', None), ("2", '{"a_b":"x"}', "1")]


def test_contacts(spark, tmp_path):
    records = spark.createDataFrame([("1", 1706700000, 1706700000, "x")], "id string, created_at long, updated_at long, `a b` string")
    for _ in range(2):
        jobs.load_contacts(spark, str(tmp_path), records, AS_OF)
    row = spark.read.parquet(f"{tmp_path}/contacts").collect()
    assert [(r.id, r.a_b, r.created_path) for r in row] == [("1", "x", "2024/01/31")]
