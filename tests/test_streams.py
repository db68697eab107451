"""Streamed loads: first-seen events, repeated files, runs that die, ads, contacts and reports as they land."""

import json
import os
from datetime import datetime

import pytest
from pyspark.errors import PySparkException

from funnelwright import jobs, schemas
from funnelwright.plans.billing import billing_events
from funnelwright.sinks import tables
from funnelwright.sources.readers import read_pages

LOADED = datetime(2024, 2, 1)
STAMP = 1700000000


def event(number, **more):
    return {"id": f"e{number}", "type": "invoice.paid", "created": STAMP + number, "data": {"object": {"id": f"o{number}"}}} | more


def land(folder, name, data, at=0):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(json.dumps({"page": 1, "data": data}) + "\n", encoding="utf8")
    os.utime(folder / name, (STAMP + at, STAMP + at))


def files(folder):
    """Every data file of a table with its time; the key filters beside them are made when needed."""
    found = (os.path.join(d, n) for d, _, names in os.walk(folder) for n in names if n.endswith(".parquet") and "/_keys" not in d)
    return sorted((path, os.stat(path).st_mtime_ns) for path in found)


def stored_events(spark, root):
    return sorted(r.id for r in tables.read_table(spark, root, schemas.BILLING_EVENTS).collect())


@pytest.mark.parametrize("remember", [None, "30 days"])
@pytest.mark.parametrize("files_per_batch", [1, 1000])
def test_events_are_stored_when_first_seen(spark, tmp_path, files_per_batch, remember):
    root, pages, checkpoint = str(tmp_path / "root"), tmp_path / "pages", str(tmp_path / "checkpoint")

    def run():
        jobs.follow_billing_events(spark, root, str(pages), checkpoint, LOADED, files_per_batch, remember=remember)

    odd = [event(7, id=None), event(8, id=""), event(9, created=0), event(10, type="other"), event(11, data={"object": {}})]
    land(pages, "a.json", [event(1), event(2), event(1), *odd])
    land(pages, "b.json", [event(2), event(3)], 1)
    run()
    assert stored_events(spark, root) == ["e1", "e2", "e3"]
    full = billing_events(read_pages(spark, str(pages)), LOADED)
    assert sorted(map(tuple, full.collect())) == sorted(map(tuple, tables.read_table(spark, root, schemas.BILLING_EVENTS).collect()))
    before = files(root)
    land(pages, "again.json", [event(1), event(2), event(3)], 2)
    run()
    run()
    assert files(root) == before and before
    land(pages, "c.json", [event(3), event(4)], 3)
    run()
    assert stored_events(spark, root) == ["e1", "e2", "e3", "e4"]


@pytest.mark.parametrize("when", ["before", "after"])
def test_a_run_that_died_is_made_up_for(spark, tmp_path, monkeypatch, when):
    root, pages, checkpoint = str(tmp_path / "root"), tmp_path / "pages", str(tmp_path / "checkpoint")
    land(pages, "a.json", [event(1), event(2)])
    jobs.follow_billing_events(spark, root, str(pages), checkpoint, LOADED)
    land(pages, "b.json", [event(2), event(3)], 1)
    plain = tables.append_new

    def dying(*given, **named):
        if when == "after":
            plain(*given, **named)
        raise RuntimeError("killed")

    monkeypatch.setattr(tables, "append_new", dying)
    with pytest.raises(PySparkException, match="killed"):
        jobs.follow_billing_events(spark, root, str(pages), checkpoint, LOADED)
    monkeypatch.setattr(tables, "append_new", plain)
    before = files(root)
    for _ in range(2):
        jobs.follow_billing_events(spark, root, str(pages), checkpoint, LOADED)
        assert stored_events(spark, root) == ["e1", "e2", "e3"]
    if when == "after":
        assert files(root) == before


def test_a_lost_checkpoint_repeats_nothing(spark, tmp_path):
    root, pages = str(tmp_path / "root"), tmp_path / "pages"
    land(pages, "a.json", [event(1), event(2)])
    jobs.follow_billing_events(spark, root, str(pages), str(tmp_path / "first"), LOADED)
    before = files(root)
    jobs.follow_billing_events(spark, root, str(pages), str(tmp_path / "second"), LOADED)
    assert files(root) == before and stored_events(spark, root) == ["e1", "e2"]


@pytest.mark.parametrize("files_per_batch", [1, 1000])
def test_social_ads_as_they_land(spark, tmp_path, files_per_batch):
    root, pages, checkpoint = str(tmp_path / "root"), tmp_path / "pages", str(tmp_path / "checkpoint")
    ids = {c: "v" for c in ("account_id", "campaign_id", "adset_id", "ad_id", "hourly_stats_aggregated_by_advertiser_time_zone")}
    for n, cost in enumerate(["1.5", "2.5"]):
        land(pages, f"{n}.json", [{"date_start": "2024-01-31", **ids, "spend": cost}, {"date_start": "2024-01-30", **ids, "spend": cost}], n)
    for _ in range(2):
        jobs.follow_social_ads(spark, root, str(pages), checkpoint, LOADED, files_per_batch)
    rows = tables.read_table(spark, root, schemas.SOCIAL_ADS_HOURLY).collect()
    assert sorted((r.id_date, r.cost) for r in rows) == [("20240130", 2.5), ("20240131", 2.5)]


def test_contacts_as_they_land(spark, tmp_path):
    root, pages, checkpoint = str(tmp_path / "root"), tmp_path / "pages", str(tmp_path / "checkpoint")
    land(pages, "a.json", [{"id": "1", "created_at": STAMP, "updated_at": STAMP, "name": "old"}])
    land(pages, "none.json", [], 1)
    jobs.follow_contacts(spark, root, str(pages), checkpoint)
    land(pages, "b.json", [{"id": "1", "created_at": STAMP, "updated_at": STAMP + 1, "name": "new", "tags": ["x"]}], 2)
    for _ in range(2):
        jobs.follow_contacts(spark, root, str(pages), checkpoint)
    (row,) = spark.read.option("mergeSchema", True).parquet(f"{root}/contacts").collect()
    assert (row.id, row["name"], row.tags) == ("1", "new", '["x"]')


def test_reports_as_they_land(spark, tmp_path):
    root, folder, checkpoint = str(tmp_path / "root"), tmp_path / "reports", str(tmp_path / "checkpoint")
    folder.mkdir()
    (folder / "a.csv").write_text('charge_id,created_at,x\nc1,2024-01-30,"1\n2"\n', encoding="utf8")
    jobs.follow_payment_reports(spark, root, str(folder), checkpoint, LOADED)
    (folder / "b.csv").write_text("charge_id,created_at,y\nc1,2024-01-31,5\nc2,2024-01-31,6\n", encoding="utf8")
    for _ in range(2):
        jobs.follow_payment_reports(spark, root, str(folder), checkpoint, LOADED)
    rows = tables.read_table(spark, root, schemas.PAYMENT_REPORT).collect()
    assert sorted((r[0], json.loads(r.data)) for r in rows) == [("c1", {"y": "5"}), ("c2", {"y": "6"})]
