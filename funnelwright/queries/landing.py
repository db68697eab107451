"""Landed feeds: billing pages, payment reports, hourly ads, contacts, file formats."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.records import action_map
from ..functions.times import DayRange, named_range
from ..operators.dedupe import first_seen
from ..operators.reshape import flatten_structs, keep_columns, rename_columns, union_all
from ..plans.ads import ACTIONS, HOUR_FIELD, report_order, search_ads_hourly, social_ads_hourly
from ..plans.billing import billing_audit, billing_events, billing_objects
from ..plans.contacts import contact_objects, contacts
from ..plans.reports import payment_report, payment_report_history
from ..session import scratch_path
from ..sinks.objects import read_objects, write_objects
from ..sources.readers import broken_pages, page_objects, read_landed, read_pages, read_report
from .inputs import EVENT_DAYS, IN_EVENT_DAYS, IN_ORDER_DAYS, LOAD_TIME, ORDER_DAYS
from .registry import Tables, query

# Orders as billing objects. Urgent ones are landed twice, the second time with another
# status; some have no id or no creation time.
BILLS = """
SELECT o_orderkey, CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' OR o_orderstatus <> 'P' THEN 'ch_' || CAST(o_orderkey AS STRING)
    ELSE '' END AS id, o_orderdate, CASE WHEN o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'F' THEN 0 ELSE 1 END AS dated,
  o_orderstatus AS status, CAST(o_custkey AS STRING) || ' é' AS note, o_custkey AS customer, 0 AS copy FROM {orders}
UNION ALL
SELECT o_orderkey, 'ch_' || CAST(o_orderkey AS STRING), o_orderdate, 1, 'again', 'copy', o_custkey, 1 FROM {orders}
WHERE o_orderpriority = '1-URGENT'
"""
BILLS_SQL = f"bills AS ({BILLS.format(orders='orders')})"


def billing_pages(t: Tables) -> DataFrame:
    """Pages of up to 100 objects as landed JSON text; second copies are on later pages."""
    bills = t.spark.sql(BILLS, orders=t.orders)
    created = F.unix_timestamp(F.col("o_orderdate").cast("timestamp")) * F.col("dated")
    body = F.struct("id", created.alias("created"), "status", "note", F.struct("customer").alias("links"))
    landed = bills.select(
        (F.floor(F.col("o_orderkey") / 100) + F.col("copy") * 1_000_000_000).alias("page"),
        F.struct((F.col("o_orderkey") % 100).alias("pos"), body.alias("body")).alias("entry"),
    )
    # the page size bounds the list
    pages = landed.groupBy("page").agg(F.array_sort(F.collect_list("entry")).alias("entries"))
    document = F.struct("page", F.transform("entries", lambda e: e["body"]).alias("data"))
    return pages.select(F.to_json(document).alias("value"))


def billing_source(t: Tables) -> DataFrame:
    return page_objects(billing_pages(t), "value")


@query(
    f"""WITH {BILLS_SQL} SELECT id, strftime(o_orderdate, '%Y-%m-%d') AS created_at, status, note,
    CAST(customer AS VARCHAR) AS customer, '2024-02-01 06:00:00' AS etl_load_date
    FROM bills WHERE id <> '' AND copy = 0 AND dated = 1 AND {IN_ORDER_DAYS.format('o_orderdate')}"""
)
def raw_envelope(t: Tables) -> DataFrame:
    """Billing pages to one envelope per id, its JSON read back."""
    rows = billing_objects(billing_source(t), LOAD_TIME, ORDER_DAYS)
    fields = F.from_json("data", "status string, note string, links struct<customer: string>")
    return rows.withColumn("f", fields).select(
        "id",
        F.col("created_at").cast("string"),
        "f.status",
        "f.note",
        "f.links.customer",
        F.col("etl_load_date").cast("string"),
    )


@query(
    f"""WITH {BILLS_SQL} SELECT id, strftime(o_orderdate, '%Y-%m-%d') AS created_at, status
    FROM bills WHERE id <> '' AND copy = 0 AND dated = 1 AND o_orderkey // 100 % 7 <> 3
    UNION ALL SELECT CAST(o_orderkey // 100 AS VARCHAR), NULL, 'broken' FROM orders
    WHERE o_orderkey // 100 % 7 = 3 GROUP BY 1"""
)
def landed_pages(t: Tables) -> DataFrame:
    """Landed page files of which some lines are cut off: their objects, and the broken pages."""
    pages = billing_pages(t).withColumn("number", F.get_json_object("value", "$.page").cast("long") % 1_000_000_000)
    cut = F.when(F.col("number") % 7 == 3, F.expr("left(value, length(value) - 3)")).otherwise(F.col("value"))
    path = scratch_path(t.spark, "pages")
    pages.select(cut.alias("value")).write.text(path)
    good = billing_objects(read_pages(t.spark, path, on_broken="skip").drop("fetch"), LOAD_TIME)
    bad = broken_pages(t.spark.read.text(path), "value").select(F.regexp_extract("text", r'"page":(\d+)', 1).alias("page"))
    number = (F.col("page").cast("long") % 1_000_000_000).cast("string")
    listed = bad.select(number.alias("id"), F.lit(None).cast("string").alias("created_at"), F.lit("broken").alias("status"))
    status = F.get_json_object("data", "$.status").alias("status")
    return good.select("id", F.col("created_at").cast("string"), status).unionByName(listed.distinct())


EVENT_TYPE = """CASE event_type WHEN 'view' THEN 'invoice.paid' WHEN 'click' THEN 'charge.updated'
    WHEN 'signup' THEN 'payment_intent.created' WHEN 'error' THEN 'radar.warning' ELSE 'customer.created' END"""


@query(
    f"""SELECT 'evt_' || event_id AS id, CAST(floor(epoch(ts)) AS BIGINT) AS event_timestamp, 'obj_' || user_id AS object_id,
    strftime(ts, '%Y-%m-%d') AS created_at, {EVENT_TYPE} AS type, value FROM events
    WHERE event_type <> 'error' AND user_id >= 20 AND {IN_EVENT_DAYS.format('ts')}"""
)
def event_envelope(t: Tables) -> DataFrame:
    """Billing events of the listed types whose inner object has an id; every event landed twice."""
    created = F.unix_timestamp(F.col("ts").cast("timestamp"))
    inner = F.struct(
        F.when(F.col("user_id") >= 20, F.concat(F.lit("obj_"), F.col("user_id"))).alias("id"),
        "value",
        F.expr(EVENT_TYPE).alias("kind"),
    )
    body = F.struct(
        F.concat(F.lit("evt_"), F.col("event_id")).alias("id"),
        F.expr(EVENT_TYPE).alias("type"),
        created.alias("created"),
        F.struct(inner.alias("object")).alias("data"),
    )
    once = t.events.select(
        F.floor(F.col("event_id") / 100).alias("page"), (F.col("event_id") % 100).alias("pos"), F.to_json(body).alias("raw")
    )
    twice = once.unionByName(once.withColumn("page", F.col("page") + 1_000_000_000))
    rows = billing_events(twice, LOAD_TIME, EVENT_DAYS)
    fields = F.from_json("data", "value double, kind string")
    return rows.withColumn("f", fields).select(
        "id", "event_timestamp", "object_id", F.col("created_at").cast("string"), F.col("f.kind").alias("type"), "f.value"
    )


@query(
    """WITH c AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, row_number() OVER (
      PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice) AS r FROM lineitem)
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM c WHERE r = 1"""
)
def first_seen_dedupe(t: Tables) -> DataFrame:
    keys = ["l_orderkey", "l_linenumber"]
    rows = t.lineitem.select(*keys, "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice")
    order = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"]
    return first_seen(rows, keys, order).drop("l_shipdate", "l_extendedprice")


@query(
    f"""WITH {BILLS_SQL}, b AS (SELECT CASE WHEN dated = 1 THEN strftime(o_orderdate, '%Y-%m-%d') END AS created_at,
      nullif(id, '') AS id, count(*) AS n, min(dated) AS ok FROM bills GROUP BY ALL)
    SELECT created_at, CAST(sum(n) AS BIGINT) AS fetched,
      CAST(sum(CASE WHEN id IS NULL THEN n ELSE 0 END) AS BIGINT) AS without_key,
      CAST(sum(CASE WHEN id IS NOT NULL THEN n - 1 ELSE 0 END) AS BIGINT) AS duplicates,
      CAST(sum(CASE WHEN id IS NOT NULL AND ok = 0 THEN 1 ELSE 0 END) AS BIGINT) AS rejected,
      CAST(sum(CASE WHEN id IS NOT NULL AND ok = 1 THEN 1 ELSE 0 END) AS BIGINT) AS loaded
    FROM b GROUP BY created_at"""
)
def load_audit(t: Tables) -> DataFrame:
    audit = billing_audit(billing_source(t))
    return audit.withColumn("created_at", F.col("created_at").cast("string"))


@query(
    """SELECT CAST(c_custkey AS VARCHAR) AS charge_id,
      CASE WHEN c_nationkey > 0 THEN strftime(TIMESTAMP '2024-01-01' + to_days(c_nationkey), '%Y-%m-%d') END AS created_at,
      c_name AS customer_name, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS market_segment_,
      CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS balance FROM customer"""
)
def csv_rest_json(t: Tables) -> DataFrame:
    """Customers as two CSV reports with unlike headers in one folder, read back as text, keys plus JSON."""
    day = F.date_add(F.to_date(F.lit("2024-01-01")), F.col("c_nationkey"))
    report = t.customer.select(
        F.col("c_custkey").alias(" Charge ID"),
        F.when(F.col("c_nationkey") > 0, F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .otherwise("not a date")
        .alias("Created-At"),
        F.col("c_name").alias("Customer Name"),
        F.when(F.col("c_mktsegment") == "BUILDING", "NA").otherwise(F.col("c_mktsegment")).alias("Market Segment!"),
        "c_acctbal",
    )
    paid = report.where("c_acctbal >= 0").withColumnRenamed("c_acctbal", "Balance")
    owing = report.where("c_acctbal < 0").drop("c_acctbal")
    path = scratch_path(t.spark, "report")
    for part in (paid, owing.select(*reversed(owing.columns))):
        part.write.mode("append").option("header", True).csv(path)
    rows = payment_report(read_report(t.spark, [path]), LOAD_TIME)
    rest = F.from_json("data", "customer_name string, market_segment_ string, balance string")
    return rows.withColumn("f", rest).select(
        "charge_id",
        F.date_format("created_at", "yyyy-MM-dd").alias("created_at"),
        "f.customer_name",
        "f.market_segment_",
        F.col("f.balance").cast("double").alias("balance"),
    )


@query(
    f"""SELECT 'r' || o_orderkey AS transaction_request_id, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_custkey AS VARCHAR) END
      AS charge_id, strftime(o_orderdate, '%Y-%m-%d') AS created_at, o_orderpriority AS "order"
    FROM orders WHERE {IN_ORDER_DAYS.format('o_orderdate')}"""
)
def payment_history(t: Tables) -> DataFrame:
    """Orders as the history report, with its own key, cut to days by the creation time."""
    report = t.orders.select(
        F.concat(F.lit("r"), F.col("o_orderkey")).alias("Transaction Request ID"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("Charge Id"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("Created At"),
        F.col("o_orderpriority").alias("Order"),
    )
    path = scratch_path(t.spark, "history")
    report.write.option("header", True).csv(path)
    rows = payment_report_history(read_report(t.spark, [path], multi_line=False), LOAD_TIME, ORDER_DAYS)
    return rows.select(
        "transaction_request_id",
        "charge_id",
        F.date_format("created_at", "yyyy-MM-dd").alias("created_at"),
        F.get_json_object("data", "$.order").alias("order"),
    )


AD_ROWS = """
SELECT user_id, event_id, ts, event_type, value, CAST(replace(substr(props, 7), '}', '') AS BIGINT) AS k FROM events
"""


@query(
    f"""WITH r AS ({AD_ROWS})
    SELECT strftime(ts, '%Y%m%d') AS id_date, strftime(ts, '%H') AS hour, 'ad' || event_id AS ad_id,
      CASE WHEN k % 9 = 0 THEN 0 ELSE value END AS cost, k AS impressions,
      CASE WHEN k % 4 = 0 THEN 0 ELSE CAST(trunc(value) AS BIGINT) END AS inline_link_clicks,
      CASE WHEN k % 5 = 0 THEN 0 WHEN k % 5 = 1 THEN 7 ELSE -1 END AS act_link_click,
      CASE WHEN k % 5 = 0 THEN 0 ELSE CAST(trunc(value) AS BIGINT) END AS act_purchase,
      0 AS act_lead, 0 AS act_omni_purchase, 0 AS act_add_to_cart, 0 AS act_add_payment_info,
      CASE WHEN k % 5 = 0 THEN 0 ELSE k END AS act_omni_add_to_cart, 'name' AS account_name, 'id' || k AS account_id FROM r"""
)
def actions_pivot(t: Tables) -> DataFrame:
    """Insights rows as text with a nested account, their repeated actions pivoted to columns."""
    k = F.regexp_extract("impressions", r"(\d+)", 1)
    account = F.struct(F.lit("name").alias("name"), F.concat(F.lit("id"), k).alias("id"))
    nested = insights_rows(t).drop("account_name", "account_id").withColumn("account", account)
    hourly = social_ads_hourly(nested, LOAD_TIME)
    wanted = ["id_date", "hour", "ad_id", "cost", "impressions", "inline_link_clicks", "account_name", "account_id"]
    return keep_columns(hourly, [*wanted, *(f"act_{a}" for a in ACTIONS), "no_such_column"])


@query(
    f"""WITH r AS ({AD_ROWS}), a AS (
      SELECT 'ad' || event_id AS ad_id, unnest(['link_click', 'purchase', 'lead', 'video_view', 'omni_add_to_cart']) AS action_type,
        unnest([CASE WHEN k % 5 = 1 THEN 7 ELSE -1 END, CAST(trunc(value) AS BIGINT), 0, 3, k]) AS n FROM r WHERE k % 5 <> 0)
    SELECT ad_id, action_type, n FROM a"""
)
def actions_map(t: Tables) -> DataFrame:
    """All actions of a record as a map, one row per entry."""
    return insights_rows(t).select("ad_id", F.explode(action_map("actions")).alias("action_type", "n"))


def insights_rows(t: Tables) -> DataFrame:
    """Events as insights rows, all text; a fifth of them without actions."""
    k = F.expr("CAST(replace(substr(props, 7), '}', '') AS BIGINT)")
    base = t.events.withColumn("k", k)

    def action(kind: str, value):
        return F.struct(F.lit(kind).alias("action_type"), value.cast("string").alias("value"))

    nothing = F.lit(None).cast("string")
    listed = F.array(
        action("link_click", F.lit("1.9")),
        action("purchase", F.col("value")),
        F.struct(nothing.alias("action_type"), F.lit("5").alias("value")),
        action("lead", F.lit("x")),
        action("video_view", F.lit("3")),
        action("omni_add_to_cart", F.col("k")),
        action("link_click", F.when(F.col("k") % 5 == 1, "7").otherwise("-1.9")),
    )
    return base.select(
        F.date_format("ts", "yyyy-MM-dd").alias("date_start"),
        *(F.lit(c).alias(c) for c in ("account_name", "account_id", "campaign_name", "campaign_id", "adset_name")),
        F.lit("adset").alias("adset_id"),
        F.lit("name").alias("ad_name"),
        F.concat(F.lit("ad"), F.col("event_id")).alias("ad_id"),
        F.when(F.col("k") % 9 == 0, "n/a").otherwise(F.col("value").cast("string")).alias("spend"),
        F.col("k").cast("string").alias("impressions"),
        F.when(F.col("k") % 4 != 0, F.col("value").cast("string")).alias("inline_link_clicks"),
        F.date_format("ts", "HH").alias(HOUR_FIELD),
        F.when(F.col("k") % 5 != 0, listed).alias("actions"),
    )


HOURS_SQL = """SELECT strftime(l_shipdate, '%Y%m%d') AS id_date, strftime(l_shipdate, '%Y-%m-%d') AS date,
      CAST(l_linenumber AS BIGINT) AS hour, l_suppkey AS campaign_id, 'c' || l_suppkey AS campaign_name,
      CAST(sum(l_quantity) AS BIGINT) AS impressions, count(*) AS clicks,
      round(sum(CAST(floor(l_extendedprice) AS BIGINT)) / 1000000.0, 6) AS cost,
      round(sum(l_tax), 4) AS conversions, round(sum(l_discount), 4) AS all_conversions
    FROM lineitem WHERE {days} GROUP BY ALL"""


@query(HOURS_SQL.format(days=IN_ORDER_DAYS.format("l_shipdate")))
def hourly_ads(t: Tables) -> DataFrame:
    return _hours(t, ORDER_DAYS)


@query(HOURS_SQL.format(days="l_shipdate >= TIMESTAMP '1998-05-04' AND l_shipdate < TIMESTAMP '1998-05-11'"))
def hourly_ads_last_week(t: Tables) -> DataFrame:
    """The days of a named report range."""
    return _hours(t, named_range("LAST_WEEK_MON_SUN", date(1998, 5, 13)))


def _hours(t: Tables, days: DayRange) -> DataFrame:
    feed = t.lineitem.groupBy(
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("date"),
        F.col("l_linenumber").alias("hour"),
        F.col("l_suppkey").alias("campaign_id"),
    ).agg(
        F.concat(F.lit("c"), F.first("l_suppkey").cast("string")).alias("campaign_name"),
        F.sum("l_quantity").cast("bigint").alias("impressions"),
        F.count(F.lit(1)).alias("clicks"),
        F.sum(F.floor("l_extendedprice")).alias("cost_micros"),
        F.sum("l_tax").alias("conversions"),
        F.sum("l_discount").alias("all_conversions"),
    )
    rows = search_ads_hourly(feed, LOAD_TIME, days).drop("etl_load_date")
    rounded = {c: F.round(c, 4) for c in ("conversions", "all_conversions")}
    return report_order(rows).withColumns(rounded | {"cost": F.round("cost", 6), "date": F.col("date").cast("string")})


def _contact_records(t: Tables) -> DataFrame:
    """Customers as nested contact records with awkward names and invisible characters."""
    day = F.date_add(F.to_date(F.lit("2024-01-01")), F.col("c_nationkey"))
    created = F.unix_timestamp(day.cast("timestamp"))
    zero_width = "​"
    return t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.concat(F.lit("c"), F.col("c_custkey")).alias("id"),
        F.when(F.col("c_nationkey") > 3, created).alias("created_at"),
        (created + 36_000).alias("updated_at"),
        F.concat(F.lit(zero_width), F.col("c_name")).alias("Full Name"),
        (F.col("c_acctbal") > 0).alias("9 Lives-x!"),
        F.struct(
            F.col("c_mktsegment").alias("Market-Segment"),
            F.struct(F.concat(F.col("n_name"), F.lit("﻿")).alias("home nation")).alias("geo"),
            F.struct(F.col("c_nationkey").alias("Kept Name")).alias("data"),
        ).alias("custom attributes"),
        F.when(F.col("c_nationkey") >= 5, F.array(F.lit("a"), F.lit("b"))).otherwise(F.array().cast("array<string>")).alias("turns"),
    )


@query(
    """SELECT 'c' || c_custkey AS id, CASE WHEN c_nationkey > 3 THEN strftime(TIMESTAMP '2024-01-01' + to_days(c_nationkey),
        '%Y/%m/%d') ELSE 'unknown' END AS created_path,
      c_name AS full_name, CAST(c_acctbal > 0 AS VARCHAR) AS _9_lives_x, c_mktsegment AS segment, n.n_name AS nation,
      CASE WHEN c_nationkey < 5 THEN NULL ELSE 2 END AS n_turns, CAST(c_nationkey AS VARCHAR) AS raw_nation
    FROM customer JOIN nation n ON c_nationkey = n_nationkey WHERE c_nationkey BETWEEN 3 AND 23"""
)
def contact_flatten(t: Tables) -> DataFrame:
    records = _contact_records(t)
    flat = contacts(records, EVENT_DAYS)
    parsed = F.from_json(
        "custom_attributes", "market_segment string, geo struct<home_nation: string>, data string"
    )
    return flat.withColumn("f", parsed).select(
        "id",
        "created_path",
        "full_name",
        "_9_lives_x",
        F.col("f.market_segment").alias("segment"),
        F.col("f.geo.home_nation").alias("nation"),
        F.size(F.from_json("turns", "array<string>")).alias("n_turns"),
        F.get_json_object("f.data", "$['Kept Name']").alias("raw_nation"),
    )


@query(
    """SELECT 'c' || c_custkey AS id, CASE WHEN c_nationkey > 3 THEN strftime(TIMESTAMP '2024-01-01' + to_days(c_nationkey),
        '%Y/%m/%d') ELSE 'unknown' END AS day,
      CASE WHEN c_mktsegment = 'BUILDING' THEN 'again ' ELSE '' END || c_name AS full_name, c_mktsegment AS segment,
      n.n_name AS nation FROM customer JOIN nation n ON c_nationkey = n_nationkey"""
)
def contact_object_store(t: Tables) -> DataFrame:
    """Customers stored as one object each, one segment's stored again under another name, and read back."""
    path = scratch_path(t.spark, "contact_objects")
    records = _contact_records(t)
    write_objects(t.spark, path, contact_objects(records), ["updated_at"])
    again = records.where(F.col("`custom attributes`.`Market-Segment`") == "BUILDING")
    again = again.withColumn("Full Name", F.concat(F.lit("again "), "Full Name"))
    write_objects(t.spark, path, contact_objects(again), ["updated_at"])
    fields = "full_name string, custom_attributes struct<market_segment: string, geo: struct<home_nation: string>>"
    return read_objects(t.spark, path).withColumn("f", F.from_json("body", fields)).select(
        "id",
        "day",
        "f.full_name",
        F.col("f.custom_attributes.market_segment").alias("segment"),
        F.col("f.custom_attributes.geo.home_nation").alias("nation"),
    )


@query(
    """SELECT c_custkey AS id, c_name AS billing_details_full_name, c_acctbal AS billing_details_balance,
      c_mktsegment AS billing_details_market_segment FROM customer"""
)
def snake_names(t: Tables) -> DataFrame:
    """Nested fields with dots, dashes and capitals as flat columns in snake case."""
    details = F.struct(
        F.col("c_name").alias("fullName"), F.col("c_acctbal").alias("Balance"), F.col("c_mktsegment").alias("market-segment")
    )
    records = t.customer.select(F.col("c_custkey").alias("Id"), details.alias("billingDetails"))
    return rename_columns(flatten_structs(records, "."), "snake")


@query(
    """SELECT f AS format, o_orderpriority AS priority, count(*) AS n, round(sum(o_totalprice), 2) AS total
    FROM orders, (VALUES ('csv'), ('json'), ('orc'), ('parquet'), ('txt')) v(f) GROUP BY ALL"""
)
def format_read(t: Tables) -> DataFrame:
    """Orders written in each format and read back by extension."""
    rows = t.orders.select("o_orderpriority", "o_totalprice")
    parts = []
    for ext in ("csv", "json", "orc", "parquet", "txt"):
        path = f"{scratch_path(t.spark, 'landed')}.{ext}"
        if ext == "txt":
            rows.select(F.concat_ws("|", "o_orderpriority", "o_totalprice")).write.text(path)
            text = F.split("value", "[|]")
            read = read_landed(t.spark, path).select(text[0].alias("o_orderpriority"), text[1].alias("o_totalprice"))
        else:
            rows.write.format(ext).option("header", True).save(path)
            read = read_landed(t.spark, path, None if ext == "csv" else rows.schema)
        parts.append(read.select(F.lit(ext).alias("format"), "o_orderpriority", F.col("o_totalprice").cast("double")))
    return (
        union_all(parts)
        .groupBy("format", F.col("o_orderpriority").alias("priority"))
        .agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    )
