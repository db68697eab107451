"""Feeds derived from the given tables.

The given tables are no web analytics, so each feed is first expressed as flat SQL that
Spark and the oracle both understand; the Spark side then nests it into the feed's shape.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.times import DayRange
from ..plans.conversion import ChannelRules
from .registry import Tables

# The days that runs are over: the tables reach further on both sides. One load time for all loads.
EVENT_DAYS = DayRange(date(2024, 1, 4), date(2024, 1, 24))
ORDER_DAYS = DayRange(date(1996, 3, 1), date(2000, 10, 31))
IN_EVENT_DAYS = "{0} >= TIMESTAMP '2024-01-04' AND {0} < TIMESTAMP '2024-01-25'"
IN_ORDER_DAYS = "{0} >= TIMESTAMP '1996-03-01' AND {0} < TIMESTAMP '2000-11-01'"
LOAD_TIME = datetime(2024, 2, 1, 6, 0, 0)
RULES = ChannelRules(reward_discounts=("d4", "d16", "d28"))

# Events with the number in their properties, {"k": n}.
EV = """
SELECT event_id, ts, user_id, event_type, value, CAST(replace(substr(props, 7), '}}', '') AS BIGINT) AS k
FROM {events}
"""

# One web hit per event. Some have no session, no address, or one outside the site.
WEB = """
SELECT event_id, ts, value, k,
  CASE event_type
    WHEN 'view' THEN 'page_view'
    WHEN 'click' THEN CASE WHEN k < 50 THEN 'begin_checkout' ELSE 'pre_checkout_loaded' END
    WHEN 'signup' THEN 'sign_up'
    ELSE event_type
  END AS event_name,
  'u' || CAST(user_id AS STRING) AS user_pseudo_id,
  CASE WHEN k % 5 <> 0 THEN CAST(user_id AS STRING) END AS user_id,
  CASE WHEN k <> 97 THEN user_id * 100 + day(ts) END AS session_no,
  CASE k % 11
    WHEN 0 THEN 'https://www.shop.example/pt'
    WHEN 1 THEN 'https://www.shop.example/pt/plans'
    WHEN 2 THEN 'https://app.shop.example/home'
    WHEN 3 THEN 'https://checkout.shop.example/pay/plan'
    WHEN 4 THEN 'https://buy.shop.example/x'
    WHEN 5 THEN 'https://v2.shop.example/chat'
    WHEN 6 THEN 'http://shop.example/'
    WHEN 7 THEN 'https://staging.shop.example/a'
    WHEN 8 THEN 'https://www.other.example/a'
    WHEN 9 THEN 'https://platform.shop.example/login'
  END
  || '?q=1'
  || CASE WHEN k % 3 = 0 THEN '&promo=P' || CAST(k AS STRING) || '-x' ELSE '' END
  || CASE WHEN k % 4 = 0 THEN '&discount=d' || CAST(k AS STRING) ELSE '' END
  || CASE WHEN k % 13 = 0 THEN '&referral_code=r' || CAST(k AS STRING) || '#top' ELSE '' END AS url,
  CASE k % 6 WHEN 1 THEN 'google' WHEN 2 THEN 'meta' WHEN 3 THEN 'letter' WHEN 4 THEN 'youtube' WHEN 5 THEN 'blog' END
    AS source,
  CASE k % 6 WHEN 1 THEN 'cpc' WHEN 2 THEN 'paid' WHEN 3 THEN 'email' WHEN 4 THEN 'video' WHEN 5 THEN 'referral' END
    AS medium,
  CASE k % 6 WHEN 0 THEN NULL WHEN 1 THEN CAST(100 + k % 4 AS STRING) ELSE 'm' || CAST(k % 4 AS STRING) END AS campaign,
  CASE WHEN k % 6 > 0 AND k % 7 > 0 THEN 's' || CAST(k % 3 AS STRING) END AS term,
  CASE WHEN k % 6 > 0 THEN 'a' || CAST(k % 2 AS STRING) END AS content,
  CASE WHEN event_type = 'purchase' THEN 't' || CAST(event_id AS STRING) END AS transaction_id,
  CASE WHEN event_type = 'purchase' THEN value END AS revenue
FROM {ev}
"""

# Pre-checkout forms from sign-ups and purchases from purchase events.
FORMS = """
SELECT 'f' || CAST(event_id AS STRING) AS id, ts AS created_at, source AS utm_source, medium AS utm_medium,
  campaign AS utm_campaign, term AS utm_term, content AS utm_content,
  CASE WHEN k % 17 > 0 THEN user_pseudo_id || CASE WHEN k % 10 = 9 THEN '@shop.example' ELSE '@mail.example' END END
    AS email,
  event_id AS phone, 'name ' || user_pseudo_id AS name, 'plan' AS selected_plan, 'own' AS checkout_system,
  CASE WHEN k % 8 = 0 THEN 'p8' WHEN k % 8 = 1 THEN '' END AS promo,
  CASE WHEN k % 9 = 0 THEN 'r9' END AS referral_code,
  'agent' AS user_agent, 'ref' AS referrer, '/start' AS path
FROM {web} WHERE event_name = 'sign_up'
"""

TRANSACTIONS = """
SELECT transaction_id AS id, ts, value AS amount, source AS utm_source, medium AS utm_medium,
  campaign AS utm_campaign, term AS utm_term, content AS utm_content,
  CASE WHEN k % 19 = 0 THEN 'seller@shop.example' END AS seller_email,
  CASE WHEN k % 10 = 0 THEN 'aff' WHEN k % 10 = 1 THEN '' END AS affiliate_id,
  CASE WHEN k % 4 = 0 THEN 'd' || CAST(k AS STRING) END AS discount
FROM {web} WHERE event_name = 'purchase'
"""

# Ad statistics from line items, moved to the days of the events.
SEARCH = """
SELECT CAST(date '2024-01-01' + CAST(l_suppkey % 30 AS INT) AS DATE) AS segments_date,
  100 + l_partkey % 6 AS campaign_id,
  CAST(l_quantity * 1000 AS BIGINT) AS metrics_cost_micros,
  CAST(l_quantity AS BIGINT) AS metrics_impressions,
  CAST(l_linenumber AS BIGINT) AS metrics_clicks
FROM {lineitem}
"""

SOCIAL = """
SELECT CAST(date '2024-01-01' + CAST(l_suppkey % 30 AS INT) AS DATE) AS _load_date,
  CAST(date '2024-01-01' + CAST(l_suppkey % 30 AS INT) - CAST(l_linenumber % 3 AS INT) AS DATE) AS datestart,
  CASE WHEN l_linenumber = 3
    THEN 'm' || CAST(l_partkey % 5 AS STRING) || 's' || CAST(l_orderkey % 3 AS STRING) || 'a' || CAST(l_partkey % 2 AS STRING)
    WHEN l_linenumber < 7 THEN 'id' || CAST(l_partkey % 50 AS STRING) END AS CampaignId,
  CASE WHEN l_linenumber <> 5 THEN 'm' || CAST(l_partkey % 5 AS STRING) END AS CampaignName,
  'set' || CAST(l_partkey % 50 AS STRING) AS AdSetId,
  CASE WHEN l_linenumber % 2 = 0 THEN 's' || CAST(l_orderkey % 3 AS STRING) ELSE 'a' || CAST(l_partkey % 2 AS STRING) END
    AS AdSetName,
  'ad' || CAST(l_partkey % 200 AS STRING) AS AdId,
  CASE WHEN l_linenumber % 2 = 0 THEN 'a' || CAST(l_partkey % 2 AS STRING) ELSE 's' || CAST(l_orderkey % 3 AS STRING) END
    AS AdName,
  CAST(l_quantity AS BIGINT) AS Impressions,
  CAST(l_linenumber - 1 AS BIGINT) AS LinkClicks,
  CASE WHEN l_discount > 0 THEN l_quantity / 4 ELSE 0 END AS Spend
FROM {lineitem}
"""

# The same CTEs for the oracle.
EV_SQL = f"ev AS ({EV.format(events='events')})"
WEB_SQL = f"{EV_SQL}, web AS ({WEB.format(ev='ev')})"
HITS_SQL = f"{WEB_SQL}, hits AS (SELECT * FROM web WHERE {IN_EVENT_DAYS.format('ts')})"


def rows_sql(name: str, columns: str, rows: list[tuple]) -> str:
    """A CTE of fixed rows, numbered by ``priority`` in the order given."""

    def literal(value) -> str:
        return "NULL" if value is None else "'" + value + "'" if isinstance(value, str) else str(value)

    lines = ", ".join(f"({i}, {', '.join(map(literal, row))})" for i, row in enumerate(rows))
    return f"{name}(priority, {columns}) AS (VALUES {lines})"


def web_hits(t: Tables) -> DataFrame:
    return t.once("web hits", lambda: t.spark.sql(WEB, ev=t.spark.sql(EV, events=t.events)))


def web_events(t: Tables) -> DataFrame:
    return t.once("web events", lambda: _nested(t))


def _nested(t: Tables) -> DataFrame:
    """Web hits in the shape of the event feed; a key repeats in some of the arrays."""

    def entry(key: str, text=None, number=None):
        text = F.lit(None).cast("string") if text is None else text
        number = F.lit(None).cast("bigint") if number is None else number
        value = F.struct(text.alias("string_value"), number.alias("int_value"))
        return F.struct(F.lit(key).alias("key"), value.alias("value"))

    params = F.array(
        entry("engaged", text=F.lit("1")),
        entry("ga_session_id", number=F.col("session_no")),
        entry("page_location", text=F.col("url")),
        entry("ga_session_id", number=F.lit(-1).cast("bigint")),
    )
    campaign = F.struct("source", "medium", F.col("campaign").alias("campaign_name"), "term", "content")
    return web_hits(t).select(
        F.date_format("ts", "yyyyMMdd").alias("event_date"),
        F.unix_micros(F.col("ts").cast("timestamp")).alias("event_timestamp"),
        "event_name",
        "user_pseudo_id",
        "user_id",
        params.alias("event_params"),
        F.struct(campaign.alias("manual_campaign")).alias("session_traffic_source_last_click"),
        F.struct("transaction_id", F.col("revenue").alias("purchase_revenue")).alias("ecommerce"),
    )


def raw_forms(t: Tables) -> DataFrame:
    return t.spark.sql(FORMS, web=web_hits(t)).withColumn("created_at", F.col("created_at").cast("timestamp"))


def raw_transactions(t: Tables) -> DataFrame:
    return t.spark.sql(TRANSACTIONS, web=web_hits(t)).withColumn("timestamp", F.col("ts").cast("timestamp"))


def search_stats(t: Tables) -> DataFrame:
    return t.spark.sql(SEARCH, lineitem=t.lineitem)


def social_insights(t: Tables) -> DataFrame:
    return t.spark.sql(SOCIAL, lineitem=t.lineitem)
