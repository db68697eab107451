"""Hourly ad feeds."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.casts import day_or_null, float_or_zero, int_or_zero, units_from_micros
from ..functions.records import action_count
from ..functions.times import DayRange, dashless, day_key
from ..operators.dedupe import first_seen
from ..operators.reshape import flatten_structs
from ..schemas import SEARCH_ADS_HOURLY, SOCIAL_ADS_HOURLY, SOCIAL_ADS_ROWS
from ..sources.slices import dated_within

# The actions that get a column of their own.
ACTIONS = [
    "link_click",
    "omni_add_to_cart",
    "add_to_cart",
    "lead",
    "add_payment_info",
    "omni_purchase",
    "purchase",
]

HOUR_FIELD = "hourly_stats_aggregated_by_advertiser_time_zone"

# Columns a repeated search-ads hour takes from the new run; its date and name stay.
SEARCH_UPDATES = ["impressions", "clicks", "cost", "conversions", "all_conversions", "etl_load_date"]


def social_pages(objects: DataFrame) -> DataFrame:
    """Landed page objects (column ``raw``) as rows of the insights feed."""
    return objects.select(F.from_json("raw", SOCIAL_ADS_ROWS).alias("r")).select("r.*")


def newest_hours(objects: DataFrame) -> DataFrame:
    """Landed page objects, of several copies of an ad's hour the first one of the newest file."""
    fields = ["date_start", HOUR_FIELD, "account_id", "campaign_id", "adset_id", "ad_id"]
    keys = [f"_k{i}" for i in range(len(fields))]
    keyed = objects.select("*", F.json_tuple("raw", *fields).alias(*keys))
    # an absent id is a value like any other here
    keyed = keyed.withColumns({k: F.coalesce(F.concat(F.lit("="), k), F.lit("")) for k in keys})
    return first_seen(keyed, keys, [F.desc("fetch"), "page", "pos"]).drop(*keys)


def social_ads_hourly(rows: DataFrame, load_time: datetime) -> DataFrame:
    """Text rows of the insights feed as typed rows with one column per wanted action."""
    # cut to the wanted entries once, then looked up once per column
    slim = flatten_structs(rows).withColumn("actions", F.filter("actions", lambda a: a["action_type"].isin(*ACTIONS)))
    typed = slim.withColumns(
        {
            "id_date": day_key(day_or_null("date_start")),
            "hour": F.col(HOUR_FIELD),
            "cost": float_or_zero("spend"),
            "impressions": int_or_zero("impressions"),
            "inline_link_clicks": int_or_zero("inline_link_clicks"),
            "etl_load_date": F.lit(load_time).cast("timestamp"),
            **{f"act_{a}": action_count("actions", a) for a in ACTIONS},
        }
    )
    return typed.select(*SOCIAL_ADS_HOURLY.schema.names)


def search_ads_hourly(rows: DataFrame, load_time: datetime, days: DayRange | None = None) -> DataFrame:
    """Rows of the search feed with cost in units and a day key."""
    if days is not None:
        rows = dated_within(rows.withColumn("_day", F.to_date("date")), "_day", days).drop("_day")
    return rows.withColumns(
        {
            "id_date": dashless(F.col("date").cast("string")),
            "date": F.to_date("date"),
            "hour": F.col("hour").cast("bigint"),
            "cost": units_from_micros("cost_micros"),
            "etl_load_date": F.lit(load_time).cast("timestamp"),
        }
    ).select(*SEARCH_ADS_HOURLY.schema.names)


def report_order(rows: DataFrame) -> DataFrame:
    """Search rows as a report lists them."""
    return rows.orderBy("date", "hour", "campaign_id")
