"""Campaign dimension: the distinct campaign field combinations and their channel."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import NOT_SET, joined, not_set
from ..functions.rules import classify
from ..functions.times import DayRange
from ..operators.merge import insert_new, update_changed
from .funnel import Site, on_site

FIELDS = ["source", "medium", "campaign", "term", "content"]

# Channel by source, then by medium; first match wins.
SOURCE_CHANNELS = {
    "meta-paid": ["meta", "meta-ads", "ig", "facebook"],
    "remarketing": ["taboola", "blue"],
    "partners": ["youtube", "yt", "youtube-organic"],
}
MEDIUM_CHANNELS = {
    "email": ["email"],
    "organic": ["organic"],
    "referral": ["referral"],
    "social": ["social"],
}
UNMAPPED = "not mapped"


def channel_of(source: Column, medium: Column, campaign: Column, term: Column, content: Column) -> Column:
    nothing_set = reduce(lambda a, b: a & b, (c == NOT_SET for c in (source, medium, campaign, term, content)))
    rules = [(nothing_set, "direct"), ((source == "google") & (medium == "cpc"), "google-paid")]
    rules += [(source.isin(*values), name) for name, values in SOURCE_CHANNELS.items()]
    rules += [(medium.isin(*values), name) for name, values in MEDIUM_CHANNELS.items()]
    return classify(rules, default=UNMAPPED)


def _fields(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*(not_set(c).alias(name) for c, name in zip(cols, FIELDS)))


def event_fields(web_events: DataFrame, days: DayRange, site: Site) -> DataFrame:
    click = "session_traffic_source_last_click.manual_campaign."
    fields = ("source", "medium", "campaign_name", "term", "content")
    return _fields(on_site(web_events, days, site), *(click + c for c in fields))


def utm_fields(rows: DataFrame) -> DataFrame:
    return _fields(rows, "utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content")


def campaign_rows(
    web_events: DataFrame,
    precheckouts: DataFrame,
    transactions: DataFrame,
    days: DayRange,
    site: Site = Site(),
    internal_email: str = "%@shop.example%",
) -> DataFrame:
    """Distinct campaigns of the three sources.

    One distinct over the union is enough: its map-side part already reduces each source
    to its own distinct rows before the only shuffle.
    """
    checked = precheckouts.where(days.holds_ts("created_at") & ~F.col("email").like(internal_email))
    paid = transactions.where(days.holds_ts("timestamp"))
    fields = (
        event_fields(web_events, days, site).unionByName(utm_fields(checked)).unionByName(utm_fields(paid)).distinct()
    )
    cols = [F.col(c) for c in FIELDS]
    return fields.select(F.md5(joined(*FIELDS)).alias("utm_hash"), channel_of(*cols).alias("channel"), *FIELDS)


def refreshed_dimension(dim: DataFrame, campaigns: DataFrame) -> DataFrame:
    """The dimension with new campaigns added and changed channels updated."""
    with_new = dim.unionByName(insert_new(dim, campaigns, ["utm_hash"]))
    return update_changed(with_new, campaigns, "utm_hash", "channel")
