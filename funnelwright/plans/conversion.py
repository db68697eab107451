"""Campaign conversion mart: sessions, pre-checkouts, purchases and ad cost per day."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.casts import rounded_int
from ..functions.keys import NOT_SET, first_present, joined
from ..functions.rules import classify, present
from ..functions.times import DayRange, day_key
from ..operators.counts import measures_by_channel
from ..operators.joins import candidate_full_join, full_join_chain, spread_null_keys
from ..schemas import CAMPAIGN_CONVERSION
from ..sources.slices import loaded_since

# Channel names.
SEARCH_PAID = "google-paid"
SOCIAL_PAID = "meta-paid"
AFFILIATES = "affiliates"
REWARDS = "rewards"
SELLERS = "internal-sellers"

# Fixed value: source and medium whose term and content are ignored.
AUTO_TAGGED = "google/cpc"

DAY_AND_HASH = ["id_date", "utm_hash"]


@dataclass(frozen=True)
class ChannelRules:
    """What the channel of a conversion depends on besides its campaign."""

    paid: tuple[str, ...] = (SOCIAL_PAID, SEARCH_PAID)
    reward_discounts: tuple[str, ...] = ()

    def is_reward(self, discount: str) -> Column:
        return F.coalesce(F.col(discount).isin(*self.reward_discounts), F.lit(False))


def replaced_key(key: str, days: DayRange, late: Sequence[date]) -> Column:
    """Whether a day key is on or after the range's first day, or one of the late days."""
    since = F.col(key) >= days.first_key
    return since | F.col(key).isin(*(day.strftime("%Y%m%d") for day in late)) if late else since


def sessions_by_channel(
    funnel: DataFrame, dim: DataFrame, days: DayRange, rules: ChannelRules, late: Sequence[date] = ()
) -> DataFrame:
    override = classify(
        [
            (present("referral_code"), AFFILIATES),
            (present("promo"), REWARDS),
            (rules.is_reward("discount"), REWARDS),
            (present("discount"), SELLERS),
        ]
    )
    fact = funnel.where(replaced_key("id_date", days, late)).withColumn("override", override)
    return measures_by_channel(
        fact, dim, ["id_date"], "utm_hash", "session_hash", [AFFILIATES, REWARDS, SELLERS], rules.paid, "sessions"
    )


def precheckouts_by_channel(
    forms: DataFrame, dim: DataFrame, days: DayRange, rules: ChannelRules, late: Sequence[date] = ()
) -> DataFrame:
    override = classify([(present("referral_code"), AFFILIATES), (present("promo"), REWARDS)])
    fact = forms.where(replaced_key("id_date", days, late)).withColumn("override", override)
    return measures_by_channel(
        fact, dim, ["id_date"], "utm_hash", "email", [AFFILIATES, REWARDS], rules.paid, "pre_checkouts"
    )


def transactions_by_channel(
    transactions: DataFrame, dim: DataFrame, days: DayRange, rules: ChannelRules, late: Sequence[date] = ()
) -> DataFrame:
    override = classify(
        [
            (F.col("seller_email").isNotNull(), SELLERS),
            (present("affiliate_id"), AFFILIATES),
            (rules.is_reward("discount"), REWARDS),
        ]
    )
    fact = transactions.where(replaced_key("id_date", days, late)).withColumn("override", override)
    return measures_by_channel(
        fact,
        dim,
        ["id_date"],
        "utm_hash",
        "id",
        [SELLERS, AFFILIATES, REWARDS],
        rules.paid,
        "purchases",
        amount="amount",
        sum_as="revenue",
    )


def _replaced(day: str, days: DayRange, late: Sequence[date]) -> Column:
    since = F.col(day) >= F.lit(days.first)
    return since | F.col(day).isin(*late) if late else since


def search_cost(stats: DataFrame, days: DayRange, late: Sequence[date] = ()) -> DataFrame:
    """Search ads by day and campaign, cost in units."""
    return (
        stats.where(_replaced("segments_date", days, late))
        .groupBy("segments_date", "campaign_id")
        .agg(
            (F.sum("metrics_cost_micros") / F.lit(1_000_000)).alias("cost"),
            F.sum("metrics_impressions").alias("impressions"),
            F.sum("metrics_clicks").alias("clicks"),
        )
        .select(
            day_key("segments_date").alias("id_date"),
            F.lit(SEARCH_PAID).alias("channel"),
            F.col("campaign_id").cast("string").alias("campaign_id"),
            "cost",
            "impressions",
            "clicks",
        )
    )


SOCIAL_KEYS = ["datestart", "CampaignId", "CampaignName", "AdSetId", "AdSetName", "AdId", "AdName"]


def _used() -> Column:
    return (F.col("Spend") > 0) | (F.col("LinkClicks") > 0)


def late_days(insights: DataFrame, days: DayRange) -> list[date]:
    """Days before the range of which ads have been loaded since its first day."""
    late = loaded_since(insights, "_load_date", days).where(_used() & (F.col("datestart") < F.lit(days.first)))
    return sorted(row["day"] for row in late.select(F.to_date("datestart").alias("day")).distinct().collect())


def social_cost(insights: DataFrame, days: DayRange, late: Sequence[date] = ()) -> DataFrame:
    """Social ads by day and ad, with the two texts campaigns are recognised by.

    An ad loaded late for a day before the range belongs to stored rows that are not replaced, unless the
    day is one of the ``late`` ones; of these all ads count, whenever they were loaded.
    """
    loads = DayRange(min([days.first, *late]), days.last)  # an ad is loaded on its day or later
    in_range = (F.col("datestart") >= F.lit(days.first)) & (F.col("_load_date") >= F.lit(days.first))
    if late:
        in_range = in_range | F.col("datestart").isin(*late)
    ids = {c: F.col(c).cast("string") for c in ("CampaignId", "AdSetId", "AdId")}
    return (
        loaded_since(insights, "_load_date", loads)
        .where(_used() & in_range)
        .withColumns(ids)
        .groupBy(*SOCIAL_KEYS)
        .agg(
            F.sum("Impressions").alias("impressions"),
            F.sum("LinkClicks").alias("clicks"),
            F.sum("Spend").alias("cost"),
        )
        .select(
            day_key("datestart").alias("id_date"),
            F.lit(SOCIAL_PAID).alias("channel"),
            *SOCIAL_KEYS[1:],
            first_present("CampaignId", "AdSetId", "AdId").alias("campaign_hash"),
            joined("CampaignName", "AdSetName", "AdName").alias("campaign_hash1"),
            "impressions",
            "clicks",
            "cost",
        )
    )


def conversions_by_campaign(
    sessions: DataFrame, transactions: DataFrame, precheckouts: DataFrame, dim: DataFrame
) -> DataFrame:
    """The three conversion measures side by side, by day, channel and campaign text.

    The measures meet on day and campaign hash only, not on channel: several channels of
    one hash repeat each other's measures. The stored mart is defined that way.
    """
    renamed = [
        df.withColumnRenamed("channel", f"channel_{i}") for i, df in enumerate((sessions, transactions, precheckouts))
    ]
    chained = full_join_chain(renamed, DAY_AND_HASH).withColumn(
        "channel", first_present("channel_0", "channel_1", "channel_2")
    )
    auto_tagged = joined("source", F.lit("/"), "medium") == AUTO_TAGGED
    campaigns = dim.select(
        "utm_hash",
        "campaign",
        F.when(auto_tagged, NOT_SET).otherwise(F.col("term")).alias("term"),
        F.when(auto_tagged, NOT_SET).otherwise(F.col("content")).alias("content"),
    )
    measures = ["sessions", "pre_checkouts", "purchases", "revenue"]
    return (
        chained.join(campaigns, "utm_hash", "left")
        .groupBy("id_date", "channel", "campaign", "term", "content")
        .agg(*(F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in measures))
    )


def with_social_cost(conversions: DataFrame, social: DataFrame) -> DataFrame:
    """Conversions joined to ads recognised by id or by names, in either order of term and
    content."""
    ads = social.select(*(F.col(c).alias(f"s_{c}") for c in social.columns))
    return candidate_full_join(
        conversions,
        ads,
        on=[("id_date", "s_id_date"), ("channel", "s_channel")],
        left_texts=[joined("campaign", "term", "content"), joined("campaign", "content", "term")],
        right_texts=[F.col("s_campaign_hash"), F.col("s_campaign_hash1")],
        distinct=True,  # both sides come from groupings
    )


def with_search_cost(rows: DataFrame, search: DataFrame) -> DataFrame:
    """Full join of the second cost feed on the conversion side's keys.

    Ads without a conversion have no such keys and match nothing; they are spread instead
    of meeting in one task under the NULL key.
    """
    keys = ["id_date", "channel", "campaign"]
    ad_keys = ["g_id_date", "g_channel", "g_campaign_id"]
    ads = search.select(*(F.col(c).alias(f"g_{c}") for c in search.columns))
    left = spread_null_keys(rows, keys)
    right = spread_null_keys(ads, ad_keys).withColumnRenamed("_spread", "_g_spread")
    same = F.col("_spread") == F.col("_g_spread")
    for key, ad_key in zip(keys, ad_keys):
        same = same & (F.col(key) == F.col(ad_key))
    return left.join(right, same, "full").drop("_spread", "_g_spread")


def campaign_conversion(
    funnel: DataFrame,
    precheckouts: DataFrame,
    transactions: DataFrame,
    dim: DataFrame,
    search_stats: DataFrame,
    social_insights: DataFrame,
    days: DayRange,
    rules: ChannelRules = ChannelRules(),
    late: Sequence[date] = (),
) -> DataFrame:
    """The mart rows from ``days.first`` on, and of the late days; the range has no upper end."""
    conversions = conversions_by_campaign(
        sessions_by_channel(funnel, dim, days, rules, late),
        transactions_by_channel(transactions, dim, days, rules, late),
        precheckouts_by_channel(precheckouts, dim, days, rules, late),
        dim,
    )
    social = social_cost(social_insights, days, late)
    recognised = with_social_cost(conversions, social)
    rows = with_search_cost(recognised, search_cost(search_stats, days, late))

    def ad_sum(measure: str) -> Column:
        return F.coalesce(F.sum(f"s_{measure}"), F.sum(f"g_{measure}"), F.lit(0))

    mart = (
        rows.withColumns(
            {
                "id_date": first_present("id_date", "s_id_date", "g_id_date"),
                "channel": first_present("channel", "s_channel", "g_channel"),
                "campaign": first_present("campaign", "s_CampaignId", "g_campaign_id"),
            }
        )
        .groupBy("id_date", "channel", "campaign")
        .agg(
            rounded_int(ad_sum("impressions")).alias("impressions"),
            rounded_int(ad_sum("clicks")).alias("clicks"),
            ad_sum("cost").alias("cost"),
            *(F.sum(m).alias(m) for m in ("sessions", "pre_checkouts", "purchases", "revenue")),
        )
    )
    return mart.select(*CAMPAIGN_CONVERSION.schema.names)
