"""Token cost report: messages, tokens and cost by day, user and model."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rules import capped, classify

# Plan groups.
FREE_PLANS = ["fair use unlimited", "trialing", "free"]
SUBSCRIPTIONS = {
    "pro subscription": "pro",
    "plus subscription": "plus",
    "lite subscription": "lite",
    "ultra subscription": "ultra",
}
GUEST_TEXT = "%guest mode%"
OTHER_PLAN = "b2b"

# Usage that is not a model's.
UNPRICED_MODELS = [" - ", "gpt-image-1"]

# Prompt limit of one model family.
CAPPED_FAMILY = "%claude%"
PROMPT_CAP = 200000


@dataclass(frozen=True)
class Renames:
    """Models reported under another name before a day, except from one source."""

    before: date
    not_from: str
    models: tuple[str, ...] = ("gpt-5-mini", "gpt-5-nano", "gpt-5-chat-latest")
    to: str = "gpt-4.1"


@dataclass(frozen=True)
class PriceOverride:
    """Models priced as another model before a day."""

    models: tuple[str, ...] = ("gpt-4o", "GPT-4o")
    before: date = date(2025, 4, 15)
    priced_as: str = "chatgpt-4o-latest"


@dataclass(frozen=True)
class ReportRules:
    renames: Renames
    internal_email: str = "%@shop%"


def plan_of(plan: Column) -> Column:
    rules = [(F.lower(plan).like(GUEST_TEXT), "guest"), (plan.isin(*FREE_PLANS), "free")]
    rules += [(plan == name, group) for name, group in SUBSCRIPTIONS.items()]
    return classify(rules, default=OTHER_PLAN)


def reported_model(created_at: Column, source: Column, model: Column, renames: Renames) -> Column:
    renamed = (
        (created_at < F.lit(renames.before).cast("timestamp"))
        & (source != renames.not_from)
        & model.isin(*renames.models)
    )
    return F.when(renamed, renames.to).otherwise(model)


def token_rows(
    logs: DataFrame, dates: DataFrame, rules: ReportRules, year_month: str | None = None
) -> DataFrame:
    """Distinct billed messages of a month (of all months without one).

    Filters see the logged model, not the reported one.
    """
    calendar = dates if year_month is None else dates.where(F.col("year_month") == year_month)
    billed = logs.where(
        (F.col("prompt_tokens") > 0)
        & (F.col("item_type") == "message")
        & ~F.col("ai_model").isin(*UNPRICED_MODELS)
        & ~F.lower("user_email").like(rules.internal_email)
    )
    is_capped = F.lower("ai_model").like(CAPPED_FAMILY)
    return (
        billed.join(calendar.select("id_date", "date"), "id_date")
        .select(
            "date",
            "user_email",
            plan_of(F.col("user_plan")).alias("plan"),
            reported_model(F.col("created_at"), F.col("source"), F.col("ai_model"), rules.renames).alias("ai_model"),
            "request_cost",
            capped("prompt_tokens", PROMPT_CAP, when=is_capped).alias("input_tokens"),
            F.col("completion_tokens").alias("output_tokens"),
            "id",
        )
        .distinct()
    )


def _only_price(prices: DataFrame, unit: str) -> Column:
    """The one price of the given rows; several rows are an error."""
    several = F.raise_error(F.lit("several prices for the fixed model")).cast("double")
    return prices.agg(F.when(F.count(F.lit(1)) > 1, several).otherwise(F.max(unit))).scalar()


def token_cost(rows: DataFrame, prices: DataFrame, override: PriceOverride = PriceOverride()) -> DataFrame:
    """Tokens and cost by day, user and model.

    Tokens are summed before the prices are joined: a price is constant within a model, so
    each sum needs one multiplication, and a much used model is one row per user and day.
    """
    by = ["date", "user_email", "ai_model"]
    both_known = F.col("output_tokens").isNotNull()
    used = rows.groupBy(*by).agg(
        F.count_distinct("id").alias("messages_sent"),
        F.sum("input_tokens").alias("_in"),
        F.sum("output_tokens").alias("_out"),
        F.sum(F.when(both_known, F.col("input_tokens"))).alias("_in_both"),
    )
    special = override
    is_special = F.col("ai_model").isin(*special.models) & (F.col("date") < F.lit(special.before))
    listed = prices.select(
        F.col("model_name").alias("ai_model"),
        F.col("input_cost_unit").alias("_listed_in"),
        F.col("output_cost_unit").alias("_listed_out"),
    )
    fixed = prices.where(F.col("model_name") == special.priced_as)
    fixed_in, fixed_out = (_only_price(fixed, c) for c in ("input_cost_unit", "output_cost_unit"))
    priced = used.join(listed, "ai_model", "left").withColumns(
        {
            "_price_in": F.when(is_special, fixed_in).otherwise(F.col("_listed_in")),
            "_price_out": F.when(is_special, fixed_out).otherwise(F.col("_listed_out")),
        }
    )
    cost_in, cost_out = F.col("_in") * F.col("_price_in"), F.col("_out") * F.col("_price_out")
    cost_both = F.col("_in_both") * F.col("_price_in") + cost_out
    # a model listed twice counts its tokens twice, as joining every message would
    return priced.groupBy(*by).agg(
        F.max("messages_sent").alias("messages_sent"),
        F.sum("_in").alias("total_input_tokens"),
        F.sum("_out").alias("total_output_tokens"),
        F.sum(cost_in).alias("total_input_cost"),
        F.sum(cost_out).alias("total_output_cost"),
        F.sum(cost_both).alias("grand_total_cost"),
    )


# Models by tier.
MODEL_TIERS = {
    "Fast": [
        "claude-3.5-haiku", "haiku", "gpt-4o-mini", "llama-3.3", "Llama 3.1", "Llama 3.1 ", "deepseek-3",
        "deepseek", "claude-3-5-haiku-latest", "llama-3", "gemini-2", "openai/gpt-4o-mini", "flux-images",
        "flux-pro", "flux", "flux-ultra-image", "gemini-2.5-flash-preview-04-17", "gemini-2.5-flash",
        "gpt-4.1-nano", "llama-4-scout", "gaia", "llama", "gpt-oss-120b", "gpt-5-mini", "command-r",
        "gemini-fal-ai", "flux-kontext-pro", "claude-4.5-haiku",
    ],
    "Advanced": [
        "bedrock", "claude-3.5", "Claude 3.5", "Claude 3.5 ", "claude-3.7-non-thinking", "gpt-4o", "GPT-4o",
        "azure", "mistral", "perplexity", "Sonar Web", "grok", "gemini", "sabia", "sabia-3",
        "gemini-2-pro", "Gemini 1.5 Pro", "Gemini", "chatgpt-4o-latest", "gemini-2.5-pro",
        "gpt-4.1", "grok-3", "llama-4-maverick", "sabia-3.1", "claude-4-non-thinking", "amazon-nova-premier",
        "gpt-5", "gpt-5-chat", "gpt-5-chat-latest", "kimi-k2", "claude-4.5", "grok-4-fast-non-reasoning",
    ],
    "Deep": [
        "deepseek-r1-small", "o3-mini", "gpt-o1", "o1 Mini", "deepseek-r1", "claude-3.7", "qwen-qwq-32b",
        "qwen/qwen3-32b", "grok-3-mini", "o4-mini", "claude-4", "o3", "grok-4", "claude-4.5-non-thinking",
    ],
}
OTHER_TIER = "Other"


def model_tier(model: Column, tiers: Mapping[str, Sequence[str]] = MODEL_TIERS) -> Column:
    return classify([(model.isin(*names), tier) for tier, names in tiers.items()], default=OTHER_TIER)


def unmapped_models(rows: DataFrame, tiers: Mapping[str, Sequence[str]] = MODEL_TIERS) -> DataFrame:
    """Models in use that belong to no tier."""
    return rows.select("ai_model").distinct().where(model_tier(F.col("ai_model"), tiers) == OTHER_TIER)
