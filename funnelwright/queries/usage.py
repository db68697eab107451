"""Token cost report on line items read as usage logs."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.token_cost import Renames, ReportRules, model_tier, plan_of, token_cost, token_rows, unmapped_models
from .inputs import rows_sql
from .registry import Tables, query

MODEL = """CASE p % 10
    WHEN 0 THEN 'gpt-4o' WHEN 1 THEN 'GPT-4o' WHEN 2 THEN 'claude-4' WHEN 3 THEN 'gpt-5-mini' WHEN 4 THEN 'gpt-4.1'
    WHEN 5 THEN 'gpt-image-1' WHEN 6 THEN 'in-house' WHEN 7 THEN 'chatgpt-4o-latest' WHEN 8 THEN 'o3' END"""
LOGS = f"""
SELECT CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) AS id, day AS created_at, id_date,
  CASE WHEN l_suppkey % 12 = 0 THEN 'staff@shop.example' WHEN l_suppkey % 12 = 1 THEN NULL
    ELSE 'User' || CAST(l_suppkey % 40 AS STRING) || '@mail.example' END AS user_email,
  CASE l_linenumber WHEN 1 THEN 'Guest Mode trial' WHEN 2 THEN 'free' WHEN 3 THEN 'pro subscription'
    WHEN 4 THEN 'lite subscription' WHEN 5 THEN 'trialing' WHEN 6 THEN 'team' END AS user_plan,
  {MODEL} AS ai_model,
  CASE WHEN l_quantity > 40 THEN NULL WHEN l_quantity > 20 THEN 'gateway' ELSE 'web' END AS source,
  l_tax AS request_cost, CAST(floor(l_extendedprice * 4) AS BIGINT) AS prompt_tokens,
  CASE WHEN l_linenumber < 7 THEN CAST(l_quantity AS BIGINT) END AS completion_tokens,
  CASE WHEN l_returnflag = 'R' THEN 'image' ELSE 'message' END AS item_type
FROM (SELECT *, l_partkey AS p, date '2025-03-01' + CAST(l_orderkey % 300 AS INT) AS day,
    replace(CAST(date '2025-03-01' + CAST(l_orderkey % 300 AS INT) AS STRING), '-', '') AS id_date FROM {{lineitem}}) AS days
"""
# The calendar: the days orders fall on. Prices: one per model, one model twice, one not at all.
DATES = """SELECT DISTINCT replace(CAST(day AS STRING), '-', '') AS id_date, day AS date,
    substr(replace(CAST(day AS STRING), '-', ''), 1, 6) AS year_month
  FROM (SELECT date '2025-03-01' + CAST(o_orderkey % 300 AS INT) AS day FROM {orders}) AS days"""
PRICES = f"""SELECT DISTINCT model AS model_name, length(model) / 1000.0 AS input_cost_unit,
    length(model) / 250.0 AS output_cost_unit
  FROM (SELECT {MODEL} AS model FROM (SELECT p_partkey AS p FROM {{part}}) AS keys) AS models
  WHERE model IS NOT NULL AND model <> 'o3'
  UNION ALL SELECT 'claude-4', 0.5, 1.5 FROM {{part}} WHERE p_partkey = 2"""

# The renaming rule of the queries: an invented source and day.
RULES = ReportRules(renames=Renames(before=date(2025, 9, 1), not_from="gateway"))

# Fixed values as rows. Plans: a pattern on the name in lower case, or the exact name; the first row
# that fits decides. Models: what they are reported as, priced as, and their tier.
PLAN_RULES = [
    ("%guest mode%", None, "guest"),
    *((None, name, "free") for name in ("fair use unlimited", "trialing", "free")),
    *((None, f"{name} subscription", name) for name in ("pro", "plus", "lite", "ultra")),
]
RENAMED = [(name, "gpt-4.1") for name in ("gpt-5-mini", "gpt-5-nano", "gpt-5-chat-latest")]
TIERS = [
    *((name, "Fast") for name in ("gpt-5-mini",)),
    *((name, "Advanced") for name in ("gpt-4o", "GPT-4o", "gpt-4.1", "chatgpt-4o-latest")),
    *((name, "Deep") for name in ("claude-4", "o3")),
]
PLANS_SQL = f"""{rows_sql('plan_rules', 'pattern, name, plan', PLAN_RULES)},
  plan_names AS (SELECT DISTINCT user_plan FROM logs),
  plans AS (
    SELECT user_plan, coalesce(arg_min(plan, priority), 'b2b') AS plan FROM plan_names
    LEFT JOIN plan_rules ON lower(user_plan) LIKE pattern OR user_plan = name GROUP BY user_plan)"""
TIERS_SQL = rows_sql("tiers", "ai_model, tier", TIERS)

# Billed messages, by taking away what is not billed and looking up plan, new name and day.
ROWS_SQL = f"""logs AS ({LOGS.format(lineitem='lineitem')}), dates AS ({DATES.format(orders='orders')}),
  prices AS ({PRICES.format(part='part')}), {PLANS_SQL}, {rows_sql('renamed', 'ai_model, reported', RENAMED)},
  billed AS (
    FROM logs WHERE prompt_tokens > 0 AND item_type = 'message' AND length(ai_model) > 0 AND user_email IS NOT NULL
    EXCEPT FROM logs WHERE ai_model IN (' - ', 'gpt-image-1') OR contains(lower(user_email), '@shop')),
  tokens AS (
    SELECT DISTINCT date, user_email, plan,
      if(created_at < DATE '2025-09-01' AND source <> 'gateway', ifnull(reported, ai_model), ai_model) AS ai_model, request_cost,
      if(contains(lower(ai_model), 'claude'), least(prompt_tokens, 200000), prompt_tokens) AS input_tokens,
      completion_tokens AS output_tokens, id
    FROM billed JOIN dates USING (id_date) LEFT JOIN renamed USING (ai_model)
    JOIN plans ON plans.user_plan IS NOT DISTINCT FROM billed.user_plan),
  used AS (SELECT DISTINCT date, ai_model FROM tokens),
  fixed AS (FROM prices WHERE model_name = 'chatgpt-4o-latest'),
  rates AS (
    SELECT used.date, used.ai_model, coalesce(f.input_cost_unit, p.input_cost_unit) AS in_unit,
      coalesce(f.output_cost_unit, p.output_cost_unit) AS out_unit
    FROM used LEFT JOIN prices p ON p.model_name = used.ai_model
    LEFT JOIN fixed f ON lower(used.ai_model) = 'gpt-4o' AND used.date < DATE '2025-04-15'),
  usage AS (
    SELECT date, user_email, ai_model, count(DISTINCT id) AS messages, sum(input_tokens) AS tokens_in,
      sum(output_tokens) AS tokens_out, sum(input_tokens) FILTER (output_tokens IS NOT NULL) AS tokens_in_known
    FROM tokens GROUP BY date, user_email, ai_model),
  spent AS (
    SELECT date, user_email, ai_model, any_value(messages) AS messages_sent, sum(tokens_in) AS total_input_tokens,
      sum(tokens_out) AS total_output_tokens, sum(tokens_in * in_unit) AS total_input_cost,
      sum(tokens_out * out_unit) AS total_output_cost, sum(tokens_in_known * in_unit + tokens_out * out_unit) AS grand_total_cost
    FROM usage JOIN rates USING (date, ai_model) GROUP BY date, user_email, ai_model)"""


def logs(t: Tables) -> DataFrame:
    rows = t.spark.sql(LOGS, lineitem=t.lineitem)
    return rows.withColumn("created_at", F.col("created_at").cast("timestamp"))


def dates(t: Tables) -> DataFrame:
    return t.spark.sql(DATES, orders=t.orders)


def prices(t: Tables) -> DataFrame:
    rows = t.spark.sql(PRICES, part=t.part)
    return rows.withColumns({c: F.col(c).cast("double") for c in ("input_cost_unit", "output_cost_unit")})


def rows(t: Tables) -> DataFrame:
    return token_rows(logs(t), dates(t), RULES)


@query(
    f"""WITH {ROWS_SQL} SELECT strftime(date, '%Y-%m-%d') AS date, user_email, ai_model, messages_sent,
      CAST(total_input_tokens AS BIGINT) AS total_input_tokens, CAST(total_output_tokens AS BIGINT) AS total_output_tokens,
      round(total_input_cost, 3) AS total_input_cost, round(total_output_cost, 3) AS total_output_cost,
      round(grand_total_cost, 3) AS grand_total_cost FROM spent""",
    name="token_cost",
)
def costs(t: Tables) -> DataFrame:
    report = token_cost(rows(t), prices(t))
    rounded = {c: F.round(c, 3) for c in ("total_input_cost", "total_output_cost", "grand_total_cost")}
    return report.withColumns(rounded | {"date": F.col("date").cast("string")})


@query(
    f"""WITH logs AS ({LOGS.format(lineitem='lineitem')}), {PLANS_SQL} SELECT plans.user_plan, plan, count(*) AS n
    FROM logs JOIN plans ON plans.user_plan IS NOT DISTINCT FROM logs.user_plan GROUP BY ALL"""
)
def plan_rules(t: Tables) -> DataFrame:
    return logs(t).groupBy("user_plan", plan_of(F.col("user_plan")).alias("plan")).agg(F.count(F.lit(1)).alias("n"))


@query(
    f"""WITH {ROWS_SQL} SELECT strftime(date, '%Y-%m-%d') AS date, user_email, plan, ai_model, request_cost,
    CAST(input_tokens AS BIGINT) AS input_tokens, output_tokens, id FROM tokens WHERE strftime(date, '%Y%m') = '202510'"""
)
def date_dim_join(t: Tables) -> DataFrame:
    """The distinct billed messages of one month."""
    month = token_rows(logs(t), dates(t), RULES, "202510")
    return month.withColumn("date", F.col("date").cast("string"))


@query(
    f"""WITH {ROWS_SQL} SELECT ai_model, CAST(date < DATE '2025-04-15' AS INTEGER) AS early,
      round(sum(total_input_cost), 3) AS cost FROM spent GROUP BY ALL"""
)
def price_override(t: Tables) -> DataFrame:
    report = token_cost(rows(t), prices(t))
    early = (F.col("date") < F.to_date(F.lit("2025-04-15"))).cast("int")
    return report.groupBy("ai_model", early.alias("early")).agg(F.round(F.sum("total_input_cost"), 3).alias("cost"))


@query(
    f"""WITH logs AS ({LOGS.format(lineitem='lineitem')}), {TIERS_SQL} SELECT ai_model, coalesce(tier, 'Other') AS tier,
      count(*) AS n FROM logs LEFT JOIN tiers USING (ai_model) GROUP BY ALL""",
    name="model_tier",
)
def tiers(t: Tables) -> DataFrame:
    return logs(t).groupBy("ai_model", model_tier(F.col("ai_model")).alias("tier")).agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {ROWS_SQL}, {TIERS_SQL} SELECT DISTINCT ai_model FROM tokens ANTI JOIN tiers USING (ai_model)")
def unmapped_audit(t: Tables) -> DataFrame:
    return unmapped_models(rows(t))
