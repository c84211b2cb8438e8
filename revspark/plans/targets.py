"""Quota and customer derivations (TG-01..08).

The deterministic data work embedded in the modelled data generator: revenue
baselines, agent x month spines, seasonal quota targets, activity windows,
unit cost sheets, account engagement bands, NPS classes and ticket
resolution. Random draws are replaced by explicit inputs or parameters.
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revspark.functions import rules as R
from revspark.functions.numeric import MONEY, round_half_up
from revspark.operators.cumulative import dense_number
from revspark.operators.lookup import left_lookup
from revspark.operators.spine import month_spine

# Defaults of the modelled generator.
DEFAULT_BASELINE_USD = 15000
QUOTA_UPLIFT = 1.15
SEASONAL_BY_QUARTER = {1: 0.85, 2: 1.0, 3: 1.05, 4: 1.15}
QUOTA_FLOOR_USD = 5000
DEFAULT_ENGAGE_DATE = "2017-06-01"
RESPONSE_BASE, RESPONSE_PER_DEAL, RESPONSE_CAP = 40, 1, 85   # in percent
TICKET_BANDS = [(0, "none"), (10, "low"), (30, "medium")]     # deals == 0, < 10, < 30, else high
NPS_BANDS = [(0, "none"), (15, "low"), (30, "medium")]        # deals == 0, <= 15, <= 30, else high
RESOLUTION_BANDS = [(24, "fast"), (72, "standard")]           # hours < 24, < 72, else slow


def _won(pipeline: DataFrame) -> DataFrame:
    return pipeline.filter(F.col("deal_stage") == R.WON_STAGE)


# TG-01
def agent_baseline(pipeline: DataFrame) -> DataFrame:
    """Mean of an agent's monthly won revenue over the months that had wins.

    Grouping drops NULL agents and deals without a close date, like a pandas
    groupby does.
    """
    won = _won(pipeline).filter(F.col("agent_name").isNotNull() & F.col("close_date").isNotNull())
    monthly = won.groupBy("agent_name", R.month_key("close_date").alias("_m")).agg(
        F.coalesce(F.sum(F.col("close_value_usd").cast(MONEY)), F.lit(0).cast(MONEY)).alias("_rev"))
    per_agent = monthly.groupBy("agent_name").agg(
        F.sum("_rev").alias("_total"), F.count(F.lit(1)).alias("months_with_wins"))
    return per_agent.select(
        "agent_name", "months_with_wins",
        (F.col("_total").cast("double") / F.col("months_with_wins").cast("double"))
        .alias("avg_monthly_revenue_usd"))


# TG-02
def agent_month_spine(teams: DataFrame, start: str = "1998-01", end: str = "1998-12") -> DataFrame:
    s = month_spine(teams.select("agent_name", "manager_name", "regional_office"), start, end, "_d")
    return s.select("agent_name", "manager_name", "regional_office",
                    F.date_format("_d", "yyyy-MM").alias("quota_month"),
                    F.quarter("_d").alias("quarter"))


def _seasonal(quarter: Column) -> Column:
    out = None
    for q, f in SEASONAL_BY_QUARTER.items():
        out = F.when(quarter == q, F.lit(f)) if out is None else out.when(quarter == q, F.lit(f))
    return out


# TG-03
def quota_targets(teams: DataFrame, pipeline: DataFrame, start: str = "1998-01",
                  end: str = "1998-12") -> DataFrame:
    """Monthly quota per agent: baseline x uplift x seasonal factor, floored, to cents."""
    base = agent_baseline(pipeline).select("agent_name", "avg_monthly_revenue_usd")
    # the lookup comes before the months: one row per agent is shuffled, not twelve
    known = left_lookup(teams.select("agent_name", "manager_name", "regional_office"), base, "agent_name",
                        {"avg_monthly_revenue_usd": float(DEFAULT_BASELINE_USD)})
    j = (month_spine(known, start, end, "_d")
         .withColumns({"quota_month": F.date_format("_d", "yyyy-MM"), "quarter": F.quarter("_d")}))
    amount = F.col("avg_monthly_revenue_usd") * QUOTA_UPLIFT * _seasonal(F.col("quarter"))
    return j.select(
        R.quota_id("agent_name", "quota_month").alias("quota_id"),
        F.col("agent_name").alias("sales_agent"),
        F.col("manager_name").alias("manager"),
        "regional_office", "quota_month",
        F.greatest(round_half_up(amount, 2), F.lit(float(QUOTA_FLOOR_USD))).alias("quota_amount_usd"),
        F.lit("revenue").alias("quota_type"))


# TG-04
def activity_window(pipeline: DataFrame, open_days: int = 30,
                    default_start: str = DEFAULT_ENGAGE_DATE) -> DataFrame:
    """Effective date window in which a deal's activities fall."""
    start = F.coalesce(F.col("engage_date"), F.lit(_dt.date.fromisoformat(default_start)))
    end0 = F.coalesce(F.col("close_date"), F.date_add(start, open_days))
    end = F.when(end0 <= start, F.date_add(start, 1)).otherwise(end0)
    out = pipeline.select("opportunity_id", "agent_name", "deal_stage",
                          start.alias("window_start"), end.alias("window_end"))
    return out.withColumn("window_days",
                          R.days_between("window_end", "window_start"))


# TG-05
def unit_costs(products: DataFrame, rates: DataFrame) -> DataFrame:
    """Cost sheet from list prices and per-product cost rates (fractions of price)."""
    j = products.join(rates, "product_name", "inner")
    price = F.col("list_price_usd").cast("double")
    return j.select(
        F.col("product_name").alias("product"),
        F.col("product_series").alias("series"),
        F.col("list_price_usd").alias("sales_price_usd"),
        round_half_up(price * F.col("cogs_pct"), 2).alias("cogs_usd"),
        round_half_up(price * F.col("shipping_pct"), 2).alias("shipping_cost_usd"),
        round_half_up(price * F.col("support_pct"), 2).alias("support_cost_per_unit_usd"),
        round_half_up("commission_pct", 4).alias("sales_commission_pct"),
        round_half_up(F.lit(1.0) - F.col("cogs_pct"), 4).alias("gross_margin_pct"))


def _band(deals: Column, bands, last: str, inclusive: bool) -> Column:
    out = F.when(deals == 0, F.lit(bands[0][1]))
    for bound, label in bands[1:]:
        cond = deals <= bound if inclusive else deals < bound
        out = out.when(cond, F.lit(label))
    return out.otherwise(F.lit(last))


# TG-06
def account_engagement(accounts: DataFrame, pipeline: DataFrame) -> DataFrame:
    """Won deals and revenue per account with the generator's volume bands."""
    won = _won(pipeline).filter(F.col("account_name").isNotNull())
    per_account = won.groupBy("account_name").agg(
        F.count("opportunity_id").alias("won_deals"),
        F.sum(F.col("close_value_usd").cast(MONEY)).cast("double").alias("won_revenue_usd"))
    j = left_lookup(accounts.select("account_name"), per_account, "account_name",
                    {"won_deals": 0, "won_revenue_usd": 0.0})
    d = F.col("won_deals")
    propensity = F.least(F.lit(RESPONSE_CAP).cast("double"),
                         (F.lit(RESPONSE_BASE) + d * RESPONSE_PER_DEAL).cast("double")) / F.lit(100.0)
    return j.select(
        "account_name", F.col("won_deals").cast("bigint").alias("won_deals"), "won_revenue_usd",
        _band(d, TICKET_BANDS, "high", inclusive=False).alias("ticket_band"),
        _band(d, NPS_BANDS, "high", inclusive=True).alias("nps_band"),
        propensity.alias("response_propensity"))


# TG-07
def nps_category(surveys: DataFrame) -> DataFrame:
    cat = R.nps_category("nps_score")
    return surveys.select("survey_id", "account_name", "nps_score", cat.alias("derived_category"),
                          (F.col("nps_category") == cat).alias("matches_source"))


# TG-08
def ticket_resolution(tickets: DataFrame, resolved_status: str = "resolved") -> DataFrame:
    """Resolution date = created + resolution hours for resolved tickets, and an hour band."""
    h = F.col("resolution_hours")
    resolved = F.col("ticket_status") == resolved_status
    band = None
    for bound, label in RESOLUTION_BANDS:
        band = F.when(h < bound, F.lit(label)) if band is None else band.when(h < bound, F.lit(label))
    band = band.when(h.isNotNull(), F.lit("slow"))
    # created_date is midnight, so adding h hours lands floor(h / 24) days later
    derived = F.when(resolved, F.date_add("created_date", F.floor(h / 24).cast("int")))
    return tickets.select("ticket_id", "account_name", "ticket_status", "resolution_hours",
                          derived.alias("derived_resolved_date"), band.alias("resolution_band"))


# SCA-18. Prefix and width of the numbered ids.
SURROGATES = {"activities": ("ACT-", 6), "nps_surveys": ("NPS-", 5), "support_tickets": ("TKT-", 6)}


def surrogate_ids(activities: DataFrame, surveys: DataFrame, tickets: DataFrame) -> DataFrame:
    """(table_name, source_id, surrogate_id): the records of the three generated tables numbered
    densely from 1, by opportunity or account, date and source id."""
    rows = {"activities": (activities, "opportunity_id", "activity_date", "activity_id"),
            "nps_surveys": (surveys, "account", "survey_sent_date", "survey_id"),
            "support_tickets": (tickets, "account", "created_date", "ticket_id")}
    parts = []
    for name, (df, parent, date, source_id) in rows.items():
        prefix, width = SURROGATES[name]
        order = [F.asc_nulls_last(c) for c in (parent, date, source_id)]
        numbered = dense_number(df.select(parent, date, source_id), order, "_n")
        parts.append(numbered.select(F.lit(name).alias("table_name"), F.col(source_id).alias("source_id"),
                                     R.padded_id(prefix, "_n", width).alias("surrogate_id")))
    return reduce(DataFrame.unionByName, parts)
