"""Mart models: three dimensions and two facts (PRJ-12..16)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revspark.functions import rules as R
from revspark.operators.lookup import left_lookup


def dim_accounts(health: DataFrame) -> DataFrame:
    return health.select(
        "account_name", "sector", "annual_revenue_usd", "employee_count",
        R.account_tier("annual_revenue_usd").alias("account_tier"),
        "latest_nps_score", "latest_nps_category", "avg_nps_score", "total_tickets",
        "high_priority_tickets", "avg_satisfaction_rating", "health_score", "churn_risk",
        "total_deals", "deals_won", F.col("total_revenue_usd").alias("lifetime_revenue_usd"))


def dim_products(products: DataFrame, costs: DataFrame) -> DataFrame:
    c = costs.select("product_name", "cogs_usd", "shipping_cost_usd", "support_cost_per_unit_usd",
                     "sales_commission_pct", "gross_margin_pct")
    j = left_lookup(products.select("product_name", "product_series", "list_price_usd"), c, "product_name")
    return j.select(
        "product_name", "product_series", "list_price_usd", "cogs_usd", "shipping_cost_usd",
        "support_cost_per_unit_usd", "sales_commission_pct", "gross_margin_pct",
        R.margin_tier("gross_margin_pct").alias("margin_tier"))


def dim_sales_teams(teams: DataFrame) -> DataFrame:
    return teams.select("agent_name", "manager_name", "regional_office")


FCT_PIPELINE_COLUMNS = [
    "opportunity_id", "agent_name", "product_name", "account_name", "deal_stage", "engage_date",
    "close_date", "close_value_usd", "cogs_usd", "net_profit_usd", "days_in_pipeline", "is_won",
    "is_lost", "gross_margin_pct"]


def fct_sales_pipeline(deals: DataFrame) -> DataFrame:
    return deals.select(*FCT_PIPELINE_COLUMNS)


def fct_sales_performance(perf: DataFrame) -> DataFrame:
    return perf.select(
        "agent_name", "period_month", "manager_name", "regional_office", "quota_amount_usd",
        "deals_won", "total_revenue_usd", "total_profit_usd", "quota_attainment_pct",
        "avg_days_in_pipeline", "total_activities", "total_effort_minutes", "positive_outcomes",
        R.performance_tier("quota_attainment_pct").alias("performance_tier"))
