"""Staging models: renames only (PRJ-01..10), plus the quota dedup (WIN-01)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revspark.functions.rules import standardize_product
from revspark.operators.topn import top1_desc


def _rename(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    return df.select(*[F.col(src).alias(dst) for src, dst in pairs])


def stg_accounts(raw: DataFrame) -> DataFrame:
    return _rename(raw, [
        ("account", "account_name"), ("sector", "sector"), ("year_established", "year_established"),
        ("revenue", "annual_revenue_usd"), ("employees", "employee_count"),
        ("office_location", "office_location"), ("subsidiary_of", "subsidiary_of")])


def stg_products(raw: DataFrame) -> DataFrame:
    return _rename(raw, [("product", "product_name"), ("series", "product_series"),
                         ("sales_price", "list_price_usd")])


def stg_sales_teams(raw: DataFrame) -> DataFrame:
    return _rename(raw, [("sales_agent", "agent_name"), ("manager", "manager_name"),
                         ("regional_office", "regional_office")])


def stg_sales_pipeline(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("opportunity_id"),
        F.col("sales_agent").alias("agent_name"),
        standardize_product("product").alias("product_name"),
        F.col("account").alias("account_name"),
        F.col("deal_stage"),
        F.col("engage_date"),
        F.col("close_date"),
        F.col("close_value").alias("close_value_usd"),
    )


QUOTA_COLUMNS = ["quota_id", "agent_name", "manager_name", "regional_office", "quota_month",
                 "quota_amount_usd", "quota_type"]


def stg_quotas(raw: DataFrame, keys: tuple[str, ...] = ("quota_id",)) -> DataFrame:
    """Renamed quotas, one row per ``keys``: the highest amount wins (NULL last).

    Remaining ties go to the largest agent_name, then the other columns, all
    descending. ``keys=("quota_id", "agent_name")`` keeps colliding ids of
    different agents apart (opt-in; the default is the modelled rule).
    """
    renamed = _rename(raw, [
        ("quota_id", "quota_id"), ("sales_agent", "agent_name"), ("manager", "manager_name"),
        ("regional_office", "regional_office"), ("quota_month", "quota_month"),
        ("quota_amount_usd", "quota_amount_usd"), ("quota_type", "quota_type")])
    order = ["quota_amount_usd", "agent_name", "manager_name", "regional_office",
             "quota_month", "quota_type"]
    order = [c for c in order if c not in keys]
    return top1_desc(renamed, list(keys), order)


def stg_activities(raw: DataFrame) -> DataFrame:
    return _rename(raw, [
        ("activity_id", "activity_id"), ("opportunity_id", "opportunity_id"),
        ("sales_agent", "agent_name"), ("activity_type", "activity_type"),
        ("activity_date", "activity_date"), ("duration_minutes", "duration_minutes"),
        ("outcome", "outcome")])


def stg_costs(raw: DataFrame) -> DataFrame:
    return _rename(raw, [
        ("product", "product_name"), ("series", "product_series"),
        ("sales_price_usd", "list_price_usd"), ("cogs_usd", "cogs_usd"),
        ("shipping_cost_usd", "shipping_cost_usd"),
        ("support_cost_per_unit_usd", "support_cost_per_unit_usd"),
        ("sales_commission_pct", "sales_commission_pct"), ("gross_margin_pct", "gross_margin_pct")])


def stg_nps_surveys(raw: DataFrame) -> DataFrame:
    return _rename(raw, [
        ("survey_id", "survey_id"), ("account", "account_name"),
        ("survey_sent_date", "survey_sent_date"), ("response_date", "response_date"),
        ("quarter", "survey_quarter"), ("nps_score", "nps_score"), ("nps_category", "nps_category"),
        ("comment", "survey_comment"), ("survey_channel", "survey_channel")])


def stg_support_tickets(raw: DataFrame) -> DataFrame:
    return _rename(raw, [
        ("ticket_id", "ticket_id"), ("account", "account_name"), ("created_date", "created_date"),
        ("resolved_date", "resolved_date"), ("category", "ticket_category"),
        ("priority", "ticket_priority"), ("status", "ticket_status"),
        ("resolution_hours", "resolution_hours"), ("satisfaction_rating", "satisfaction_rating"),
        ("agent_name", "support_agent_name")])


STAGING = {
    "stg_accounts": ("accounts", stg_accounts),
    "stg_products": ("products", stg_products),
    "stg_sales_teams": ("sales_teams", stg_sales_teams),
    "stg_sales_pipeline": ("sales_pipeline", stg_sales_pipeline),
    "stg_quotas": ("quotas", stg_quotas),
    "stg_activities": ("activities", stg_activities),
    "stg_costs": ("costs", stg_costs),
    "stg_nps_surveys": ("nps_surveys", stg_nps_surveys),
    "stg_support_tickets": ("support_tickets", stg_support_tickets),
}
