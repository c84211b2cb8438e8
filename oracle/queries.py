"""Oracle statements per query key."""

from __future__ import annotations

from oracle.more import SELECTS
from oracle.sql import CTES, statement

MODEL_KEYS = [
    "stg_accounts", "stg_products", "stg_sales_teams", "stg_sales_pipeline", "stg_quotas",
    "stg_activities", "stg_costs", "stg_nps_surveys", "stg_support_tickets",
    "int_deal_economics", "int_sales_performance", "int_customer_health",
    "agent_revenue", "agent_effort", "nps_summary", "latest_nps", "ticket_summary",
    "revenue_summary",
    "dim_accounts", "dim_products", "dim_sales_teams", "fct_sales_pipeline",
    "fct_sales_performance",
]


def oracle_statements() -> dict[str, str]:
    out = {k: statement(k) for k in MODEL_KEYS if k in CTES}
    out.update({k: statement(k, body) for k, body in SELECTS.items()})
    return out
