"""The project's data-test suite: 15 keys x (unique, not_null) = 30 tests."""

from __future__ import annotations

from pyspark.sql import DataFrame

from revspark.operators.quality import run_checks
from revspark.plans.project import Project

# Tested key column per model, in declaration order.
TESTED_KEYS: list[tuple[str, str]] = [
    ("stg_accounts", "account_name"),
    ("stg_products", "product_name"),
    ("stg_sales_teams", "agent_name"),
    ("stg_sales_pipeline", "opportunity_id"),
    ("stg_quotas", "quota_id"),
    ("stg_activities", "activity_id"),
    ("stg_costs", "product_name"),
    ("stg_nps_surveys", "survey_id"),
    ("stg_support_tickets", "ticket_id"),
    ("int_deal_economics", "opportunity_id"),
    ("int_customer_health", "account_name"),
    ("dim_accounts", "account_name"),
    ("dim_products", "product_name"),
    ("dim_sales_teams", "agent_name"),
    ("fct_sales_pipeline", "opportunity_id"),
]


MART_TABLES = {"dim_accounts", "dim_products", "dim_sales_teams", "fct_sales_pipeline",
               "fct_sales_performance"}


#: Grain of the models whose key spans columns, and of each fact.
GRAINS: list[tuple[str, tuple[str, ...]]] = [
    ("fct_sales_performance", ("agent_name", "period_month")),
    ("fct_sales_pipeline", ("opportunity_id",)),
    ("stg_quotas", ("agent_name", "quota_month")),
    ("stg_nps_surveys", ("account_name", "response_date")),
]


def dq_grain(project: Project, models: dict[str, DataFrame] | None = None) -> DataFrame:
    """unique and not_null of each grain; facts are read as stored tables."""
    models = dict(models or {})
    stored = [m for m, _ in GRAINS if m in MART_TABLES and m not in models]
    models.update(project.stored_many(stored))
    for m, _ in GRAINS:
        if m not in models:
            models[m] = project.model(m)
    return run_checks(models, GRAINS)


def dq_suite(project: Project, models: dict[str, DataFrame] | None = None) -> DataFrame:
    """Run all 30 tests; ``models`` may supply already written tables by name.

    Tests of marts and of the two joined models read stored tables (written once, and
    shared with the metric queries), tests of staging views evaluate the view.
    """
    models = dict(models or {})
    stored = [m for m, _ in TESTED_KEYS if (m in MART_TABLES or m.startswith("int_")) and m not in models]
    models.update(project.stored_many(stored))
    for m, _ in TESTED_KEYS:
        if m not in models:
            models[m] = project.model(m)
    return run_checks(models, TESTED_KEYS)
