"""Declared schemas and the registry of the nine raw tables (SRC-04).

Fixed values: the column names, their order and their types are those of the
modelled loader (INTEGER -> bigint, FLOAT -> double, DATE -> date, STRING ->
string), and so are the file names and source-system labels.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

S, L, D, DT = T.StringType(), T.LongType(), T.DoubleType(), T.DateType()


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Raw table schemas.
RAW_SCHEMAS: dict[str, T.StructType] = {
    "accounts": _schema(
        ("account", S), ("sector", S), ("year_established", L), ("revenue", D),
        ("employees", L), ("office_location", S), ("subsidiary_of", S)),
    "products": _schema(("product", S), ("series", S), ("sales_price", L)),
    "sales_teams": _schema(("sales_agent", S), ("manager", S), ("regional_office", S)),
    "sales_pipeline": _schema(
        ("opportunity_id", S), ("sales_agent", S), ("product", S), ("account", S),
        ("deal_stage", S), ("engage_date", DT), ("close_date", DT), ("close_value", D)),
    "quotas": _schema(
        ("quota_id", S), ("sales_agent", S), ("manager", S), ("regional_office", S),
        ("quota_month", S), ("quota_amount_usd", D), ("quota_type", S)),
    "activities": _schema(
        ("activity_id", S), ("opportunity_id", S), ("sales_agent", S), ("activity_type", S),
        ("activity_date", DT), ("duration_minutes", L), ("outcome", S)),
    "costs": _schema(
        ("product", S), ("series", S), ("sales_price_usd", L), ("cogs_usd", D),
        ("shipping_cost_usd", D), ("support_cost_per_unit_usd", D),
        ("sales_commission_pct", D), ("gross_margin_pct", D)),
    "nps_surveys": _schema(
        ("survey_id", S), ("account", S), ("survey_sent_date", DT), ("response_date", DT),
        ("quarter", S), ("nps_score", L), ("nps_category", S), ("comment", S),
        ("survey_channel", S)),
    "support_tickets": _schema(
        ("ticket_id", S), ("account", S), ("created_date", DT), ("resolved_date", DT),
        ("category", S), ("priority", S), ("status", S), ("resolution_hours", D),
        ("satisfaction_rating", D), ("agent_name", S)),
}


@dataclass(frozen=True)
class TableSpec:
    name: str
    file: str          # path relative to the landing root
    source_system: str  # report-only label
    # quoted line breaks are data; each file is then read by one task, so large exports
    # should be landed as a folder of many files
    multi_line: bool = True

    @property
    def schema(self) -> T.StructType:
        return RAW_SCHEMAS[self.name]


# Table registry (file, table, source system), in load order.
TABLES: dict[str, TableSpec] = {t.name: t for t in [
    TableSpec("accounts", "raw/accounts.csv", "crm"),
    TableSpec("products", "raw/products.csv", "product_catalog"),
    TableSpec("sales_teams", "raw/sales_teams.csv", "crm"),
    TableSpec("sales_pipeline", "raw/sales_pipeline.csv", "crm"),
    TableSpec("quotas", "generated/quotas.csv", "crm_quotas"),
    TableSpec("activities", "generated/activities.csv", "crm_activities"),
    TableSpec("costs", "generated/costs.csv", "erp"),
    TableSpec("nps_surveys", "generated/nps_surveys.csv", "survey_tool"),
    TableSpec("support_tickets", "generated/support_tickets.csv", "support_platform"),
]}

RAW_TABLES = list(TABLES)
