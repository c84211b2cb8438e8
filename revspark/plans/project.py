"""The model DAG: raw -> staging -> intermediate -> marts.

``Project(source)`` binds a raw-table source (``source(name) -> DataFrame``)
and exposes every model as a lazily built DataFrame; referencing a model twice
gives the same plan object. Nothing runs until an action or a write.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame

from revspark.functions.rules import month_key
from revspark.plans import intermediate as I
from revspark.plans import marts as M
from revspark.plans import staging as S

Source = Callable[[str], DataFrame]


class Project:
    def __init__(self, source: Source, quota_keys: tuple[str, ...] = ("quota_id",),
                 namespace: str | None = None):
        self.source = source
        self.quota_keys = quota_keys
        folder = getattr(source, "sf_dir", None)
        self.namespace = namespace or (f"models/{folder}/{'-'.join(quota_keys)}" if folder
                                       else f"models/{uuid.uuid4().hex}")

    def raw(self, name: str) -> DataFrame:
        return self.source(name)

    # staging
    @cached_property
    def stg_accounts(self) -> DataFrame: return S.stg_accounts(self.raw("accounts"))
    @cached_property
    def stg_products(self) -> DataFrame: return S.stg_products(self.raw("products"))
    @cached_property
    def stg_sales_teams(self) -> DataFrame: return S.stg_sales_teams(self.raw("sales_teams"))
    @cached_property
    def stg_sales_pipeline(self) -> DataFrame: return S.stg_sales_pipeline(self.raw("sales_pipeline"))
    @cached_property
    def stg_quotas(self) -> DataFrame: return S.stg_quotas(self.raw("quotas"), self.quota_keys)
    @cached_property
    def stg_activities(self) -> DataFrame: return S.stg_activities(self.raw("activities"))
    @cached_property
    def stg_costs(self) -> DataFrame: return S.stg_costs(self.raw("costs"))
    @cached_property
    def stg_nps_surveys(self) -> DataFrame: return S.stg_nps_surveys(self.raw("nps_surveys"))
    @cached_property
    def stg_support_tickets(self) -> DataFrame: return S.stg_support_tickets(self.raw("support_tickets"))

    # intermediate
    @cached_property
    def int_deal_economics(self) -> DataFrame:
        return I.int_deal_economics(self.stg_sales_pipeline, self.stg_costs)

    @cached_property
    def int_sales_performance(self) -> DataFrame:
        return I.int_sales_performance(self.int_deal_economics, self.stg_quotas, self.stg_activities)

    @cached_property
    def int_customer_health(self) -> DataFrame:
        return I.int_customer_health(self.stg_accounts, self.stg_nps_surveys,
                                     self.stg_support_tickets, self.int_deal_economics)

    # marts
    @cached_property
    def dim_accounts(self) -> DataFrame: return M.dim_accounts(self.int_customer_health)
    @cached_property
    def dim_products(self) -> DataFrame: return M.dim_products(self.stg_products, self.stg_costs)
    @cached_property
    def dim_sales_teams(self) -> DataFrame: return M.dim_sales_teams(self.stg_sales_teams)
    @cached_property
    def fct_sales_pipeline(self) -> DataFrame: return M.fct_sales_pipeline(self.int_deal_economics)
    @cached_property
    def fct_sales_performance(self) -> DataFrame:
        return M.fct_sales_performance(self.int_sales_performance)

    def model(self, name: str) -> DataFrame:
        return getattr(self, name)

    def stored(self, name: str) -> DataFrame:
        """Model ``name`` as a stored table (how marts are materialised): written
        once per application under the shared checkpoint folder, then read."""
        from revspark.sources.sinks import land_once
        spark = self.model(name).sparkSession
        return land_once(spark, self.namespace, name, lambda: self.model(name))

    # stored copies for drill-downs: the facts in directories of month and region, and the months
    def stored_performance(self) -> DataFrame:
        from revspark.sources.sinks import land_once
        perf = self.stored("fct_sales_performance")
        return land_once(perf.sparkSession, self.namespace, "fct_sales_performance", lambda: perf,
                         ("period_month", "regional_office"))

    def stored_pipeline(self) -> DataFrame:
        from revspark.sources.sinks import land_once
        deals = self.stored("fct_sales_pipeline")
        return land_once(deals.sparkSession, self.namespace, "fct_sales_pipeline", lambda: deals.withColumn(
            "close_month", month_key("close_date")), ("close_month",))

    def stored_months(self) -> DataFrame:
        from revspark.plans.metrics import month_dimension
        from revspark.sources.sinks import land_once
        perf, deals = self.stored("fct_sales_performance"), self.stored("fct_sales_pipeline")
        return land_once(perf.sparkSession, self.namespace, "dim_months", lambda: month_dimension(
            perf.select("period_month"), deals.select(month_key("close_date"))))

    def stored_many(self, names: list[str]) -> dict[str, DataFrame]:
        """``stored`` for several models, written as concurrent jobs."""
        from revspark.sources.sinks import run_concurrently
        tables = run_concurrently([lambda n=n: self.stored(n) for n in names])
        return dict(zip(names, tables))


STAGING_MODELS = list(S.STAGING)
INTERMEDIATE_MODELS = ["int_deal_economics", "int_sales_performance", "int_customer_health"]
MART_MODELS = ["dim_accounts", "dim_products", "dim_sales_teams", "fct_sales_pipeline",
               "fct_sales_performance"]
VIEW_MODELS = STAGING_MODELS + INTERMEDIATE_MODELS
