"""Intermediate models: deal economics, sales performance, customer health.

Also the named sub-steps (agent_revenue, agent_effort, nps_summary, ...) as
their own functions, since each is a query of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revspark.functions.numeric import money_sum
from revspark.functions import rules as R
from revspark.operators.fanout import full_join_salted
from revspark.operators.lookup import left_lookup
from revspark.operators.topn import top1_desc


# --------------------------------------------------------------------------- deals
DEAL_COLUMNS = [
    "opportunity_id", "agent_name", "product_name", "account_name", "deal_stage", "engage_date",
    "close_date", "close_value_usd", "cogs_usd", "shipping_cost_usd", "support_cost_per_unit_usd",
    "sales_commission_pct", "gross_margin_pct", "net_profit_usd", "days_in_pipeline", "is_won",
    "is_lost"]

COST_COLUMNS = ["product_name", "cogs_usd", "shipping_cost_usd", "support_cost_per_unit_usd",
                "sales_commission_pct", "gross_margin_pct"]


def int_deal_economics(pipeline: DataFrame, costs: DataFrame) -> DataFrame:
    """pipeline LEFT JOIN costs USING (product_name) + profit, cycle time and flags."""
    j = left_lookup(pipeline, costs.select(*COST_COLUMNS), "product_name")
    return j.select(
        *[F.col(c) for c in DEAL_COLUMNS[:13]],
        R.net_profit("deal_stage", "close_value_usd", "cogs_usd", "shipping_cost_usd",
                     "support_cost_per_unit_usd", "sales_commission_pct").alias("net_profit_usd"),
        R.days_between("close_date", "engage_date").alias("days_in_pipeline"),
        R.stage_flag("deal_stage", R.WON_STAGE).alias("is_won"),
        R.stage_flag("deal_stage", R.LOST_STAGE).alias("is_lost"),
    )


def won_deals(deals: DataFrame) -> DataFrame:
    """Won deals, filtered on the stage column itself so the predicate reaches the scan."""
    return deals.filter(F.col("deal_stage") == R.WON_STAGE)


# --------------------------------------------------------------------------- performance
def agent_revenue(deals: DataFrame) -> DataFrame:
    """AGG-01: won deals per agent and close month."""
    return (won_deals(deals)
            .groupBy(F.col("agent_name"), R.month_key("close_date").alias("revenue_month"))
            .agg(F.count(F.lit(1)).alias("deals_won"),
                 money_sum("close_value_usd").alias("total_revenue_usd"),
                 money_sum("net_profit_usd").alias("total_profit_usd"),
                 F.avg("days_in_pipeline").alias("avg_days_in_pipeline")))


def agent_effort(activities: DataFrame, positive: str = R.POSITIVE_OUTCOME) -> DataFrame:
    """AGG-02: activities per agent and month."""
    return (activities
            .groupBy(F.col("agent_name"), R.month_key("activity_date").alias("activity_month"))
            .agg(F.count(F.lit(1)).alias("total_activities"),
                 F.sum("duration_minutes").alias("total_minutes"),
                 F.count_if(F.col("outcome") == positive).alias("positive_outcomes")))


PERFORMANCE_COLUMNS = [
    "agent_name", "period_month", "manager_name", "regional_office", "quota_amount_usd",
    "deals_won", "total_revenue_usd", "total_profit_usd", "avg_days_in_pipeline",
    "total_activities", "total_effort_minutes", "positive_outcomes", "quota_attainment_pct"]


def _keyed(df: DataFrame, agent: str, month, tag: str) -> DataFrame:
    """Add the (agent, month) key and a tag that keeps NULL-keyed rows of each
    input in groups of their own (in the join formulation a NULL key never
    meets a row of another input). The tag is '' for fully keyed rows, so it
    can also be a join key: the aggregate's partitioning on (agent, month, tag)
    then serves the join with the quotas without another shuffle."""
    a, m = F.col(agent), month
    return df.withColumns({
        "_agent": a, "_month": m,
        "_nullkey": F.when(a.isNull() | m.isNull(), F.lit(tag)).otherwise(F.lit("")),
    })


def int_sales_performance(deals: DataFrame, quotas: DataFrame, activities: DataFrame,
                          positive: str = R.POSITIVE_OUTCOME, quota_salts: int = 0) -> DataFrame:
    """Revenue FULL JOIN quotas FULL JOIN effort on (agent, month) (JN-03, JN-04).

    Revenue and effort both aggregate raw rows to (agent, month), so instead of
    two aggregations and a chain of two full joins their rows are unioned and
    aggregated once (one shuffle, combined map-side), then full-joined with the
    quotas. This equals the join chain for any input: revenue and effort have
    at most one row per key, each quota row keeps its own output row (several
    quotas per key fan out exactly as in the join), and NULL-keyed rows stay in
    per-input groups that match nothing.

    With ``quota_salts`` the quotas of one (agent, month) are spread over so many
    tasks, for inputs where a key may hold very many of them.
    """
    null_l, null_d, null_s = F.lit(None).cast("bigint"), F.lit(None).cast("double"), F.lit(None).cast("string")
    rev = _keyed(won_deals(deals), "agent_name", R.month_key("close_date"), "r").select(
        "_agent", "_month", "_nullkey",
        F.lit(1).alias("_r"), F.col("close_value_usd").alias("_value"),
        F.col("net_profit_usd").alias("_profit"), F.col("days_in_pipeline").alias("_days"),
        F.lit(None).cast("int").alias("_e"), null_l.alias("_minutes"), null_s.alias("_outcome"))
    eff = _keyed(activities, "agent_name", R.month_key("activity_date"), "e").select(
        "_agent", "_month", "_nullkey",
        F.lit(None).cast("int").alias("_r"), null_d.alias("_value"), null_d.alias("_profit"),
        null_l.alias("_days"),
        F.lit(1).alias("_e"), F.col("duration_minutes").alias("_minutes"), F.col("outcome").alias("_outcome"))
    re = (rev.unionByName(eff)
          .groupBy("_agent", "_month", "_nullkey")
          .agg(F.count("_r").alias("r_deals"),
               money_sum("_value").alias("r_revenue"),
               money_sum("_profit").alias("r_profit"),
               F.avg("_days").alias("r_days"),
               F.count("_e").alias("e_count"),
               F.sum("_minutes").alias("e_minutes"),
               F.count_if(F.col("_outcome") == positive).alias("e_positive")))
    q = _keyed(quotas, "agent_name", F.col("quota_month"), "q").select(
        F.col("_agent").alias("_q_agent"), F.col("_month").alias("_q_month"),
        F.col("_nullkey").alias("_q_nullkey"),
        "manager_name", "regional_office", "quota_amount_usd")
    # NULL agents or months never match (as in the join chain); keyed rows meet on tag ''
    pairs = [("_agent", "_q_agent"), ("_month", "_q_month"), ("_nullkey", "_q_nullkey")]
    j = full_join_salted(re, q, pairs, quota_salts) if quota_salts else re.join(q, (re._agent == q._q_agent) & (re._month == q._q_month)
                & (re._nullkey == q._q_nullkey), "full")
    zero = F.lit(0)
    return j.select(
        F.coalesce("_agent", "_q_agent").alias("agent_name"),
        F.coalesce("_month", "_q_month").alias("period_month"),
        "manager_name", "regional_office", "quota_amount_usd",
        F.coalesce("r_deals", zero).alias("deals_won"),
        F.coalesce("r_revenue", F.lit(0.0)).alias("total_revenue_usd"),
        F.coalesce("r_profit", F.lit(0.0)).alias("total_profit_usd"),
        F.coalesce("r_days", F.lit(0.0)).alias("avg_days_in_pipeline"),
        F.coalesce("e_count", zero).alias("total_activities"),
        F.coalesce("e_minutes", zero).cast("bigint").alias("total_effort_minutes"),
        F.coalesce("e_positive", zero).alias("positive_outcomes"),
        R.quota_attainment("r_revenue", "quota_amount_usd").alias("quota_attainment_pct"),
    )


# --------------------------------------------------------------------------- customer health
def latest_nps(surveys: DataFrame) -> DataFrame:
    """WIN-02: latest answered survey per account (ties: largest survey_id)."""
    answered = surveys.filter(F.col("response_date").isNotNull())
    top = top1_desc(answered, ["account_name"], ["response_date", "survey_id"],
                    ["nps_score", "nps_category"])
    return top.select("account_name", F.col("nps_score").alias("latest_nps_score"),
                      F.col("nps_category").alias("latest_nps_category"))


def nps_summary(surveys: DataFrame) -> DataFrame:
    """AGG-03 (all surveys, answered or not)."""
    return surveys.groupBy("account_name").agg(
        F.avg("nps_score").alias("avg_nps_score"), F.count(F.lit(1)).alias("total_surveys"))


def ticket_summary(tickets: DataFrame, high: str = R.HIGH_PRIORITY) -> DataFrame:
    """AGG-04. ``high`` is compared case-sensitively, as in the modelled SQL."""
    return tickets.groupBy("account_name").agg(
        F.count(F.lit(1)).alias("total_tickets"),
        F.count_if(F.col("ticket_priority") == high).alias("high_priority_tickets"),
        F.avg("resolution_hours").alias("avg_resolution_hours"),
        F.avg("satisfaction_rating").alias("avg_satisfaction_rating"))


def revenue_summary(deals: DataFrame) -> DataFrame:
    """AGG-05."""
    return deals.groupBy("account_name").agg(
        F.count(F.lit(1)).alias("total_deals"),
        F.count_if("is_won").alias("deals_won"),
        money_sum(F.when(F.col("is_won"), F.col("close_value_usd")).otherwise(F.lit(0.0)))
        .alias("total_revenue_usd"),
        F.max("close_date").alias("last_deal_date"))


HEALTH_COLUMNS = [
    "account_name", "sector", "annual_revenue_usd", "employee_count", "latest_nps_score",
    "latest_nps_category", "avg_nps_score", "total_surveys", "total_tickets",
    "high_priority_tickets", "avg_resolution_hours", "avg_satisfaction_rating", "total_deals",
    "deals_won", "total_revenue_usd", "last_deal_date", "health_score", "churn_risk"]


def account_signals(surveys: DataFrame, tickets: DataFrame, deals: DataFrame,
                    high: str = R.HIGH_PRIORITY) -> DataFrame:
    """AGG-03, AGG-04 and AGG-05 in one aggregation over the union of their rows.

    One shuffle by account instead of three; partial aggregation runs before it,
    so an account holding a third of all rows ships one row per map task. NULL
    accounts never match the account table and are dropped before the shuffle.
    A summary that had no rows for an account stays NULL, as in separate joins.
    """
    d, s, l, b = (F.lit(None).cast(t) for t in ("double", "string", "bigint", "boolean"))
    i = F.lit(None).cast("int")
    sv = surveys.select("account_name", F.lit(1).alias("_s"), F.col("nps_score").alias("_nps"),
                        i.alias("_t"), s.alias("_prio"), d.alias("_hours"), d.alias("_csat"),
                        i.alias("_d"), b.alias("_won"), d.alias("_value"), F.lit(None).cast("date").alias("_close"))
    tk = tickets.select("account_name", i.alias("_s"), l.alias("_nps"),
                        F.lit(1).alias("_t"), F.col("ticket_priority").alias("_prio"),
                        F.col("resolution_hours").alias("_hours"), F.col("satisfaction_rating").alias("_csat"),
                        i.alias("_d"), b.alias("_won"), d.alias("_value"), F.lit(None).cast("date").alias("_close"))
    dl = deals.select("account_name", i.alias("_s"), l.alias("_nps"), i.alias("_t"), s.alias("_prio"),
                      d.alias("_hours"), d.alias("_csat"),
                      F.lit(1).alias("_d"), F.col("is_won").alias("_won"),
                      F.when(F.col("is_won"), F.col("close_value_usd")).otherwise(F.lit(0.0)).alias("_value"),
                      F.col("close_date").alias("_close"))
    u = sv.unionByName(tk).unionByName(dl).filter(F.col("account_name").isNotNull())
    agg = u.groupBy("account_name").agg(
        F.count("_s").alias("_ns"), F.avg("_nps").alias("avg_nps_score"),
        F.count("_t").alias("_nt"),
        F.count_if(F.col("_prio") == high).alias("high_priority_tickets"),
        F.avg("_hours").alias("avg_resolution_hours"),
        F.avg("_csat").alias("avg_satisfaction_rating"),
        F.count("_d").alias("_nd"), F.count_if("_won").alias("deals_won"),
        money_sum("_value").alias("total_revenue_usd"),
        F.max("_close").alias("last_deal_date"))
    has_s, has_t, has_d = F.col("_ns") > 0, F.col("_nt") > 0, F.col("_nd") > 0
    return agg.select(
        "account_name",
        "avg_nps_score",
        F.when(has_s, F.col("_ns")).alias("total_surveys"),
        F.when(has_t, F.col("_nt")).alias("total_tickets"),
        F.when(has_t, F.col("high_priority_tickets")).alias("high_priority_tickets"),
        "avg_resolution_hours", "avg_satisfaction_rating",
        F.when(has_d, F.col("_nd")).alias("total_deals"),
        F.when(has_d, F.col("deals_won")).alias("deals_won"),
        F.when(has_d, F.col("total_revenue_usd")).alias("total_revenue_usd"),
        "last_deal_date")


def int_customer_health(accounts: DataFrame, surveys: DataFrame, tickets: DataFrame,
                        deals: DataFrame, high: str = R.HIGH_PRIORITY) -> DataFrame:
    """accounts LEFT JOIN latest NPS, NPS, ticket and revenue summaries; health and churn."""
    a = accounts.select("account_name", "sector", "annual_revenue_usd", "employee_count")
    j = (a.join(latest_nps(surveys), "account_name", "left")
          .join(account_signals(surveys, tickets, deals, high), "account_name", "left"))
    zero = F.lit(0).cast("bigint")
    out = j.select(
        "account_name", "sector", "annual_revenue_usd", "employee_count",
        "latest_nps_score", "latest_nps_category", "avg_nps_score", "total_surveys",
        F.coalesce("total_tickets", zero).alias("total_tickets"),
        F.coalesce("high_priority_tickets", zero).alias("high_priority_tickets"),
        "avg_resolution_hours", "avg_satisfaction_rating",
        F.coalesce("total_deals", zero).alias("total_deals"),
        F.coalesce("deals_won", zero).alias("deals_won"),
        F.coalesce("total_revenue_usd", F.lit(0.0)).alias("total_revenue_usd"),
        "last_deal_date",
        R.health_score("avg_nps_score", "avg_satisfaction_rating", "high_priority_tickets",
                       "deals_won").alias("health_score"),
        R.churn_risk("avg_nps_score", "high_priority_tickets", "avg_satisfaction_rating")
        .alias("churn_risk"),
    )
    return out
