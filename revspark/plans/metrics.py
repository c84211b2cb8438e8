"""Dashboard metrics over the marts (DSH-01..18).

The dashboards themselves are outside the project; these are the queries
behind their tiles. Formulas follow the published KPI definitions (average
deal size divides by won deals). Ratios are rounded half away from zero;
money is summed in cents. No metric orders all rows in one task: global
shares use an aggregate computed once and shipped as a scalar; running totals
and ranks use ranges and histograms.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revspark.functions.numeric import MONEY, money_sum, round_half_up
from revspark.operators.cumulative import cumulative_share, rank_desc

AT_RISK = ("High", "Medium")
QUOTA_BEAT_PCT = 100
MATRIX_MONTHS = tuple(f"1998-{m:02d}" for m in range(1, 13))


def _ratio_pct(num: Column | str, den: Column | str, scale: int = 2) -> Column:
    n = F.col(num) if isinstance(num, str) else num
    d = F.col(den) if isinstance(den, str) else den
    return F.when(d > 0, round_half_up(n.cast("double") / d.cast("double") * 100, scale))


def _won_value() -> Column:
    return F.when(F.col("is_won"), F.col("close_value_usd"))


# DSH-01
def kpi_executive(fct: DataFrame) -> DataFrame:
    agg = fct.agg(
        money_sum(_won_value()).alias("total_revenue_usd"),
        money_sum("net_profit_usd").alias("net_profit_usd"),
        F.count(F.lit(1)).alias("total_deals"),
        F.count_if("is_won").alias("deals_won"))
    return agg.select(
        "total_revenue_usd", "net_profit_usd",
        _ratio_pct("net_profit_usd", "total_revenue_usd").alias("net_margin_pct"),
        "total_deals", "deals_won",
        F.when(F.col("deals_won") > 0,
               round_half_up(F.col("total_revenue_usd") / F.col("deals_won").cast("double"), 2))
        .alias("avg_deal_usd"),
        _ratio_pct("deals_won", "total_deals").alias("win_rate_pct"))


# DSH-02
def revenue_by_product(fct: DataFrame) -> DataFrame:
    won = fct.filter(F.col("deal_stage") == "Won")
    return (won.groupBy("product_name")
               .agg(money_sum("close_value_usd").alias("revenue_usd"),
                    F.count(F.lit(1)).alias("deals_won"))
               .orderBy(F.desc_nulls_last("revenue_usd"), "product_name"))


# DSH-03
def product_growth(fct: DataFrame) -> DataFrame:
    """Won revenue per product and close month, with change vs. the product's previous month."""
    won = fct.filter((F.col("deal_stage") == "Won") & F.col("close_date").isNotNull())
    monthly = (won.groupBy("product_name", F.date_format("close_date", "yyyy-MM").alias("revenue_month"))
                  .agg(money_sum("close_value_usd").alias("revenue_usd")))
    w = Window.partitionBy("product_name").orderBy("revenue_month")
    prev = F.lag("revenue_usd").over(w)
    return (monthly.withColumn("prev_revenue_usd", prev)
                   .withColumn("mom_growth_pct",
                               F.when(F.col("prev_revenue_usd") > 0,
                                      round_half_up((F.col("revenue_usd") - F.col("prev_revenue_usd"))
                                                    / F.col("prev_revenue_usd") * 100, 2))))


# DSH-04
def revenue_by_region(fct: DataFrame, teams: DataFrame) -> DataFrame:
    """Won revenue per regional office of the deal's agent.

    Deals are first reduced to one row per agent (exact decimal sums), so the
    join to the team table sees agents, not deals.
    """
    won = fct.filter(F.col("deal_stage") == "Won")
    per_agent = won.groupBy("agent_name").agg(
        F.sum(F.col("close_value_usd").cast(MONEY)).alias("_rev"), F.count(F.lit(1)).alias("_n"))
    j = per_agent.join(teams.select("agent_name", "regional_office"), "agent_name", "left")
    return j.groupBy("regional_office").agg(
        F.sum("_rev").cast("double").alias("revenue_usd"),
        F.sum("_n").cast("bigint").alias("deals_won"))


# DSH-05
def stage_mix(fct: DataFrame) -> DataFrame:
    per_stage = fct.groupBy("deal_stage").agg(F.count(F.lit(1)).alias("deals"))
    total = per_stage.select(F.sum("deals")).scalar()   # from the few rows of the stages
    return per_stage.withColumn("share_pct", _ratio_pct(F.col("deals"), total))


def _sum_tenths(c: str) -> Column:
    """Exact sum of a one-decimal percentage."""
    return F.sum(F.col(c).cast("decimal(18,1)")).cast("double")


# DSH-06
def avg_attainment(perf: DataFrame) -> DataFrame:
    return perf.agg(
        F.count("quota_attainment_pct").alias("agent_months_with_quota"),
        _sum_tenths("quota_attainment_pct").alias("_s")).select(
        "agent_months_with_quota",
        F.when(F.col("agent_months_with_quota") > 0,
               round_half_up(F.col("_s") / F.col("agent_months_with_quota").cast("double"), 2))
        .alias("avg_attainment_pct"))


# DSH-07
def product_pnl(fct: DataFrame) -> DataFrame:
    won = fct.filter(F.col("deal_stage") == "Won")
    agg = won.groupBy("product_name").agg(
        money_sum("close_value_usd").alias("revenue_usd"),
        money_sum("cogs_usd").alias("cogs_usd"),
        money_sum("net_profit_usd").alias("net_profit_usd"),
        F.count(F.lit(1)).alias("deals_won"))
    return agg.withColumn("net_margin_pct", _ratio_pct("net_profit_usd", "revenue_usd"))


# DSH-08
def product_win_cycle(fct: DataFrame) -> DataFrame:
    agg = fct.groupBy("product_name").agg(
        F.count(F.lit(1)).alias("total_deals"),
        F.count_if("is_won").alias("deals_won"),
        F.avg(F.when(F.col("is_won"), F.col("days_in_pipeline"))).alias("_won_days"),
        F.avg("days_in_pipeline").alias("_days"))
    return agg.select(
        "product_name", "total_deals", "deals_won",
        _ratio_pct("deals_won", "total_deals").alias("win_rate_pct"),
        round_half_up("_won_days", 1).alias("avg_won_cycle_days"),
        round_half_up("_days", 1).alias("avg_cycle_days"))


# DSH-09
def profit_pareto(fct: DataFrame) -> DataFrame:
    """Products by net profit, descending, with cumulative share of total profit."""
    per_product = (fct.filter(F.col("deal_stage") == "Won")
                      .groupBy("product_name")
                      .agg(F.sum(F.col("net_profit_usd").cast(MONEY)).alias("_profit"))
                      .filter(F.col("_profit").isNotNull()))
    cum = cumulative_share(per_product, "_profit", "product_name", "_cum", "_total")
    share = F.col("_cum").cast("double") / F.col("_total").cast("double") * 100
    return cum.select(
        "product_name",
        F.col("_profit").cast("double").alias("net_profit_usd"),
        F.col("_cum").cast("double").alias("cumulative_profit_usd"),
        F.when(F.col("_total") > 0, round_half_up(share, 2)).alias("cumulative_share_pct"))


def _agent_effort_revenue(perf: DataFrame) -> DataFrame:
    return (perf.filter(F.col("agent_name").isNotNull())
                .groupBy("agent_name")
                .agg(F.sum(F.col("total_revenue_usd").cast(MONEY)).alias("_rev"),
                     F.sum("total_effort_minutes").alias("effort_minutes")))


# DSH-10
def revenue_per_hour(perf: DataFrame) -> DataFrame:
    per_agent = _agent_effort_revenue(perf)
    team = per_agent.agg(F.sum("_rev").cast("double").alias("r"), F.sum("effort_minutes").alias("m"))
    team_rate = team.select(
        F.when(F.col("m") > 0, F.col("r") / (F.col("m").cast("double") / 60))).scalar()
    rate = F.when(F.col("effort_minutes") > 0,
                  F.col("_rev").cast("double") / (F.col("effort_minutes").cast("double") / 60))
    return per_agent.select(
        "agent_name",
        F.col("_rev").cast("double").alias("revenue_usd"),
        "effort_minutes",
        round_half_up(rate, 2).alias("revenue_per_hour_usd"),
        round_half_up(team_rate, 2).alias("team_revenue_per_hour_usd"),
        F.when(team_rate > 0, round_half_up(rate / team_rate * 100, 1)).alias("vs_team_pct"))


# DSH-11
def effort_vs_revenue(perf: DataFrame) -> DataFrame:
    per_agent = _agent_effort_revenue(perf).select(
        "agent_name", "effort_minutes", F.col("_rev").cast("double").alias("revenue_usd"))
    corr = per_agent.select(
        F.corr(F.col("effort_minutes").cast("double"), F.col("revenue_usd"))).scalar()
    return per_agent.withColumn("corr_effort_revenue", round_half_up(corr, 6))


# DSH-12
def quota_exceeders(perf: DataFrame, beat_pct: float = QUOTA_BEAT_PCT) -> DataFrame:
    best = (perf.filter(F.col("agent_name").isNotNull() & F.col("quota_attainment_pct").isNotNull())
                .groupBy("agent_name").agg(F.max("quota_attainment_pct").alias("_best")))
    return best.agg(
        F.count_if(F.col("_best") > beat_pct).alias("agents_above_quota"),
        F.count(F.lit(1)).alias("agents_with_quota"))


# DSH-13
def tier_distribution(perf: DataFrame) -> DataFrame:
    return perf.groupBy("performance_tier").agg(F.count(F.lit(1)).alias("agent_months"))


# DSH-14
def attainment_heatmap(perf: DataFrame, teams: DataFrame | None = None) -> DataFrame:
    """Average attainment by regional office and month.

    The region is the quota row's (the mart's own column) by default; with
    ``teams`` it is the agent's office from the team table instead, which also
    places agents whose quota row was lost to the id dedup.
    """
    rated = perf.filter(F.col("quota_attainment_pct").isNotNull())
    if teams is not None:
        rated = rated.drop("regional_office").join(
            teams.select("agent_name", "regional_office"), "agent_name", "left")
    agg = (rated.groupBy("regional_office", "period_month")
                .agg(F.count(F.lit(1)).alias("agent_months"),
                     _sum_tenths("quota_attainment_pct").alias("_s")))
    return agg.select("regional_office", "period_month", "agent_months",
                      round_half_up(F.col("_s") / F.col("agent_months").cast("double"), 2)
                      .alias("avg_attainment_pct"))


def attainment_matrix(perf: DataFrame, months: Sequence[str] = MATRIX_MONTHS) -> DataFrame:
    """The heatmap as a matrix: a row for each regional office, a column for each of ``months``.

    The months are given, so no job has to look for them first.
    """
    rated = perf.filter(F.col("quota_attainment_pct").isNotNull() & F.col("period_month").isin(*months))
    wide = (rated.groupBy("regional_office").pivot("period_month", list(months))
                 .agg(_sum_tenths("quota_attainment_pct").alias("s"), F.count(F.lit(1)).alias("n")))
    return wide.select("regional_office", *[
        round_half_up(F.col(f"{m}_s") / F.col(f"{m}_n").cast("double"), 2).alias(f"m{m.replace('-', '_')}")
        for m in months])


# DSH-15
def accounts_at_risk(accounts: DataFrame, k: int | None = None) -> DataFrame:
    """All at-risk accounts, lowest health first; with ``k`` only the first k."""
    out = (accounts.filter(F.col("churn_risk").isin(*AT_RISK))
                    .select("account_name", "churn_risk", "health_score", "account_tier",
                            "avg_nps_score", "high_priority_tickets", "lifetime_revenue_usd")
                    .orderBy(F.asc_nulls_last("health_score"), F.asc_nulls_last("account_name")))
    return out if k is None else out.limit(k)


# DSH-16
def rolling_attainment(perf: DataFrame, months: int = 3, longest_gap: int = 120) -> DataFrame:
    """Revenue over quota across each agent's last ``months`` calendar months.

    A month adds its amounts when it comes and takes them back ``months`` later; the running
    sum of these changes is the window's total from one change to the next. Result rows are
    made from the changes: one for each calendar month from an agent's first to its last.
    Between two months of an agent at most ``longest_gap`` empty ones are told after the last
    change, so that a mistyped far month cannot fill the result; a month that is no
    ``yyyy-MM`` is a row by itself, outside every other month's window.
    """
    keyed = (perf.filter(F.col("agent_name").isNotNull() & F.col("period_month").isNotNull())
                 .groupBy("agent_name", "period_month")
                 .agg(F.sum(F.col("total_revenue_usd").cast(MONEY)).alias("_rev"),
                      F.sum(F.col("quota_amount_usd").cast(MONEY)).alias("_quota")))
    first = F.try_to_date(F.concat("period_month", F.lit("-01")), "yyyy-MM-dd")
    number = F.year(first) * 12 + F.month(first) - 1
    zero = F.lit(0).cast("decimal(38,10)")
    dated = keyed.select(
        "agent_name", "period_month",
        F.when(F.col("period_month").rlike(r"^\d{4}-\d{2}$"), number).alias("_n"),
        F.coalesce("_rev", zero).alias("_rev"), F.coalesce("_quota", zero).alias("_quota"))
    # a malformed month is its own series
    series = dated.withColumn("_odd", F.when(F.col("_n").isNull(), F.col("period_month")))
    changes = series.select("agent_name", "_odd", F.inline(F.array(
        F.struct(F.col("_n").alias("_m"), F.lit(True).alias("_own"), F.col("_rev").alias("_rev"), F.col("_quota").alias("_quota")),
        F.struct((F.col("_n") + months).alias("_m"), F.lit(False).alias("_own"), (-F.col("_rev")).alias("_rev"),
                 (-F.col("_quota")).alias("_quota")))))
    changes = changes.where(F.col("_own") | F.col("_m").isNotNull())
    of = Window.partitionBy("agent_name", "_odd")
    until = of.orderBy("_m").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    told = changes.select(
        "agent_name", "_odd", "_m", F.sum("_rev").over(until).alias("_rev"), F.sum("_quota").over(until).alias("_quota"),
        F.lead("_m").over(of.orderBy("_m")).alias("_next"),
        F.max(F.when(F.col("_own"), F.col("_m"))).over(of).alias("_last"))
    # of changes in one month the last stands for all; nothing is told after the agent's last month
    told = told.where(F.col("_m").isNull() | ((F.col("_m") <= F.col("_last")) & (
        F.col("_next").isNull() | (F.col("_next") > F.col("_m")))))
    end = F.least(F.coalesce(F.col("_next") - 1, F.col("_m")), F.col("_last"), F.col("_m") + longest_gap)
    rows = told.withColumn("_month", F.explode(F.when(F.col("_m").isNull(), F.array(F.col("_m")))
                                               .otherwise(F.sequence(F.col("_m"), end))))
    month = F.when(F.col("_m").isNull(), F.col("_odd")).otherwise(F.concat_ws(
        "-", F.lpad(F.floor(F.col("_month") / 12).cast("string"), 4, "0"),
        F.lpad((F.col("_month") % 12 + 1).cast("string"), 2, "0")))
    out = rows.select("agent_name", month.alias("period_month"),
                      F.col("_rev").cast("double").alias("revenue_3m_usd"),
                      F.col("_quota").cast("double").alias("quota_3m_usd"))
    return out.withColumn("rolling_attainment_pct",
                          F.when(F.col("quota_3m_usd") > 0,
                                 round_half_up(F.col("revenue_3m_usd") / F.col("quota_3m_usd") * 100, 1)))


# DSH-17
def quota_leaderboard(perf: DataFrame) -> DataFrame:
    """Agents ranked by attainment within each month (ties share a rank).

    The rank counts better rows through one histogram of (month, attainment), so a month
    with a third of all agent-months is not sorted in one task.
    """
    rated = (perf.filter(F.col("quota_attainment_pct").isNotNull())
                 .select("period_month", "agent_name", "regional_office", "quota_attainment_pct",
                         "performance_tier"))
    ranked = rank_desc(rated, ["period_month"], "quota_attainment_pct", "month_rank")
    return ranked.select("period_month", "agent_name", "regional_office", "quota_attainment_pct",
                         "performance_tier", F.col("month_rank").cast("bigint").alias("month_rank"))


# DSH-18
def drill_down(df: DataFrame, **equals: object) -> DataFrame:
    """Filter a mart on column = value pairs (a dashboard's filter controls)."""
    cond = F.lit(True)
    for col, value in equals.items():
        cond = cond & (F.col(col) == F.lit(value))
    return df.filter(cond)


def drill_dimension(fact: DataFrame, dimension: DataFrame, on: Sequence[str], **equals: object) -> DataFrame:
    """The fact's rows of the dimension members with column = value.

    A semi join: where ``on`` holds a directory column of the stored fact, Spark takes the
    members' values as a filter on the directories at run time (dynamic partition pruning).
    """
    members = drill_down(dimension, **equals).select(*on)
    return fact.join(members, list(on), "left_semi")


def drill_manager(perf: DataFrame, teams: DataFrame, manager: str = "NATION_1") -> DataFrame:
    """A manager's agent-months; the manager's offices prune the fact's regions."""
    return drill_dimension(perf, teams, ["regional_office", "agent_name"], manager_name=manager)


def drill_region_quarter(perf: DataFrame, months: DataFrame, region: str = "EUROPE", year: int = 1998,
                         quarter: int = 2) -> DataFrame:
    """A region's agent-months in a quarter: the region is a static filter on directories, the
    quarter's months prune at run time."""
    return drill_dimension(drill_down(perf, regional_office=region), months, ["period_month"],
                           year=year, quarter=quarter)


def drill_series(fct: DataFrame, products: DataFrame, months: DataFrame, series: str = "Brand#11",
                 year: int = 1997) -> DataFrame:
    """Deals of a product series closed in a year; the year's months prune the deal fact."""
    closed = drill_dimension(fct, months.withColumnRenamed("period_month", "close_month"), ["close_month"], year=year)
    return drill_dimension(closed, products, ["product_name"], product_series=series)


def month_dimension(*months: DataFrame) -> DataFrame:
    """(period_month, year, quarter) of every ``yyyy-MM`` in the given one-column tables."""
    found = reduce(DataFrame.union, months).toDF("period_month").where(
        F.col("period_month").rlike(r"^\d{4}-\d{2}$")).distinct()
    day = F.to_date(F.concat("period_month", F.lit("-01")))
    return found.select("period_month", F.year(day).alias("year"), F.quarter(day).alias("quarter"))


def mart_filter(perf: DataFrame, region: str = "EUROPE", first_month: str = "1998-03",
                last_month: str = "1998-06") -> DataFrame:
    """Example drill-down: one region's agent-months over a month range."""
    return (drill_down(perf, regional_office=region)
            .filter(F.col("period_month").between(first_month, last_month)))
