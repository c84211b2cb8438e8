"""Oracle statements for data quality, dashboard metrics, derivations and loads."""

from __future__ import annotations

from oracle.sql import cte


def rhu(expr: str, n: int) -> str:
    """round half away from zero through decimal, as double."""
    return f"cast(round(cast({expr} as decimal(38,10)), {n}) as double)"


def msum(expr: str) -> str:
    return f"cast(sum(cast({expr} as decimal(28,4))) as double)"


def pct(num: str, den: str, n: int = 2) -> str:
    return f"case when {den} > 0 then {rhu(f'cast({num} as double) / cast({den} as double) * 100', n)} end"


SELECTS: dict[str, str] = {}

# ---------------------------------------------------------------- data quality
TESTED_KEYS = [
    ("stg_accounts", "account_name"), ("stg_products", "product_name"),
    ("stg_sales_teams", "agent_name"), ("stg_sales_pipeline", "opportunity_id"),
    ("stg_quotas", "quota_id"), ("stg_activities", "activity_id"),
    ("stg_costs", "product_name"), ("stg_nps_surveys", "survey_id"),
    ("stg_support_tickets", "ticket_id"), ("int_deal_economics", "opportunity_id"),
    ("int_customer_health", "account_name"), ("dim_accounts", "account_name"),
    ("dim_products", "product_name"), ("dim_sales_teams", "agent_name"),
    ("fct_sales_pipeline", "opportunity_id"),
]


def _dq(model: str, col: str) -> str:
    uniq = (f"select '{model}' as model, '{col}' as column_name, 'unique' as test, "
            f"cast(count(*) as bigint) as failures, "
            f"case when count(*) = 0 then 'pass' else 'fail' end as status "
            f"from (select {col} from {model} where {col} is not null group by {col} "
            f"having count(*) > 1) t")
    nn = (f"select '{model}' as model, '{col}' as column_name, 'not_null' as test, "
          f"cast(count(*) as bigint) as failures, "
          f"case when count(*) = 0 then 'pass' else 'fail' end as status "
          f"from {model} where {col} is null")
    return uniq + "\nunion all\n" + nn


SELECTS["dq_unique"] = ("select quota_id as value, count(*) as n from quotas "
                        "where quota_id is not null group by quota_id having count(*) > 1")
SELECTS["dq_not_null"] = "select * from stg_sales_pipeline where account_name is null"
SELECTS["dq_suite"] = "\nunion all\n".join(_dq(m, c) for m, c in TESTED_KEYS)

# ---------------------------------------------------------------- dashboard metrics
SELECTS["kpi_executive"] = f"""
select total_revenue_usd, net_profit_usd,
  {pct('net_profit_usd', 'total_revenue_usd')} as net_margin_pct,
  total_deals, deals_won,
  case when deals_won > 0 then {rhu('total_revenue_usd / cast(deals_won as double)', 2)} end as avg_deal_usd,
  {pct('deals_won', 'total_deals')} as win_rate_pct
from (select {msum('case when is_won then close_value_usd end')} as total_revenue_usd,
        {msum('net_profit_usd')} as net_profit_usd,
        count(*) as total_deals, cast(count_if(is_won) as bigint) as deals_won
      from fct_sales_pipeline) t"""

SELECTS["revenue_by_product"] = f"""
select product_name, {msum('close_value_usd')} as revenue_usd, count(*) as deals_won
from fct_sales_pipeline where deal_stage = 'Won' group by product_name"""

SELECTS["product_growth"] = f"""
select product_name, revenue_month, revenue_usd, prev_revenue_usd,
  case when prev_revenue_usd > 0
       then {rhu('(revenue_usd - prev_revenue_usd) / prev_revenue_usd * 100', 2)} end as mom_growth_pct
from (select product_name, revenue_month, revenue_usd,
        lag(revenue_usd) over (partition by product_name order by revenue_month) as prev_revenue_usd
      from (select product_name, strftime(close_date, '%Y-%m') as revenue_month,
              {msum('close_value_usd')} as revenue_usd
            from fct_sales_pipeline where deal_stage = 'Won' and close_date is not null
            group by 1, 2) m) t"""

SELECTS["revenue_by_region"] = """
select t.regional_office, cast(sum(a.r) as double) as revenue_usd, cast(sum(a.n) as bigint) as deals_won
from (select agent_name, sum(cast(close_value_usd as decimal(28,4))) as r, count(*) as n
      from fct_sales_pipeline where deal_stage = 'Won' group by agent_name) a
  left join dim_sales_teams t on a.agent_name = t.agent_name
group by t.regional_office"""

SELECTS["stage_mix"] = f"""
select deal_stage, deals, {pct('deals', 'total')} as share_pct
from (select deal_stage, count(*) as deals, (select count(*) from fct_sales_pipeline) as total
      from fct_sales_pipeline group by deal_stage) t"""

SELECTS["avg_attainment"] = f"""
select n as agent_months_with_quota,
  case when n > 0 then {rhu('s / cast(n as double)', 2)} end as avg_attainment_pct
from (select count(quota_attainment_pct) as n,
        cast(sum(cast(quota_attainment_pct as decimal(18,1))) as double) as s
      from fct_sales_performance) t"""

SELECTS["product_pnl"] = f"""
select product_name, revenue_usd, cogs_usd, net_profit_usd, deals_won,
  {pct('net_profit_usd', 'revenue_usd')} as net_margin_pct
from (select product_name, {msum('close_value_usd')} as revenue_usd, {msum('cogs_usd')} as cogs_usd,
        {msum('net_profit_usd')} as net_profit_usd, count(*) as deals_won
      from fct_sales_pipeline where deal_stage = 'Won' group by product_name) t"""

SELECTS["product_win_cycle"] = f"""
select product_name, total_deals, deals_won, {pct('deals_won', 'total_deals')} as win_rate_pct,
  {rhu('won_days', 1)} as avg_won_cycle_days, {rhu('all_days', 1)} as avg_cycle_days
from (select product_name, count(*) as total_deals, cast(count_if(is_won) as bigint) as deals_won,
        avg(case when is_won then days_in_pipeline end) as won_days,
        avg(days_in_pipeline) as all_days
      from fct_sales_pipeline group by product_name) t"""

SELECTS["profit_pareto"] = f"""
select product_name, cast(p as double) as net_profit_usd, cast(cum as double) as cumulative_profit_usd,
  case when tot > 0 then {rhu('cast(cum as double) / cast(tot as double) * 100', 2)} end
    as cumulative_share_pct
from (select product_name, p,
        sum(p) over (order by p desc nulls last, product_name asc nulls last
                     rows between unbounded preceding and current row) as cum,
        sum(p) over () as tot
      from (select product_name, sum(cast(net_profit_usd as decimal(28,4))) as p
            from fct_sales_pipeline where deal_stage = 'Won' group by product_name) x
      where p is not null) y"""

cte("x_agent_effort_revenue", """
select agent_name, sum(cast(total_revenue_usd as decimal(28,4))) as r,
  cast(sum(total_effort_minutes) as bigint) as m
from fct_sales_performance where agent_name is not null group by agent_name""")

cte("x_team_rate", """
select case when sum(m) > 0 then cast(sum(r) as double) / (cast(sum(m) as double) / 60) end as rate
from x_agent_effort_revenue""")

SELECTS["revenue_per_hour"] = f"""
select agent_name, revenue_usd, effort_minutes,
  {rhu('rate', 2)} as revenue_per_hour_usd,
  {rhu('team', 2)} as team_revenue_per_hour_usd,
  case when team > 0 then {rhu('rate / team * 100', 1)} end as vs_team_pct
from (select agent_name, cast(r as double) as revenue_usd, m as effort_minutes,
        case when m > 0 then cast(r as double) / (cast(m as double) / 60) end as rate,
        (select rate from x_team_rate) as team
      from x_agent_effort_revenue) t"""

SELECTS["effort_vs_revenue"] = f"""
select agent_name, m as effort_minutes, cast(r as double) as revenue_usd,
  {rhu('(select corr(cast(m as double), cast(r as double)) from x_agent_effort_revenue)', 6)}
    as corr_effort_revenue
from x_agent_effort_revenue"""

SELECTS["quota_exceeders"] = """
select cast(count_if(b > 100) as bigint) as agents_above_quota, count(*) as agents_with_quota
from (select agent_name, max(quota_attainment_pct) as b from fct_sales_performance
      where agent_name is not null and quota_attainment_pct is not null group by agent_name) t"""

SELECTS["tier_distribution"] = """
select performance_tier, count(*) as agent_months from fct_sales_performance group by performance_tier"""

SELECTS["attainment_heatmap"] = f"""
select regional_office, period_month, count(*) as agent_months,
  {rhu('cast(sum(cast(quota_attainment_pct as decimal(18,1))) as double) / cast(count(*) as double)', 2)}
    as avg_attainment_pct
from fct_sales_performance where quota_attainment_pct is not null
group by regional_office, period_month"""

SELECTS["accounts_at_risk"] = """
select account_name, churn_risk, health_score, account_tier, avg_nps_score, high_priority_tickets,
  lifetime_revenue_usd
from dim_accounts where churn_risk in ('High', 'Medium')
order by health_score asc nulls last, account_name asc nulls last"""

cte("x_perf_keyed", """
select agent_name, period_month, sum(cast(total_revenue_usd as decimal(28,4))) as r,
  sum(cast(quota_amount_usd as decimal(28,4))) as q
from fct_sales_performance where agent_name is not null and period_month is not null
group by agent_name, period_month""")

cte("x_perf_spine", """
select agent_name, strftime(d, '%Y-%m') as period_month
from (select agent_name,
        unnest(generate_series(min(cast(period_month || '-01' as date)), max(cast(period_month || '-01' as date)),
                               interval 1 month)) as d
      from x_perf_keyed where regexp_full_match(period_month, '\\d{4}-\\d{2}') group by agent_name) g
union all
select agent_name, period_month from x_perf_keyed where not regexp_full_match(period_month, '\\d{4}-\\d{2}')""")

SELECTS["rolling_attainment"] = f"""
select agent_name, period_month, cast(r3 as double) as revenue_3m_usd, cast(q3 as double) as quota_3m_usd,
  case when q3 > 0 then {rhu('cast(r3 as double) / cast(q3 as double) * 100', 1)} end
    as rolling_attainment_pct
from (select s.agent_name, s.period_month,
        coalesce(sum(k.r) over w, 0) as r3, coalesce(sum(k.q) over w, 0) as q3
      from x_perf_spine s left join x_perf_keyed k
        on s.agent_name = k.agent_name and s.period_month = k.period_month
      window w as (partition by s.agent_name, case when not regexp_full_match(s.period_month, '\\d{{4}}-\\d{{2}}')
                     then s.period_month end order by s.period_month
                   rows between 2 preceding and current row)) t"""

SELECTS["quota_leaderboard"] = """
select period_month, agent_name, regional_office, quota_attainment_pct, performance_tier,
  rank() over (partition by period_month order by quota_attainment_pct desc) as month_rank
from fct_sales_performance where quota_attainment_pct is not null"""

SELECTS["mart_filter"] = """
select * from fct_sales_performance
where regional_office = 'EUROPE' and period_month between '1998-03' and '1998-06'"""

# ---------------------------------------------------------------- derivations
cte("x_agent_baseline", """
select agent_name, count(*) as months_with_wins,
  cast(sum(r) as double) / cast(count(*) as double) as avg_monthly_revenue_usd
from (select agent_name, strftime(close_date, '%Y-%m') as m,
        coalesce(sum(cast(close_value_usd as decimal(28,4))), 0) as r
      from stg_sales_pipeline
      where deal_stage = 'Won' and agent_name is not null and close_date is not null
      group by 1, 2) t
group by agent_name""")

cte("x_month_spine", """
select agent_name, manager_name, regional_office, strftime(d, '%Y-%m') as quota_month,
  cast(quarter(d) as integer) as quarter
from stg_sales_teams,
  (select unnest(generate_series(date '1998-01-01', date '1998-12-01', interval 1 month)) as d) m""")

SELECTS["agent_baseline"] = "select * from x_agent_baseline"
SELECTS["month_spine"] = "select * from x_month_spine"

SELECTS["quota_targets"] = f"""
select 'Q-' || upper(substr(s.agent_name, 1, 3)) || '-' || s.quota_month as quota_id,
  s.agent_name as sales_agent, s.manager_name as manager, s.regional_office, s.quota_month,
  greatest({rhu('''coalesce(b.avg_monthly_revenue_usd, cast(15000 as double)) * cast(1.15 as double)
     * case s.quarter when 1 then cast(0.85 as double) when 2 then cast(1.0 as double)
                      when 3 then cast(1.05 as double) when 4 then cast(1.15 as double) end''', 2)},
           cast(5000 as double)) as quota_amount_usd,
  'revenue' as quota_type
from x_month_spine s left join x_agent_baseline b on s.agent_name = b.agent_name"""

SELECTS["activity_window"] = """
select opportunity_id, agent_name, deal_stage, ws as window_start, we as window_end,
  date_diff('day', ws, we) as window_days
from (select opportunity_id, agent_name, deal_stage, ws,
        case when e0 <= ws then ws + 1 else e0 end as we
      from (select opportunity_id, agent_name, deal_stage,
              coalesce(engage_date, date '2017-06-01') as ws,
              coalesce(close_date, coalesce(engage_date, date '2017-06-01') + 30) as e0
            from stg_sales_pipeline) a) b"""

cte("x_cost_rates", """
select case when p_partkey = 0 then 'GTX Pro' else 'Part#' || cast(p_partkey as varchar) end as product_name,
  cast(40 + p_partkey % 25 as double) / cast(100 as double) as cogs_pct,
  cast(2 + p_partkey % 4 as double) / cast(100 as double) as shipping_pct,
  cast(3 + p_partkey % 6 as double) / cast(100 as double) as support_pct,
  cast(5 + p_partkey % 8 as double) / cast(100 as double) as commission_pct
from part""")

SELECTS["unit_costs"] = f"""
select p.product_name as product, p.product_series as series, p.list_price_usd as sales_price_usd,
  {rhu('cast(p.list_price_usd as double) * r.cogs_pct', 2)} as cogs_usd,
  {rhu('cast(p.list_price_usd as double) * r.shipping_pct', 2)} as shipping_cost_usd,
  {rhu('cast(p.list_price_usd as double) * r.support_pct', 2)} as support_cost_per_unit_usd,
  {rhu('r.commission_pct', 4)} as sales_commission_pct,
  {rhu('cast(1 as double) - r.cogs_pct', 4)} as gross_margin_pct
from stg_products p join x_cost_rates r on p.product_name = r.product_name"""

SELECTS["account_engagement"] = """
select account_name, won_deals, won_revenue_usd,
  case when won_deals = 0 then 'none' when won_deals < 10 then 'low'
       when won_deals < 30 then 'medium' else 'high' end as ticket_band,
  case when won_deals = 0 then 'none' when won_deals <= 15 then 'low'
       when won_deals <= 30 then 'medium' else 'high' end as nps_band,
  least(cast(85 as double), cast(40 + won_deals * 1 as double)) / cast(100 as double) as response_propensity
from (select a.account_name, cast(coalesce(w.n, 0) as bigint) as won_deals,
        coalesce(w.r, cast(0 as double)) as won_revenue_usd
      from stg_accounts a left join
        (select account_name, count(opportunity_id) as n,
                cast(sum(cast(close_value_usd as decimal(28,4))) as double) as r
         from stg_sales_pipeline where deal_stage = 'Won' and account_name is not null
         group by account_name) w on a.account_name = w.account_name) t"""

SELECTS["nps_category"] = """
select survey_id, account_name, nps_score,
  case when nps_score >= 9 then 'promoter' when nps_score >= 7 then 'passive' else 'detractor' end
    as derived_category,
  nps_category = (case when nps_score >= 9 then 'promoter' when nps_score >= 7 then 'passive'
                       else 'detractor' end) as matches_source
from stg_nps_surveys"""

SELECTS["ticket_resolution"] = """
select ticket_id, account_name, ticket_status, resolution_hours,
  case when ticket_status = 'resolved'
       then created_date + cast(floor(resolution_hours / 24) as integer) end as derived_resolved_date,
  case when resolution_hours < 24 then 'fast' when resolution_hours < 72 then 'standard'
       when resolution_hours is not null then 'slow' end as resolution_band
from stg_support_tickets"""

# ---------------------------------------------------------------- ingestion
LOADS = [("accounts", "crm"), ("products", "product_catalog"), ("sales_teams", "crm"),
         ("sales_pipeline", "crm"), ("quotas", "crm_quotas"), ("activities", "crm_activities"),
         ("costs", "erp"), ("nps_surveys", "survey_tool"), ("support_tickets", "support_platform")]

SELECTS["load_audit"] = "\nunion all\n".join(
    [f"select '{t}' as table_name, '{s}' as source_system, count(*) as \"rows\", 'loaded' as status "
     f"from {t}" for t, s in LOADS]
    + ["select 'TOTAL' as table_name, cast(null as varchar) as source_system, cast("
       + " + ".join(f"(select count(*) from {t})" for t, _ in LOADS)
       + " as bigint) as \"rows\", 'loaded' as status"])

SELECTS["csv_roundtrip"] = "select * from sales_pipeline"

cte("x_tickets", """
select *, cast(regexp_extract(ticket_id, '(\\d+)$', 1) as bigint) as k,
  cast(regexp_extract(ticket_id, '(\\d+)$', 1) as bigint)
    = max(cast(regexp_extract(ticket_id, '(\\d+)$', 1) as bigint)) over () as is_last
from support_tickets""")

_TICKET_FACTS = [
    ("loaded", None, "not is_last and k % 8 <> 1"), ("short", None, "not is_last and k % 8 = 0"),
    ("long", None, "not is_last and k % 8 = 1"), ("broken", None, "is_last"),
    ("lost", "created_date", "not is_last and k % 8 = 2"), ("lost", "resolved_date", "false"),
    ("lost", "resolution_hours", "not is_last and k % 8 = 4"), ("lost", "satisfaction_rating", "false"),
    ("line breaks", "account", "not is_last and k % 8 = 3 and account is not null"),
]

SELECTS["load_rejects"] = "\nunion all\n".join(
    [f"select 'support_tickets' as table_name, '{kind}' as kind, cast({column!r} as varchar) as column_name, "
     .replace("None", "null") + f"cast(count_if({rule}) as bigint) as n from x_tickets"
     for kind, column, rule in _TICKET_FACTS]
    + ["select 'support_tickets', 'distinct ids', 'ticket_id', count(distinct ticket_id) from x_tickets "
       "where not is_last and k % 8 <> 1"])

_LANDED = ("accounts", "quotas", "support_tickets")
SELECTS["load_missing_files"] = "\nunion all\n".join(
    [f"select '{t}' as table_name, '{s}' as source_system, "
     + (f"(select count(*) from {t}) as \"rows\", 'loaded' as status" if t in _LANDED
        else "cast(null as bigint) as \"rows\", 'missing' as status") for t, s in LOADS]
    + ["select 'TOTAL', cast(null as varchar), cast(" + " + ".join(f"(select count(*) from {t})" for t in _LANDED)
       + " as bigint), 'loaded'"])

SELECTS["views_over_marts"] = """
select t.manager_name, count(*) as deals_won, q.quota_rows,
  cast(sum(cast(f.close_value_usd as decimal(28,4))) as double) as revenue_usd
from fct_sales_pipeline f join dim_sales_teams t on f.agent_name = t.agent_name
join (select manager_name, count(*) as quota_rows from stg_quotas group by manager_name) q
  on q.manager_name = t.manager_name
where f.deal_stage = 'Won' group by t.manager_name, q.quota_rows"""

SELECTS["mart_refresh"] = "select * from dim_accounts"

# ---------------------------------------------------------------- keys over several columns
GRAINS = [("fct_sales_performance", ("agent_name", "period_month")), ("fct_sales_pipeline", ("opportunity_id",)),
          ("stg_quotas", ("agent_name", "quota_month")), ("stg_nps_surveys", ("account_name", "response_date"))]


def _grain(model: str, cols: tuple[str, ...]) -> str:
    whole = " and ".join(f"{c} is not null" for c in cols)
    head = f"select '{model}' as model, '{', '.join(cols)}' as column_name, "
    return " union all ".join(
        f"{head}'{test}' as test, cast(n as bigint) as failures, case when n = 0 then 'pass' else 'fail' end as status "
        f"from (select count(*) as n from {source}) t"
        for test, source in (
            ("unique", f"(select 1 from {model} where {whole} group by {', '.join(cols)} having count(*) > 1) d"),
            ("not_null", f"{model} where not ({whole})")))


SELECTS["dq_grain"] = "\nunion all\n".join(_grain(m, c) for m, c in GRAINS)
SELECTS["dq_unique_key"] = """
select sales_agent, manager, count(*) as n from quotas
where sales_agent is not null and manager is not null group by sales_agent, manager having count(*) > 1"""

SELECTS["surrogate_ids"] = "\nunion all\n".join(
    f"select '{t}' as table_name, {key} as source_id, '{prefix}' || printf('%0{width}d', "
    f"row_number() over (order by {parent} nulls last, {day} nulls last, {key} nulls last)) as surrogate_id from {t}"
    for t, prefix, width, parent, day, key in (
        ("activities", "ACT-", 6, "opportunity_id", "activity_date", "activity_id"),
        ("nps_surveys", "NPS-", 5, "account", "survey_sent_date", "survey_id"),
        ("support_tickets", "TKT-", 6, "account", "created_date", "ticket_id")))

# ---------------------------------------------------------------- drill-downs
SELECTS["attainment_heatmap_team"] = f"""
select t.regional_office, p.period_month, count(*) as agent_months,
  {rhu('cast(sum(cast(quota_attainment_pct as decimal(18,1))) as double) / cast(count(*) as double)', 2)}
    as avg_attainment_pct
from fct_sales_performance p left join dim_sales_teams t on t.agent_name = p.agent_name
where p.quota_attainment_pct is not null group by t.regional_office, p.period_month"""

SELECTS["attainment_matrix"] = "select regional_office, " + ", ".join(
    rhu(f"cast(sum(case when period_month = '1998-{m:02d}' then cast(quota_attainment_pct as decimal(18,1)) end) as double)"
        f" / cast(count(case when period_month = '1998-{m:02d}' then 1 end) as double)", 2) + f" as m1998_{m:02d}"
    for m in range(1, 13)) + """
from fct_sales_performance
where quota_attainment_pct is not null and period_month between '1998-01' and '1998-12' group by regional_office"""

SELECTS["drill_manager"] = """
select p.* from fct_sales_performance p join dim_sales_teams t
  on t.agent_name = p.agent_name and t.regional_office = p.regional_office
where t.manager_name = 'NATION_1'"""
SELECTS["drill_region_quarter"] = """
select * from fct_sales_performance
where regional_office = 'EUROPE' and period_month in ('1998-04', '1998-05', '1998-06')"""
SELECTS["drill_series"] = """
select f.*, strftime(f.close_date, '%Y-%m') as close_month from fct_sales_pipeline f
where year(f.close_date) = 1997
  and f.product_name in (select product_name from dim_products where product_series = 'Brand#11')"""

SELECTS["int_sales_performance_salted"] = "select * from int_sales_performance"
