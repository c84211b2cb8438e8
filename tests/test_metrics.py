"""Dashboard metrics (DSH-*) on hand-made marts."""

from __future__ import annotations

import datetime as dt

import pytest

from revspark.plans import metrics as DSH

from conftest import rows

D = dt.date
FCT = "opportunity_id string, agent_name string, product_name string, deal_stage string, " \
      "close_date date, close_value_usd double, cogs_usd double, net_profit_usd double, " \
      "days_in_pipeline bigint, is_won boolean"
PERF = "agent_name string, period_month string, regional_office string, quota_amount_usd double, " \
       "total_revenue_usd double, total_effort_minutes bigint, quota_attainment_pct double, " \
       "performance_tier string"


def fct(spark):
    return spark.createDataFrame([
        ("o1", "ann", "p1", "Won", D(1998, 1, 1), 100.0, 40.0, 30.0, 10, True),
        ("o2", "ann", "p1", "Won", D(1998, 2, 1), 300.0, 40.0, 90.0, 20, True),
        ("o3", "bob", "p2", "Won", D(1998, 1, 1), 200.0, 20.0, 80.0, 30, True),
        ("o4", "bob", "p2", "Lost", D(1998, 1, 1), 0.0, 20.0, None, 5, False),
        ("o5", None, "p2", "Engaging", None, None, 20.0, None, None, False)], FCT)


def test_kpi_executive(spark):
    r = DSH.kpi_executive(fct(spark)).first()
    assert (r.total_revenue_usd, r.net_profit_usd, r.total_deals, r.deals_won) == (600.0, 200.0, 5, 3)
    assert r.avg_deal_usd == 200.0            # revenue / won deals, not / all deals
    assert r.win_rate_pct == 60.0 and r.net_margin_pct == 33.33


def test_stage_mix_and_growth(spark):
    mix = {r.deal_stage: (r.deals, r.share_pct) for r in DSH.stage_mix(fct(spark)).collect()}
    assert mix == {"Won": (3, 60.0), "Lost": (1, 20.0), "Engaging": (1, 20.0)}
    g = {(r.product_name, r.revenue_month): (r.prev_revenue_usd, r.mom_growth_pct)
         for r in DSH.product_growth(fct(spark)).collect()}
    assert g[("p1", "1998-02")] == (100.0, 200.0) and g[("p1", "1998-01")] == (None, None)


def test_profit_pareto(spark):
    got = rows(DSH.profit_pareto(fct(spark)))
    assert got == [("p1", 120.0, 120.0, 60.0), ("p2", 80.0, 200.0, 100.0)]


def perf(spark):
    return spark.createDataFrame([
        ("ann", "1998-01", "west", 100.0, 150.0, 60, 150.0, "Star Performer"),
        ("ann", "1998-04", "west", 100.0, 50.0, 0, 50.0, "Underperforming"),
        ("bob", "1998-01", "east", 100.0, 150.0, 120, 150.0, "Star Performer"),
        ("bob", "1998-02", "east", None, 10.0, 0, None, "No Quota"),
        ("cy", "1998-01", "east", 200.0, 100.0, 0, 50.0, "Underperforming")], PERF)


def test_rolling_attainment_fills_gap_months(spark):
    got = {(r.agent_name, r.period_month): (r.revenue_3m_usd, r.quota_3m_usd, r.rolling_attainment_pct)
           for r in DSH.rolling_attainment(perf(spark)).collect()}
    assert got[("ann", "1998-02")] == (150.0, 100.0, 150.0)    # a gap month is present
    assert got[("ann", "1998-03")] == (150.0, 100.0, 150.0)
    assert got[("ann", "1998-04")] == (50.0, 100.0, 50.0)       # January left the window
    assert got[("bob", "1998-02")] == (160.0, 100.0, 160.0)


def test_leaderboard_exceeders_and_rates(spark):
    lb = {(r.period_month, r.agent_name): r.month_rank
          for r in DSH.quota_leaderboard(perf(spark)).collect()}
    assert lb == {("1998-01", "ann"): 1, ("1998-01", "bob"): 1, ("1998-01", "cy"): 3,
                  ("1998-04", "ann"): 1}
    ex = DSH.quota_exceeders(perf(spark)).first()
    assert (ex.agents_above_quota, ex.agents_with_quota) == (2, 3)
    rph = {r.agent_name: r for r in DSH.revenue_per_hour(perf(spark)).collect()}
    assert rph["ann"].revenue_per_hour_usd == 200.0 and rph["cy"].revenue_per_hour_usd is None
    assert rph["bob"].team_revenue_per_hour_usd == pytest.approx(460 / 3, abs=0.005)


def test_accounts_at_risk_is_top_k_by_health(spark):
    acc = spark.createDataFrame(
        [(f"a{i}", "Medium" if i % 2 else "Low", float(i), "SMB", None, 0, 0.0) for i in range(30)],
        "account_name string, churn_risk string, health_score double, account_tier string, "
        "avg_nps_score double, high_priority_tickets bigint, lifetime_revenue_usd double")
    assert DSH.accounts_at_risk(acc).count() >= 3
    got = DSH.accounts_at_risk(acc, k=3).collect()
    assert [r.account_name for r in got] == ["a1", "a3", "a5"]


def test_heatmap_region_source(spark):
    teams = spark.createDataFrame([("ann", "north"), ("bob", "north")],
                                  "agent_name string, regional_office string")
    by_quota = {(r.regional_office, r.period_month): r.avg_attainment_pct
                for r in DSH.attainment_heatmap(perf(spark)).collect()}
    assert by_quota[("east", "1998-01")] == 100.0 and by_quota[("west", "1998-01")] == 150.0
    by_team = {(r.regional_office, r.period_month): (r.agent_months, r.avg_attainment_pct)
               for r in DSH.attainment_heatmap(perf(spark), teams).collect()}
    assert by_team[("north", "1998-01")] == (2, 150.0)
    assert by_team[(None, "1998-01")] == (1, 50.0)


def test_rolling_windows_over_gaps(spark):
    from revspark.plans.metrics import rolling_attainment
    rows = [("a", "2020-01", 10.0, 5.0), ("a", "2020-02", 1.5, None), ("a", "2020-09", 2.0, 4.0), ("a", "9999-12", 7.0, 7.0),
            ("a", "2020-1x", 3.0, 6.0), ("b", "2019-12", None, 1.0), (None, "2020-01", 1.0, 1.0), ("c", None, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "agent_name string, period_month string, total_revenue_usd double, quota_amount_usd double")
    got = {(r.agent_name, r.period_month): (r.revenue_3m_usd, r.quota_3m_usd) for r in rolling_attainment(df).collect()}
    assert got["a", "2020-01"] == (10.0, 5.0) and got["a", "2020-02"] == got["a", "2020-03"] == (11.5, 5.0)
    assert got["a", "2020-04"] == (1.5, 0.0) and got["a", "2020-05"] == got["a", "2020-08"] == (0.0, 0.0)
    assert got["a", "2020-09"] == got["a", "2020-11"] == (2.0, 4.0) and got["a", "2020-12"] == (0.0, 0.0)
    assert got["a", "2020-1x"] == (3.0, 6.0) and got["b", "2019-12"] == (0.0, 1.0)
    assert got["a", "9999-12"] == (7.0, 7.0) and len(got) < 150      # the mistyped month fills no millennia
