"""Quota and customer derivations (TG-*) on hand-made inputs."""

from __future__ import annotations

import datetime as dt

import pytest

from revspark.plans import targets as TG

from conftest import rows

D = dt.date
PIPE = "opportunity_id string, agent_name string, account_name string, deal_stage string, " \
       "engage_date date, close_date date, close_value_usd double"


def pipeline(spark, data):
    return spark.createDataFrame(data, PIPE)


def test_agent_baseline_is_mean_of_months_with_wins(spark):
    p = pipeline(spark, [
        ("o1", "ann", "a", "Won", None, D(1998, 1, 5), 100.0),
        ("o2", "ann", "a", "Won", None, D(1998, 1, 9), 50.0),
        ("o3", "ann", "a", "Won", None, D(1998, 3, 1), 30.0),
        ("o4", "ann", "a", "Lost", None, D(1998, 4, 1), 999.0),
        ("o5", None, "a", "Won", None, D(1998, 1, 1), 7.0),      # NULL agent dropped
        ("o6", "bob", "a", "Won", None, None, 7.0)])             # no close date dropped
    assert rows(TG.agent_baseline(p)) == [("ann", 2, 90.0)]


def test_quota_targets_seasonal_default_and_floor(spark):
    teams = spark.createDataFrame([("ann", "m", "west"), ("bob", "m", "east")],
                                  "agent_name string, manager_name string, regional_office string")
    p = pipeline(spark, [("o1", "ann", "a", "Won", None, D(1998, 1, 5), 2000.0)])
    got = {(r.sales_agent, r.quota_month): r for r in TG.quota_targets(teams, p).collect()}
    assert len(got) == 24
    # bob has no wins: default baseline 15000 x 1.15 x seasonal
    assert got[("bob", "1998-01")].quota_amount_usd == pytest.approx(15000 * 1.15 * 0.85)
    assert got[("bob", "1998-11")].quota_amount_usd == pytest.approx(15000 * 1.15 * 1.15)
    # ann's baseline 2000 x 1.15 x seasonal is under the 5000 floor
    assert got[("ann", "1998-07")].quota_amount_usd == 5000.0
    assert got[("ann", "1998-07")].quota_id == "Q-ANN-1998-07"
    assert got[("bob", "1998-04")].quota_type == "revenue"


def test_activity_window_edges(spark):
    p = pipeline(spark, [
        ("o1", "a", "x", "Won", D(2017, 1, 1), D(2017, 1, 11), 1.0),
        ("o2", "a", "x", "Lost", D(2017, 1, 5), D(2017, 1, 5), 1.0),     # end == start -> +1
        ("o3", "a", "x", "Lost", D(2017, 1, 5), D(2017, 1, 1), 1.0),     # end < start -> +1
        ("o4", "a", "x", "Engaging", None, None, None),                  # defaults
        ("o5", "a", "x", "Engaging", D(2017, 2, 1), None, None)])        # open: + open_days
    got = {r.opportunity_id: (r.window_start, r.window_end, r.window_days)
           for r in TG.activity_window(p, open_days=30).collect()}
    assert got["o1"] == (D(2017, 1, 1), D(2017, 1, 11), 10)
    assert got["o2"] == (D(2017, 1, 5), D(2017, 1, 6), 1)
    assert got["o3"] == (D(2017, 1, 5), D(2017, 1, 6), 1)
    assert got["o4"] == (D(2017, 6, 1), D(2017, 7, 1), 30)
    assert got["o5"] == (D(2017, 2, 1), D(2017, 3, 3), 30)


def test_account_engagement_bands(spark):
    accounts = spark.createDataFrame([(f"a{i}",) for i in range(5)], "account_name string")
    counts = {"a1": 5, "a2": 15, "a3": 31, "a4": 60}
    data = [(f"{a}-{i}", "ag", a, "Won", None, D(1998, 1, 1), 10.0)
            for a, n in counts.items() for i in range(n)]
    got = {r.account_name: r for r in TG.account_engagement(accounts, pipeline(spark, data)).collect()}
    assert (got["a0"].won_deals, got["a0"].ticket_band, got["a0"].nps_band) == (0, "none", "none")
    assert (got["a1"].ticket_band, got["a1"].nps_band) == ("low", "low")
    assert (got["a2"].ticket_band, got["a2"].nps_band) == ("medium", "low")
    assert (got["a3"].ticket_band, got["a3"].nps_band) == ("high", "high")
    assert got["a0"].response_propensity == pytest.approx(0.40)
    assert got["a3"].response_propensity == pytest.approx(0.71)
    assert got["a4"].response_propensity == pytest.approx(0.85)   # capped
    assert got["a4"].won_revenue_usd == 600.0


def test_ticket_resolution(spark):
    t = spark.createDataFrame([
        ("t1", "a", D(2017, 1, 1), "resolved", 5.0), ("t2", "a", D(2017, 1, 1), "resolved", 48.0),
        ("t3", "a", D(2017, 1, 1), "resolved", 200.0), ("t4", "a", D(2017, 1, 1), "open", 30.0),
        ("t5", "a", D(2017, 1, 1), "resolved", None)],
        "ticket_id string, account_name string, created_date date, ticket_status string, "
        "resolution_hours double")
    got = {r.ticket_id: (r.derived_resolved_date, r.resolution_band)
           for r in TG.ticket_resolution(t).collect()}
    assert got == {"t1": (D(2017, 1, 1), "fast"), "t2": (D(2017, 1, 3), "standard"),
                   "t3": (D(2017, 1, 9), "slow"), "t4": (None, "standard"), "t5": (None, None)}


def test_unit_costs(spark):
    products = spark.createDataFrame([("p1", "GTX", 1000), ("p2", "MG", 55)],
                                     "product_name string, product_series string, list_price_usd bigint")
    rates = spark.createDataFrame([("p1", 0.45, 0.03, 0.05, 0.08)],
                                  "product_name string, cogs_pct double, shipping_pct double, "
                                  "support_pct double, commission_pct double")
    got = TG.unit_costs(products, rates).collect()
    assert len(got) == 1
    r = got[0]
    assert (r.cogs_usd, r.shipping_cost_usd, r.support_cost_per_unit_usd) == (450.0, 30.0, 50.0)
    assert (r.sales_commission_pct, r.gross_margin_pct) == (0.08, 0.55)


def test_quota_id_collisions_and_dedup(spark):
    """Three-letter ids collide across agents; the id-only dedup keeps the larger
    quota each month, so an agent with a smaller baseline loses every month,
    while keys=("quota_id", "agent_name") keeps both agents."""
    from revspark.plans.staging import stg_quotas
    teams = spark.createDataFrame([("Markita Hansen", "m", "west"), ("Marty Freudenburg", "m", "west"),
                                   ("Carl Lin", "n", "east")],
                                  "agent_name string, manager_name string, regional_office string")
    p = pipeline(spark, [("o1", "Markita Hansen", "a", "Won", None, D(1998, 1, 5), 90000.0),
                         ("o2", "Marty Freudenburg", "a", "Won", None, D(1998, 1, 5), 10000.0)])
    raw = TG.quota_targets(teams, p)
    assert raw.count() == 36 and raw.select("quota_id").distinct().count() == 24
    kept = stg_quotas(raw)
    assert kept.count() == 24
    agents = {r.agent_name for r in kept.collect()}
    assert agents == {"Markita Hansen", "Carl Lin"}           # Marty loses all 12 months
    assert stg_quotas(raw, keys=("quota_id", "agent_name")).count() == 36
