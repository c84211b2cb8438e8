"""The two large models against plain Python computations from their rules.

Inputs hit every presence pattern, NULL keys and quota fan-out; some values are
worked out by hand.
"""

from __future__ import annotations

import datetime as dt
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

from revspark.plans import intermediate as I

from conftest import rows

D = dt.date

DEALS = "agent_name string, deal_stage string, close_date date, close_value_usd double, " \
        "net_profit_usd double, days_in_pipeline bigint, is_won boolean, account_name string"
QUOTAS = "agent_name string, quota_month string, manager_name string, regional_office string, " \
         "quota_amount_usd double"
ACTS = "agent_name string, activity_date date, duration_minutes bigint, outcome string"


def deal(agent, month_day, value, stage="Won", account="acct1", profit=None, days=10):
    return (agent, stage, month_day, value, profit if profit is not None else (value or 0) / 2, days,
            stage == "Won", account)


def _half_up(x: float, places: int) -> float:
    unit = Decimal(1).scaleb(-places)
    return float(Decimal(repr(x)).quantize(Decimal("1e-10")).quantize(unit, ROUND_HALF_UP))


def _mean(values):
    values = [v for v in values if v is not None]
    return sum(values) / len(values) if values else None


def _total(values):
    values = [v for v in values if v is not None]
    return float(sum(values)) if values else None


def expected_performance(deals, quotas, acts):
    """Rows of the model from the rules: measures in dictionaries by (agent, month); a
    quota row takes what its key has; keys with a gap never meet another input."""
    month = lambda d: d.strftime("%Y-%m") if d else None
    won, done = defaultdict(list), defaultdict(list)
    for x in deals:
        if x[6]:
            won[x[0], month(x[2])].append(x)
    for x in acts:
        done[x[0], month(x[1])].append(x)

    def measures(w, e):
        return {"deals_won": len(w), "revenue": _total(x[3] for x in w) or 0.0, "profit": _total(x[4] for x in w) or 0.0,
                "days": _mean(x[5] for x in w) or 0.0, "acts": len(e), "minutes": sum(x[2] or 0 for x in e),
                "good": sum(x[3] == "positive" for x in e)}

    def row(key, m, quota=(None, None, None)):
        amount = quota[2]
        pct = _half_up(m["revenue"] / amount * 100, 1) if amount and amount > 0 else None
        return (*key, *quota, m["deals_won"], m["revenue"], m["profit"], m["days"], m["acts"], m["minutes"], m["good"], pct)

    out, asked = [], set()
    for agent, mon, *quota in quotas:
        key, full = (agent, mon), agent is not None and mon is not None
        asked.add(key) if full else None
        out.append(row(key, measures(won.get(key, []) if full else [], done.get(key, []) if full else []), tuple(quota)))
    for key in {*won, *done} - asked:
        if None in key:
            out += [row(key, measures(won[key], []))] if key in won else []
            out += [row(key, measures([], done[key]))] if key in done else []
        else:
            out.append(row(key, measures(won.get(key, []), done.get(key, []))))
    return out


def in_order(values):
    return sorted(values, key=lambda t: tuple((v is None, str(v)) for v in t))


def perf_inputs():
    deals = [
        deal("R", D(2020, 1, 5), 100.0), deal("R", D(2020, 1, 9), 50.25),
        deal("RQ", D(2020, 1, 3), 400.0), deal("RE", D(2020, 1, 3), 10.0),
        deal("RQE", D(2020, 1, 3), 900.0), deal("RQE", D(2020, 2, 3), 5.0),
        deal(None, D(2020, 1, 3), 7.0), deal(None, D(2020, 1, 4), 8.0),   # NULL agent
        deal("R", None, 3.0),                                             # NULL month
        deal("FAN", D(2020, 3, 1), 120.0),
        deal("R", D(2020, 1, 7), 999.0, stage="Lost"),                    # not won
        deal("RQ", D(2020, 1, 3), None),                                  # NULL value
    ]
    quotas = [
        ("Q", "2020-01", "m1", "west", 1000.0), ("RQ", "2020-01", "m1", "west", 500.0),
        ("QE", "2020-01", "m2", "east", 0.0), ("RQE", "2020-01", "m2", "east", 600.0),
        (None, "2020-01", "m3", "north", 10.0), (None, "2020-01", "m3", "north", 10.0),
        ("FAN", "2020-03", "m1", "west", 100.0), ("FAN", "2020-03", "m9", "south", 200.0),
        ("RQE", "2020-02", "m2", "east", None),
    ]
    acts = [
        ("E", D(2020, 1, 2), 30, "positive"), ("RE", D(2020, 1, 2), 15, "neutral"),
        ("QE", D(2020, 1, 2), 5, "positive"), ("RQE", D(2020, 1, 2), 45, "positive"),
        ("RQE", D(2020, 1, 20), 15, "negative"), ("FAN", D(2020, 3, 2), 60, None),
        (None, D(2020, 1, 2), 9, "positive"), ("E", None, 1, "positive"),
    ]
    return deals, quotas, acts


def perf_frames(spark, deals, quotas, acts):
    return (spark.createDataFrame(deals, DEALS), spark.createDataFrame(quotas, QUOTAS),
            spark.createDataFrame(acts, ACTS))


def test_sales_performance_by_the_rules(spark):
    inputs = perf_inputs()
    got = I.int_sales_performance(*perf_frames(spark, *inputs))
    assert got.columns == I.PERFORMANCE_COLUMNS
    assert rows(got) == in_order(expected_performance(*inputs))
    # by hand
    by = {(r.agent_name, r.period_month): r for r in got.collect() if r.agent_name and r.agent_name != "FAN"}
    assert by["RQE", "2020-01"].quota_attainment_pct == 150.0 and by["RQE", "2020-01"].total_effort_minutes == 60
    assert by["RQ", "2020-01"].deals_won == 2 and by["RQ", "2020-01"].total_revenue_usd == 400.0
    assert by["QE", "2020-01"].quota_attainment_pct is None and by["R", "2020-01"].total_revenue_usd == 150.25
    # all seven presence patterns are present, plus fan-out and NULL keys
    agents = {r[0] for r in got.collect()}
    assert {"R", "Q", "E", "RQ", "RE", "QE", "RQE", "FAN", None} <= agents
    fan = [r for r in got.collect() if r.agent_name == "FAN"]
    assert len(fan) == 2 and all(r.total_revenue_usd == 120.0 for r in fan)


def expected_health(accounts, nps, tickets, deals):
    """Rows of the model from the rules, account by account."""
    out = []
    for name, sector, annual, employees in accounts:
        s = [x for x in nps if x[1] == name]
        t = [x for x in tickets if x[0] == name]
        d = [x for x in deals if x[0] == name]
        answered = sorted((x for x in s if x[2] is not None), key=lambda x: (x[2], x[0]))
        score, stars = _mean(x[3] for x in s), _mean(x[3] for x in t)
        urgent, wins = sum(x[1] == "High" for x in t), sum(x[1] for x in d)
        points = ((50 if score is None else score * 10) * 0.4 + (50 if stars is None else stars * 20) * 0.3
                  - 5 * urgent + (15 if wins else 0))
        if score is not None and score <= 3 and urgent >= 2:
            risk = "High"
        elif score is None or score <= 5 or (stars is not None and stars < 3):
            risk = "Medium"
        else:
            risk = "Low"
        out.append((name, sector, annual, employees, *(answered[-1][3:5] if answered else (None, None)),
                    score, len(s) or None, len(t), urgent, _mean(x[2] for x in t), stars, len(d), wins,
                    _total(x[2] for x in d if x[1]) or 0.0,
                    max((x[3] for x in d if x[3] is not None), default=None), _half_up(points, 1), risk))
    return out


def test_customer_health_by_the_rules(spark):
    accounts = (
        [("a1", "tech", 1e9, 10), ("a2", "retail", 5e7, 5), ("a3", None, None, None),
         ("a4", "x", 2e8, 1), ("a5", "y", 1.0, 2)],
        "account_name string, sector string, annual_revenue_usd double, employee_count bigint")
    nps = (
        [("s1", "a1", D(2020, 1, 1), 9, "promoter"), ("s2", "a1", D(2020, 2, 1), 3, "detractor"),
         ("s3", "a1", None, 10, "promoter"), ("s4", "a2", None, 2, "detractor"),
         ("s5", "a4", D(2020, 2, 1), 2, "detractor"), ("s6", "a4", D(2020, 2, 1), 3, "detractor"),
         ("s7", None, D(2020, 2, 1), 1, "detractor")],
        "survey_id string, account_name string, response_date date, nps_score bigint, nps_category string")
    tickets = (
        [("a1", "High", 10.0, 4.0), ("a1", "high", None, None), ("a4", "High", 5.0, 1.0),
         ("a4", "High", 7.0, 2.0), ("a5", "Low", None, None), (None, "High", 1.0, 1.0)],
        "account_name string, ticket_priority string, resolution_hours double, satisfaction_rating double")
    deals = (
        [("a1", True, 100.0, D(2020, 1, 1)), ("a1", False, 0.0, D(2020, 3, 1)),
         ("a2", False, 0.0, None), ("a4", True, None, D(2020, 1, 2)), (None, True, 5.0, None)],
        "account_name string, is_won boolean, close_value_usd double, close_date date")
    inputs = (accounts, nps, tickets, deals)
    got = I.int_customer_health(*(spark.createDataFrame(*x) for x in inputs))
    assert got.columns == I.HEALTH_COLUMNS
    assert rows(got) == in_order(expected_health(*(x[0] for x in inputs)))
    by = {r.account_name: r for r in got.collect()}
    assert by["a4"].churn_risk == "High" and by["a3"].churn_risk == "Medium"
    assert by["a1"].latest_nps_score == 3 and by["a4"].latest_nps_score == 3  # tie: largest id
    assert by["a3"].total_surveys is None and by["a5"].total_tickets == 1


def test_sales_performance_random_inputs(spark):
    import random
    for seed in (1, 2, 3):
        rnd = random.Random(seed)
        agents = [None, "a", "b", "c", "d", "e"]
        def day():
            return None if rnd.random() < 0.1 else D(2020, rnd.randint(1, 4), rnd.randint(1, 28))
        deals = [(rnd.choice(agents), rnd.choice(["Won", "Won", "Lost", None]), day(),
                  rnd.choice([None, float(rnd.randint(0, 500))]), float(rnd.randint(-50, 50)),
                  rnd.randint(-5, 90), None, "x") for _ in range(150)]
        deals = [d[:6] + (d[1] == "Won",) + d[7:] for d in deals]
        quotas = [(rnd.choice(agents), rnd.choice([None, "2020-01", "2020-02", "2020-03", "2020-04"]),
                   "m", "r", rnd.choice([None, 0.0, float(rnd.randint(1, 900))])) for _ in range(40)]
        acts = [(rnd.choice(agents), day(), rnd.randint(0, 60),
                 rnd.choice(["positive", "neutral", None])) for _ in range(150)]
        got = I.int_sales_performance(*perf_frames(spark, deals, quotas, acts))
        assert rows(got) == in_order(expected_performance(deals, quotas, acts)), seed


def test_customer_health_random_inputs(spark):
    import random
    for seed in (4, 5):
        rnd = random.Random(seed)
        names = [None] + [f"a{i}" for i in range(8)]
        accounts = [(f"a{i}", rnd.choice(["s1", None]), float(rnd.randint(0, 9)) * 1e8, i)
                    for i in range(10)]
        nps = [(f"s{i:03d}", rnd.choice(names),
                None if rnd.random() < 0.2 else D(2020, 1, rnd.randint(1, 5)),   # many date ties
                rnd.randint(0, 10), rnd.choice(["promoter", "passive", "detractor"]))
               for i in range(60)]
        tickets = [(rnd.choice(names), rnd.choice(["High", "high", "Low", None]),
                    rnd.choice([None, float(rnd.randint(1, 100))]),
                    rnd.choice([None, float(rnd.randint(1, 5))])) for _ in range(60)]
        deals = [(rnd.choice(names), rnd.choice([True, False]),
                  rnd.choice([None, float(rnd.randint(0, 900))]),
                  rnd.choice([None, D(2020, rnd.randint(1, 12), 1)])) for _ in range(60)]
        a = spark.createDataFrame(accounts, "account_name string, sector string, "
                                            "annual_revenue_usd double, employee_count bigint")
        n = spark.createDataFrame(nps, "survey_id string, account_name string, response_date date, "
                                       "nps_score bigint, nps_category string")
        t = spark.createDataFrame(tickets, "account_name string, ticket_priority string, "
                                           "resolution_hours double, satisfaction_rating double")
        d = spark.createDataFrame(deals, "account_name string, is_won boolean, close_value_usd double, "
                                         "close_date date")
        assert rows(I.int_customer_health(a, n, t, d)) == in_order(
            expected_health(accounts, nps, tickets, deals)), seed
