"""Plan-shape regressions: the properties the scale design relies on."""

from __future__ import annotations

import re
from contextlib import contextmanager

import pytest

import __spark_entry__ as E

from conftest import SF0001
from revspark.queries import QUERIES

LOADS = {"load_audit", "csv_roundtrip", "load_rejects", "load_missing_files", "mart_refresh"}


@contextmanager
def no_broadcast(spark):
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def plan(spark, key):
    # a fresh Dataset on top is planned under the current settings (a model
    # DataFrame shared across queries keeps the physical plan of its first run)
    df = E.queries()[key](spark, SF0001).select("*")
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", [k for k in QUERIES if k not in LOADS])
def test_no_cartesian_or_nested_loop(spark, key):
    with no_broadcast(spark):
        p = plan(spark, key)
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_sales_performance_joins_on_the_aggregate_partitioning(spark):
    with no_broadcast(spark):
        p = plan(spark, "int_sales_performance")
    # the union aggregate's exchange feeds the full join directly: the only
    # exchanges keyed on (agent, month, tag) are the aggregate's and the quotas'
    keyed = re.findall(r"Exchange hashpartitioning\((_q_agent|_agent)#\d+, (_q_month|_month)#\d+, "
                       r"(_q_nullkey|_nullkey)#\d+", p)
    assert len(keyed) == 2
    assert not re.search(r"Exchange hashpartitioning\(_agent#\d+, _month#\d+, \d+\)", p)


def test_won_filter_reaches_the_scan(spark):
    p = plan(spark, "agent_revenue")
    assert "EqualTo(deal_stage,Won)" in p


def test_customer_health_single_shuffle_for_signals(spark):
    with no_broadcast(spark):
        p = plan(spark, "int_customer_health")
    # one exchange keyed on account for the union of surveys, tickets and deals,
    # one for the latest-survey aggregate, one for the account table
    assert len(re.findall(r"Exchange hashpartitioning\(account_name#\d+, \d+\)", p)) == 3


def shuffles(p):
    return sum(1 for line in p.splitlines() if "Exchange " in line
               and "ReusedExchange" not in line and "BroadcastExchange" not in line)


@pytest.mark.parametrize("key,most", [("dq_suite", 4), ("profit_pareto", 4), ("quota_leaderboard", 4), ("stage_mix", 2),
                                      ("rolling_attainment", 2)])
def test_few_exchanges(spark, key, most):
    with no_broadcast(spark):
        p = plan(spark, key)
    assert shuffles(p) <= most, p


def test_no_job_while_a_metric_is_built(spark):
    keys = ("profit_pareto", "quota_leaderboard", "rolling_attainment", "stage_mix", "attainment_matrix")
    for key in keys:        # their stored marts are there from here on
        E.queries()[key](spark, SF0001)
    group = "build-only"
    spark.sparkContext.setJobGroup(group, group)
    for key in keys:
        E.queries()[key](spark, SF0001).explain()
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert not jobs


def test_the_deal_fact_is_read_once(spark):
    for key in ("profit_pareto", "stage_mix"):
        with no_broadcast(spark):
            p = plan(spark, key)
        scans = p.count("FileScan parquet")
        assert scans == 1 or scans - p.count("ReusedExchange") - p.count("Subquery") <= 1, p


@pytest.mark.parametrize("key,column", [("drill_manager", "regional_office"), ("drill_region_quarter", "period_month"),
                                        ("drill_series", "close_month")])
def test_dimensions_prune_directories_at_run_time(spark, key, column):
    p = plan(spark, key)
    scan = p[:p.index("SubqueryAdaptiveBroadcast dynamicpruning")].splitlines()[-2]
    assert re.search(rf"PartitionFilters: \[[^\]]*{column}", scan), p
    if key == "drill_region_quarter":
        assert re.search(r"PartitionFilters: \[[^\]]*regional_office#\d+ = EUROPE", scan), p


def test_numbering_sorts_no_data_in_one_task(spark):
    p = plan(spark, "surrogate_ids")
    single = re.findall(r"Exchange SinglePartition.*\n.*", p)
    assert all("_range" in s or "_range_total" in s for s in single), single
