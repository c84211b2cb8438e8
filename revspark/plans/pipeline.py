"""One full build: the equivalent of ``dbt run`` followed by ``dbt test``.

``int_deal_economics`` feeds three models; it is written once to the output
folder and read back, so the deal join runs once and downstream stages
restart from files (not from lineage) if an executor is lost. The five marts
are then written as full-refresh tables while the tests of the view models
run alongside; the tests of the marts run over the written tables.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from revspark.operators.quality import run_checks
from revspark.plans.project import MART_MODELS, Project
from revspark.plans.quality import MART_TABLES, TESTED_KEYS
from revspark.sources.sinks import publish, run_concurrently, write_marts


# The performance fact is written in month directories: dashboard filters on
# months read only the matching files.
MART_PARTITIONS = {"fct_sales_performance": ["period_month"]}


def run(spark: SparkSession, project: Project, out_root: str,
        partitions: dict[str, list[str]] | None = None) -> dict[str, DataFrame]:
    """Build every mart under ``out_root``; returns readers of the written tables
    plus ``dq_results``."""
    deals_path = os.path.join(out_root, "int_deal_economics")
    deals = publish(project.int_deal_economics, deals_path)
    # a fresh DAG over the same source whose deal model is the written table
    project = Project(project.source, project.quota_keys)
    project.__dict__["int_deal_economics"] = spark.read.parquet(deals)

    view_keys = [(m, c) for m, c in TESTED_KEYS if m not in MART_TABLES]
    mart_keys = [(m, c) for m, c in TESTED_KEYS if m in MART_TABLES]
    view_results = os.path.join(out_root, "_dq_views")

    def build_marts() -> dict[str, DataFrame]:
        return write_marts(spark, {m: project.model(m) for m in MART_MODELS}, out_root,
                           partitions=MART_PARTITIONS if partitions is None else partitions)

    def test_views() -> str:
        views = {m: project.model(m) for m, _ in view_keys}
        return publish(run_checks(views, view_keys), view_results)

    written, tested = run_concurrently([build_marts, test_views], threads=2)
    written["int_deal_economics"] = project.int_deal_economics

    dq_path = os.path.join(out_root, "dq_results")
    results = spark.read.parquet(tested).unionByName(run_checks(written, mart_keys))
    written["dq_results"] = spark.read.parquet(publish(results, dq_path))
    return written
