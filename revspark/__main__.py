"""Command line: the load -> build -> test -> query workflow.

    python -m revspark load  LANDING WAREHOUSE      # CSVs -> typed parquet tables + audit
    python -m revspark build WAREHOUSE MARTS        # 5 marts + the 30 tests (dq_results)
    python -m revspark test  WAREHOUSE MARTS        # re-run the 30 tests on built marts
    python -m revspark query NAME WAREHOUSE MARTS   # any registered query, e.g. kpi_executive

LANDING holds ``raw/*.csv`` and ``generated/*.csv`` as the registry names them;
WAREHOUSE holds one parquet table per raw table; MARTS holds the built marts.
"""

from __future__ import annotations

import argparse
import os
import sys

from pyspark.sql import DataFrame

from revspark.plans.project import MART_MODELS, Project
from revspark.session import get_spark, sizing
from revspark.sources.sinks import current


class BuiltProject(Project):
    """The model DAG over a warehouse, reading marts from a build folder."""

    def __init__(self, warehouse: str, marts: str):
        from revspark.sources.binding import parquet_source
        self._spark = get_spark()
        super().__init__(parquet_source(self._spark, warehouse), namespace=f"models/{warehouse}")
        self.marts = marts

    def stored(self, name: str) -> DataFrame:
        if name in MART_MODELS:  # any URI that Spark reads; a mart that is not built is an error
            folder = current(self._spark, f"{self.marts.rstrip('/')}/{name}")
            return self._spark.read.parquet(folder).select(*self.model(name).columns)
        return super().stored(name)


def size_shuffles(spark, folder: str) -> None:
    """Shuffle partitions for the size of ``folder``, unless the submit has set them."""
    if spark.sparkContext.getConf().get("spark.sql.shuffle.partitions", None):
        return
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    size = fs.getContentSummary(path).getLength() if fs.exists(path) else 0
    for key, value in sizing(size, spark.sparkContext.defaultParallelism).items():
        spark.conf.set(key, value)


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="revspark")
    sub = ap.add_subparsers(dest="cmd", required=True)
    p = sub.add_parser("load")
    p.add_argument("landing")
    p.add_argument("warehouse")
    for name in ("build", "test"):
        p = sub.add_parser(name)
        p.add_argument("warehouse")
        p.add_argument("marts")
    p = sub.add_parser("query")
    p.add_argument("name")
    p.add_argument("warehouse")
    p.add_argument("marts")
    p.add_argument("--rows", type=int, default=50, help="rows to show")
    p.add_argument("--out", help="write the whole result there as Parquet instead")
    args = ap.parse_args(argv)

    spark = get_spark()
    size_shuffles(spark, args.landing if args.cmd == "load" else args.warehouse)
    if args.cmd == "load":
        from revspark.sources.csv import ingest
        ingest(spark, args.landing, args.warehouse).show(truncate=False)
        return 0
    proj = BuiltProject(args.warehouse, args.marts)
    if args.cmd == "build":
        from revspark.plans.pipeline import run
        out = run(spark, proj, args.marts)
        out["dq_results"].show(30, truncate=False)
        return 0 if out["dq_results"].filter("status != 'pass'").isEmpty() else 1
    if args.cmd == "test":
        from revspark.plans.quality import dq_suite
        res = dq_suite(proj)
        res.show(30, truncate=False)
        return 0 if res.filter("status != 'pass'").isEmpty() else 1
    from revspark.queries import query_on
    result = query_on(proj, args.name)
    if args.out:
        result.write.mode("overwrite").parquet(args.out)
    else:
        result.show(args.rows, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
