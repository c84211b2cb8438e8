"""Benchmark: wall time of the raw-table load, every registered query and one full build.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query runs to completion through the no-op sink (all rows produced, none
collected). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    reps = int(os.environ.get("BENCH_REPS", "1"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]

    from revspark.plans.pipeline import run
    from revspark.plans.project import MART_MODELS
    from revspark.queries import QUERIES, project
    from revspark.session import checkpoint_dir, get_spark
    from revspark.sources.schemas import RAW_TABLES

    spark = get_spark(f"local[{cpus}]", app="revspark-bench", shuffle_partitions=2 * cpus,
                      extra={"spark.driver.memory": "16g"})
    scratch = os.path.join(checkpoint_dir(spark), f"bench-{os.getpid()}-{int(time.time())}")

    def timed(fn) -> float:
        runs = []
        for _ in range(reps):
            t0 = time.perf_counter()
            fn()
            runs.append(time.perf_counter() - t0)
        return round(statistics.median(runs), 3)

    # warm-up (JVM, codegen caches) on a plain read, without touching the project
    spark.read.parquet(os.path.join(sf_dir, "region.parquet")).write.format("noop") \
        .mode("overwrite").save()

    times: dict[str, float] = {}
    # landings, each timed on its own (once: later calls find the tables there), so that a
    # query's time is its own: the raw tables, then the marts that metrics read
    if not only:
        p = project(spark, sf_dir)
        for name in RAW_TABLES:
            t0 = time.perf_counter()
            p.source.table(name)
            times[f"land_{name}"] = round(time.perf_counter() - t0, 3)
        for name in MART_MODELS:
            t0 = time.perf_counter()
            p.stored(name)
            times[f"land_{name}"] = round(time.perf_counter() - t0, 3)
    for name, q in QUERIES.items():
        if only and name not in only:
            continue
        times[name] = timed(lambda q=q: q(spark, sf_dir).write.format("noop").mode("overwrite").save())

    if not only or "pipeline" in only:
        n = [0]

        def build():
            n[0] += 1
            run(spark, project(spark, sf_dir), os.path.join(scratch, f"marts{n[0]}"))
        times["pipeline"] = timed(build)

    sf = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf.group(1)) if sf else sf_dir,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
