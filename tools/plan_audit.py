"""Audit physical plans of every registered query for patterns that do not scale.

    python tools/plan_audit.py [sf_dir]

Plans are taken with AQE off and broadcast joins disabled, i.e. as they would be
when every input is beyond the broadcast limit. Reports, per query, the number
of exchanges and any cartesian product, nested-loop join, single-partition
exchange or window without partitioning.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SKIP = {"load_audit", "csv_roundtrip"}   # file-based: they write before planning


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from revspark.queries import QUERIES
    from revspark.session import get_spark
    spark = get_spark("local[8]", shuffle_partitions=8, extra={
        "spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"})
    for name, q in QUERIES.items():
        if name in SKIP:
            continue
        plan = q(spark, sf_dir).select("*")._jdf.queryExecution().executedPlan().toString()
        flags = []
        if "CartesianProduct" in plan:
            flags.append("CARTESIAN")
        if "BroadcastNestedLoopJoin" in plan:
            flags.append("NESTED-LOOP")
        single = len(re.findall(r"Exchange SinglePartition", plan))
        if single:
            flags.append(f"single-partition exchanges={single}")
        # Spark leaves the partition list out when it is empty: the specification starts
        # with the order; such a window takes all its rows in one task
        unpartitioned = len(re.findall(r"windowspecdefinition\([^,()]*#\d+L? (?:ASC|DESC)", plan))
        if unpartitioned:
            flags.append(f"unpartitioned windows={unpartitioned}")
        n_ex = len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition)", plan))
        print(f"{name:24s} exchanges={n_ex:3d} {' '.join(flags)}")
    spark.stop()


if __name__ == "__main__":
    main()
