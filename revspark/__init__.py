"""Revenue-operations analytics as PySpark DataFrame jobs.

Layout:
  sources/    raw table schemas, CSV ingestion, sinks, testdata-derived raw tables
  functions/  Column -> Column business rules and exact money arithmetic
  operators/  reusable DataFrame operators (top-1 per key, keyed outer combine,
              lookups with defaults, data-quality checks, month spines)
  plans/      the model DAG: staging, intermediate, marts, metrics, targets, quality
"""

from revspark.session import checkpoint_dir, get_spark

__all__ = ["get_spark", "checkpoint_dir"]
