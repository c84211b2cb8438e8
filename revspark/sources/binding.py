"""Source bindings (SRC-08): raw table name -> DataFrame.

A ``Project`` takes any ``name -> DataFrame`` callable; these are the usual
ones. Each returns a lazy reader, so models prune columns and push filters
into the underlying scan.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from revspark.sources.schemas import RAW_SCHEMAS
from revspark.sources.sinks import current

Source = Callable[[str], DataFrame]


def parquet_source(spark: SparkSession, root: str) -> Source:
    """Raw tables stored as ``root/<name>`` parquet folders (what ``ingest`` writes)."""
    def read(name: str) -> DataFrame:
        return spark.read.schema(RAW_SCHEMAS[name]).parquet(current(spark, os.path.join(root, name)))
    read.root = root  # type: ignore[attr-defined]
    return read


def catalog_source(spark: SparkSession, database: str | None = None) -> Source:
    """Raw tables registered in the session catalog (tables or temp views)."""
    def read(name: str) -> DataFrame:
        return spark.table(f"{database}.{name}" if database else name)
    return read
