"""Data-quality checks (DQ-01..03) with dbt's semantics.

``unique``: fails for every non-NULL value that occurs more than once.
``not_null``: fails for every row whose value is NULL.
A key may span several columns: it is unique when no whole key (no part NULL) occurs
twice, and not_null fails for every row with a NULL part.
A check passes iff it has zero failing rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RESULT_COLUMNS = ["model", "column_name", "test", "failures", "status"]

#: A tested key: one column or several.
Key = str | tuple[str, ...]


def _columns(key: Key) -> tuple[str, ...]:
    return (key,) if isinstance(key, str) else tuple(key)


def key_name(key: Key) -> str:
    return ", ".join(_columns(key))


def check_unique(df: DataFrame, column: str) -> DataFrame:
    """Failing values of ``unique``: (value, n) for values seen more than once."""
    return (df.select(F.col(column).alias("value"))
              .filter(F.col("value").isNotNull())
              .groupBy("value").agg(F.count(F.lit(1)).alias("n"))
              .filter(F.col("n") > 1))


def check_unique_key(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Failing keys of ``unique`` over several columns: the columns and n."""
    return (df.select(*columns).dropna(subset=list(columns))
              .groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1))


def check_not_null(df: DataFrame, column: str) -> DataFrame:
    """Failing rows of ``not_null``: the rows whose ``column`` is NULL."""
    return df.filter(F.col(column).isNull())


def _value(key: Key) -> Column:
    """The key as text, NULL if any part is: JSON keeps the parts of a composite key apart."""
    parts = [F.col(c).cast("string") for c in _columns(key)]
    if len(parts) == 1:
        return parts[0]
    whole = reduce(lambda a, b: a & b, [p.isNotNull() for p in parts])
    return F.when(whole, F.to_json(F.array(*parts)))


def run_checks(models: dict[str, DataFrame], keys: Sequence[tuple[str, Key]]) -> DataFrame:
    """All key checks as one results DataFrame (model, column_name, test, failures, status).

    Each model is read once: its rows become one row for each tested key, all models' rows
    are stacked, counted per (model, key, value) with map-side combining, and those counts
    give both results of a key (the NULL value's rows fail not_null, values seen more than
    once fail unique). A row of no weight for every key keeps empty models in the result.
    """
    keys = list(keys)
    spark = models[keys[0][0]].sparkSession
    parts = []
    for model in dict.fromkeys(m for m, _ in keys):
        stacked = F.inline(F.array(*[F.struct(F.lit(key_name(k)).alias("column_name"), _value(k).alias("value"))
                                     for m, k in keys if m == model]))
        parts.append(models[model].select(F.lit(model).alias("model"), F.lit(1).cast("bigint").alias("weight"), stacked))
    none = spark.createDataFrame([(m, 0, key_name(k), None) for m, k in keys],
                                 "model string, weight long, column_name string, value string")
    counts = (reduce(DataFrame.unionByName, parts, none)
              .groupBy("model", "column_name", "value").agg(F.sum("weight").alias("n")))
    value, n = F.col("value"), F.col("n")
    totals = counts.groupBy("model", "column_name").agg(
        F.count_if(value.isNotNull() & (n > 1)).alias("unique"),
        F.coalesce(F.sum(F.when(value.isNull(), n)), F.lit(0)).cast("bigint").alias("not_null"))
    rows = totals.select("model", "column_name", F.inline(F.array(
        F.struct(F.lit("unique").alias("test"), F.col("unique").alias("failures")),
        F.struct(F.lit("not_null").alias("test"), F.col("not_null").alias("failures")))))
    return rows.withColumn("status", F.when(F.col("failures") == 0, F.lit("pass")).otherwise(F.lit("fail")))


def key_checks(df: DataFrame, model: str, column: Key) -> DataFrame:
    """``unique`` and ``not_null`` of one key: two result rows."""
    return run_checks({model: df}, [(model, column)])
