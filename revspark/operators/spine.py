"""Entity x month spines (JN-10, TG-02)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def month_spine(df: DataFrame, start: str, end: str, month_col: str = "month") -> DataFrame:
    """Every row of ``df`` times each first-of-month date from ``start`` to ``end``.

    ``explode(sequence(...))`` runs inside each task: no join, no shuffle.
    ``start``/``end`` are 'YYYY-MM' strings, both included.
    """
    s = _dt.date.fromisoformat(start + "-01")
    e = _dt.date.fromisoformat(end + "-01")
    seq = F.sequence(F.lit(s), F.lit(e), F.expr("interval 1 month"))
    return df.withColumn(month_col, F.explode(seq))
