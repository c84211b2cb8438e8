"""Top-1 row per key (WIN-01, WIN-02).

``row_number() over (partition by k order by o desc) = 1`` expressed as one
aggregation: ``max(struct(order columns..., payload...))`` per key. Struct
comparison is field by field with NULL lowest, so the max is the row with the
largest first order column (NULLs last), ties broken by the following fields.
Being an aggregate it combines map-side before the shuffle: a key holding a
third of all rows still sends one row per map partition, never the whole
group to one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def top1_desc(df: DataFrame, keys: Sequence[str], order: Sequence[str],
              payload: Sequence[str] | None = None) -> DataFrame:
    """Per ``keys``, keep the row that sorts first by ``order`` descending, NULLS LAST.

    ``order`` should end in columns that make the order total (a tie-breaker);
    ``payload`` defaults to all other columns, which then also break remaining
    ties so the result is deterministic. Output columns keep ``df``'s order.
    """
    keys, order = list(keys), list(order)
    if payload is None:
        payload = [c for c in df.columns if c not in keys and c not in order]
    fields = order + [c for c in payload if c not in order]
    best = (df.groupBy(*keys)
              .agg(F.max(F.struct(*[F.col(c) for c in fields])).alias("_best")))
    out = best.select(*keys, *[F.col(f"_best.{c}").alias(c) for c in fields])
    return out.select(*[c for c in df.columns if c in keys or c in fields])
