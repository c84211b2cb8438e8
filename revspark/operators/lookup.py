"""Lookups: left joins against dimension-like tables (JN-01/02/05..09).

No broadcast hint is forced. The static planner broadcasts a side only when
its estimated size is under ``spark.sql.autoBroadcastJoinThreshold`` and AQE
switches a shuffled join to a broadcast one only when the measured size of the
finished shuffle stage is under ``spark.sql.adaptive.autoBroadcastJoinThreshold``;
beyond those limits the join stays sort-merge, and AQE splits skewed
partitions of the preserved side.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def left_lookup(fact: DataFrame, dim: DataFrame, on: str | Sequence[str],
                defaults: Mapping[str, object] | None = None) -> DataFrame:
    """``fact LEFT JOIN dim USING (on)``; unmatched lookups get ``defaults``.

    dict ``.get(k, default)`` semantics: a missing key (or a NULL key, which
    never matches) yields the default; a NULL that the matching row holds stays.
    """
    if not defaults:
        return fact.join(dim, on=on, how="left")
    out = fact.join(dim.withColumn("__hit", F.lit(True)), on=on, how="left")
    return out.withColumns({col: F.when(F.col("__hit"), F.col(col)).otherwise(F.lit(default))
                            for col, default in defaults.items()}).drop("__hit")
