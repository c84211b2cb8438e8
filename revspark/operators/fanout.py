"""Full joins of one row per key with any number of rows per key (JN-03).

Spark cannot split a hot partition of a full outer join. It can be taken apart, since one
side has at most one row per key: every row of the other side looks its partner up (a left
join, which is salted here), and of the one-row side those without any partner are added
(an anti join with the other side's distinct keys, combined map-side).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def full_join_salted(one: DataFrame, many: DataFrame, keys: Sequence[tuple[str, str]], salts: int) -> DataFrame:
    """``one FULL JOIN many`` on the (column of one, column of many) pairs of ``keys``.

    ``one`` has at most one row per key. The rows of a key of ``many`` are dealt to ``salts``
    tasks by a hash of the whole row and their place in the input (equal rows part as well);
    each row of ``one`` that a salt may ask for is there once per salt. NULL keys match nothing.
    """
    columns = [*one.columns, *many.columns]
    row = F.xxhash64(*[F.col(c) for c in many.columns], F.monotonically_increasing_id())
    left = many.withColumn("_salt", F.pmod(row, F.lit(salts)).cast("int"))
    right = one.withColumn("_of", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    cond = [F.col(a) == F.col(b) for a, b in keys] + [F.col("_salt") == F.col("_of")]
    looked_up = left.join(right, cond, "left").select(*columns)
    known = many.select(*[F.col(b).alias(f"_k{i}") for i, (_, b) in enumerate(keys)]).distinct()
    alone = one.join(known, [F.col(a) == F.col(f"_k{i}") for i, (a, _) in enumerate(keys)], "left_anti")
    none = [F.lit(None).cast(f.dataType).alias(f.name) for f in many.schema.fields]
    return looked_up.unionByName(alone.select(*one.columns, *none))
