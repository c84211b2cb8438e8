"""Running totals, numbers and ranks without funnelling a whole group into one task.

``sum(v) over (partition by p order by o rows between unbounded preceding and
current row)`` sorts each partition ``p`` in a single task, and without a
PARTITION BY the whole table. Here the rows are range-partitioned on
(p, o) instead: each range computes its local running sums, and adds, per key
``p``, the totals of the earlier ranges. Only one row per (range, key) is
combined across ranges, so a key holding a third of all rows is still spread
over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revspark.session import checkpoint_dir


def running_total(df: DataFrame, order: Sequence[Column], value: str, out: str,
                  partition_by: Sequence[str] = (), ranges: int | None = None) -> DataFrame:
    """Add ``out`` = running sum of ``value`` per ``partition_by`` in ``order``.

    ``order`` must be total within a key (end it with a unique tie-breaker).
    ``value`` should be exact (integer or decimal) so the result does not
    depend on range boundaries. The range-partitioned input is checkpointed to
    the shared checkpoint folder so both uses see the same ranges, and the
    lineage is cut there.
    """
    spark = df.sparkSession
    checkpoint_dir(spark)
    n = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = list(partition_by)
    ranged = (df.repartitionByRange(n, *[F.col(k).asc_nulls_last() for k in keys], *order)
                .withColumn("_range", F.spark_partition_id())
                .checkpoint(eager=True))
    local_w = (Window.partitionBy("_range", *keys).orderBy(*order)
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = ranged.withColumn("_local", F.sum(value).over(local_w))
    totals = ranged.groupBy("_range", *keys).agg(F.sum(value).alias("_range_total"))
    # one row per (range, key): the prefix over earlier ranges is over a small table
    before_w = (Window.partitionBy(*keys).orderBy("_range")
                .rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select(F.col("_range").alias("_o_range"),
                            *[F.col(k).alias(f"_o_{i}") for i, k in enumerate(keys)],
                            F.sum("_range_total").over(before_w).alias("_offset"))
    cond = [F.col("_range") == F.col("_o_range")] + \
        [F.col(k).eqNullSafe(F.col(f"_o_{i}")) for i, k in enumerate(keys)]
    joined = local.join(offsets, cond, "left")
    return (joined.withColumn(out, F.col("_local") + F.coalesce(F.col("_offset"), F.lit(0)))
                  .drop("_range", "_local", "_offset", "_o_range",
                        *[f"_o_{i}" for i in range(len(keys))]))


def dense_number(df: DataFrame, order: Sequence[Column], out: str, ranges: int | None = None) -> DataFrame:
    """``row_number() over (order by order)`` without a single-task window: rows are dealt to key
    ranges, numbered within them, and each range adds the row counts of those before it.

    ``order`` must be total.
    """
    one = "_one"
    return running_total(df.withColumn(one, F.lit(1).cast("bigint")), order, one, out, ranges=ranges).drop(one)


def rank_desc(df: DataFrame, partition_by: Sequence[str], value: str, out: str) -> DataFrame:
    """``rank() over (partition by p order by value desc)`` for non-NULL ``value``.

    The rank of a row is one plus the number of rows of its key with a larger value. One
    histogram gives them all: rows are counted per (key, value), combined map-side, prefix
    sums run over the histogram (a row for each distinct value, not for each row), and the
    ranks join back on (key, value), a join whose row side AQE can split.
    """
    keys = list(partition_by)
    counts = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    above = (Window.partitionBy(*keys).orderBy(F.col(value).desc())
             .rowsBetween(Window.unboundedPreceding, -1))
    ranks = counts.select(*[F.col(k).alias(f"_r_{i}") for i, k in enumerate(keys)],
                          F.col(value).alias("_r_value"),
                          (F.coalesce(F.sum("_n").over(above), F.lit(0)) + 1).alias(out))
    cond = [F.col(k).eqNullSafe(F.col(f"_r_{i}")) for i, k in enumerate(keys)] + \
        [F.col(value) == F.col("_r_value")]
    return (df.join(ranks, cond, "inner")
              .drop("_r_value", *[f"_r_{i}" for i in range(len(keys))]))


#: Ranges for each doubling of an amount (about 1 % wide), and what bounds their number: a
#: decimal(38,10) has at most 95 doublings above one, on each side of zero.
STEPS = 64
MAX_RANGES = 2 * STEPS * 96 + 1


def cumulative_share(df: DataFrame, value: str, tie: str, running: str, total: str) -> DataFrame:
    """Add the running sum of ``value`` (decimal, not NULL) in descending order, ties by ``tie``
    ascending, and the sum of all.

    Rows are dealt to ranges of the value by a fixed rule (logarithm of the amount), so no
    job has to find borders first. One total for each range gives both the offset of the
    ranges before it and the sum of all; there are at most MAX_RANGES of them, which is why
    they may be broadcast.
    """
    amount = F.col(value).cast("double")
    size = F.floor(F.log2(F.greatest(F.abs(amount), F.lit(1.0))) * STEPS)
    dealt = df.withColumn("_range", (F.signum(amount) * size).cast("int")).repartition("_range")
    local = (Window.partitionBy("_range").orderBy(F.col(value).desc(), F.asc_nulls_last(tie))
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    totals = dealt.groupBy("_range").agg(F.sum(value).alias("_sum"))
    before = Window.orderBy(F.col("_range").desc()).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.col("_range").desc()).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = totals.select(F.col("_range").alias("_of"), F.sum("_sum").over(before).alias("_offset"),
                            F.sum("_sum").over(everything).alias(total))
    out = dealt.withColumn("_local", F.sum(value).over(local))
    return (out.join(F.broadcast(offsets), F.col("_range") == F.col("_of"))
            .withColumn(running, F.col("_local") + F.coalesce(F.col("_offset"), F.lit(0)))
            .drop("_range", "_of", "_local", "_offset"))
