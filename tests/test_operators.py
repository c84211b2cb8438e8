"""Reusable operators against brute-force formulations on small fixtures."""

from __future__ import annotations

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from revspark.operators.cumulative import rank_desc, running_total
from revspark.operators.lookup import left_lookup
from revspark.operators.quality import check_not_null, check_unique, key_checks, run_checks
from revspark.operators.spine import month_spine
from revspark.operators.topn import top1_desc

from conftest import rows


def test_top1_matches_row_number_with_hot_key_ties_and_nulls(spark):
    rnd = random.Random(7)
    data = []
    for i in range(3000):
        key = "hot" if i % 3 == 0 else f"k{rnd.randint(0, 200)}"   # a third on one key
        amount = None if i % 17 == 0 else float(rnd.randint(0, 20))  # many ties and NULLs
        data.append((key, amount, f"agent{rnd.randint(0, 30)}", i))
    df = spark.createDataFrame(data, "k string, amount double, agent string, id long").repartition(7)
    got = top1_desc(df, ["k"], ["amount", "agent", "id"])
    w = Window.partitionBy("k").orderBy(F.desc_nulls_last("amount"), F.desc_nulls_last("agent"),
                                        F.desc_nulls_last("id"))
    want = df.withColumn("rn", F.row_number().over(w)).filter("rn = 1").drop("rn")
    assert got.columns == df.columns
    assert rows(got) == rows(want)


def test_top1_all_null_order_keeps_a_row(spark):
    df = spark.createDataFrame([("a", None, "x"), ("a", None, "y")], "k string, o double, p string")
    assert rows(top1_desc(df, ["k"], ["o"])) == [("a", None, "y")]


def test_running_total_matches_global_window(spark):
    rnd = random.Random(3)
    data = [(f"p{i:04d}", rnd.randint(-50, 500)) for i in range(1500)]
    data += [(f"tie{i}", 100) for i in range(40)]  # ties on the value, broken by name
    df = spark.createDataFrame(data, "name string, v long")
    order = [F.desc("v"), F.asc("name")]
    got = running_total(df, order, "v", "cum", ranges=6)
    w = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    want = df.withColumn("cum", F.sum("v").over(w))
    assert rows(got.select("name", "v", "cum")) == rows(want.select("name", "v", "cum"))


def test_key_checks_fail_and_pass(spark):
    bad = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,), ("c",)], "k string")
    good = spark.createDataFrame([("a",), ("b",)], "k string")
    res = {(r.model, r.test): (r.failures, r.status)
           for r in run_checks({"bad": bad, "good": good}, [("bad", "k"), ("good", "k")]).collect()}
    assert res == {("bad", "unique"): (1, "fail"), ("bad", "not_null"): (2, "fail"),
                   ("good", "unique"): (0, "pass"), ("good", "not_null"): (0, "pass")}
    assert rows(check_unique(bad, "k")) == [("a", 2)]
    assert check_not_null(bad, "k").count() == 2
    empty = spark.createDataFrame([], "k string")
    assert {r.test: r.failures for r in key_checks(empty, "e", "k").collect()} == \
        {"unique": 0, "not_null": 0}


def test_left_lookup_defaults(spark):
    fact = spark.createDataFrame([("a",), ("z",), (None,)], "k string")
    dim = spark.createDataFrame([("a", 5)], "k string, v long")
    assert rows(left_lookup(fact, dim, "k", {"v": 0})) == [("a", 5), ("z", 0), (None, 0)]


def test_month_spine(spark):
    df = spark.createDataFrame([("x",)], "a string")
    out = month_spine(df, "1998-11", "1999-02", "m").select(F.date_format("m", "yyyy-MM")).collect()
    assert [r[0] for r in out] == ["1998-11", "1998-12", "1999-01", "1999-02"]


def test_running_total_per_key_with_hot_and_null_keys(spark):
    rnd = random.Random(11)
    data = [("hot" if i % 3 == 0 else (None if i % 29 == 0 else f"k{i % 13}"), f"n{i:05d}",
             rnd.randint(0, 50)) for i in range(2400)]
    df = spark.createDataFrame(data, "k string, name string, v long")
    order = [F.desc("v"), F.asc("name")]
    got = running_total(df, order, "v", "cum", partition_by=["k"], ranges=5)
    w = Window.partitionBy("k").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    want = df.withColumn("cum", F.sum("v").over(w))
    assert rows(got.select("k", "name", "v", "cum")) == rows(want.select("k", "name", "v", "cum"))


def test_rank_desc_matches_window_rank(spark):
    rnd = random.Random(5)
    data = [("m1" if i % 3 == 0 else f"m{i % 7}", f"a{i}", float(rnd.randint(0, 40)) / 2)
            for i in range(1800)]
    data += [(None, "x", 1.0), (None, "y", 1.0), (None, "z", 3.0)]
    df = spark.createDataFrame(data, "m string, a string, v double")
    got = rank_desc(df, ["m"], "v", "r")
    want = df.withColumn("r", F.rank().over(Window.partitionBy("m").orderBy(F.desc("v"))))
    assert got.columns == ["m", "a", "v", "r"]
    assert rows(got) == rows(want.select("m", "a", "v", F.col("r").cast("long")))


def test_grain_over_several_columns(spark):
    from revspark.operators.quality import check_unique_key, run_checks
    schema = "agent string, month string, amount int"
    good = [("a", "1", 1), ("a", "2", 1), ("b", "1", 1), ("a,1", "", 1), ("a", "1,", 1)]
    keys = [("quotas", ("agent", "month")), ("quotas", "agent"), ("none", ("agent", "month"))]
    none = spark.createDataFrame([], schema)

    def fails(rows):
        df = spark.createDataFrame(rows, schema)
        return {(r.model, r.column_name, r.test): r.failures for r in run_checks({"quotas": df, "none": none}, keys).collect()}
    first = fails(good)
    assert first["quotas", "agent, month", "unique"] == 0 and first["quotas", "agent, month", "not_null"] == 0
    assert first["quotas", "agent", "unique"] == 1 and first["none", "agent, month", "unique"] == 0 and len(first) == 6
    doubled = fails(good + [("a", "2", 7), (None, "2", 1), (None, "2", 1), ("c", None, 1)])
    assert doubled["quotas", "agent, month", "unique"] == 1 and doubled["quotas", "agent, month", "not_null"] == 3
    df = spark.createDataFrame(good + [("a", "2", 7), (None, "2", 1), (None, "2", 1)], schema)
    assert [tuple(r) for r in check_unique_key(df, ["agent", "month"]).collect()] == [("a", "2", 2)]


def test_cumulative_share_against_a_sorted_list(spark):
    import random
    from decimal import Decimal
    from revspark.operators.cumulative import cumulative_share
    rng = random.Random(2)
    amounts = [Decimal(rng.choice([0, 1, -1, rng.randrange(-9 ** 9, 9 ** 9), 10 ** 20, 5, 5])) / rng.choice([1, 10, 1000])
               for _ in range(400)]
    rows = [(f"p{i:03d}" if i else None, a) for i, a in enumerate(amounts)]
    df = spark.createDataFrame(rows, "name string, v decimal(38,10)").repartition(5)
    got = {r.name: (r.run, r.total) for r in cumulative_share(df, "v", "name", "run", "total").collect()}
    run = Decimal(0)
    for name, v in sorted(rows, key=lambda r: (-r[1], r[0] is None, r[0])):
        run += v
        assert got[name] == (run, sum(amounts))
    assert cumulative_share(df.limit(0), "v", "name", "run", "total").count() == 0


def test_dense_numbers(spark):
    from pyspark.sql import functions as F
    from revspark.operators.cumulative import dense_number
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"))
    got = sorted((r.k, r.n) for r in dense_number(df, [F.col("k")], "n", ranges=7).collect())
    assert got == [(i, i + 1) for i in range(1000)]


def test_salted_full_join(spark):
    from pyspark.sql import functions as F
    from revspark.operators.fanout import full_join_salted
    one = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3), (None, 4)], "k string, v int")
    many = spark.createDataFrame([("a", "x")] * 40 + [("b", "y"), ("d", "z"), (None, "n")], "m string, w string")
    want = sorted(map(tuple, one.join(many, F.col("k") == F.col("m"), "full").collect()), key=str)
    assert sorted(map(tuple, full_join_salted(one, many, [("k", "m")], 5).collect()), key=str) == want
    # a hot key's rows part, equal ones too: the largest of 8 tasks holds far from all of them
    hot = spark.range(40000).select(F.lit("a").alias("m"), F.lit("same").alias("w"))
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false",
            "spark.sql.shuffle.partitions": "64"}
    old = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        sizes = [r.n for r in full_join_salted(one, hot, [("k", "m")], 16).groupBy(
            F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert sum(sizes) == 40003 and max(sizes) < 12000


def test_amounts_that_cannot_be_told_end_no_run(spark):
    from revspark.functions.numeric import money_sum
    from revspark.functions.rules import net_profit
    df = spark.createDataFrame([("Won", 10.0, 150.0), ("Won", 3e18, 0.1), ("Won", 100.0, 0.1)], "s string, v double, r double")
    from pyspark.sql import functions as F
    got = [r[0] for r in df.select(net_profit("s", "v", F.lit(0.0), F.lit(0.0), F.lit(0.0), "r")).collect()]
    assert got == [None, None, 90.0]
    assert df.agg(money_sum("v")).first()[0] == 3e18 + 110.0
