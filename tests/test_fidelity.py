"""Inputs that the fixtures do not contain: quoting, headers, wide amounts, malformed months."""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import functions as F

from revspark.functions import rules as R
from revspark.functions.numeric import money_sum
from revspark.operators.lookup import left_lookup
from revspark.plans import metrics as DSH
from revspark.plans import targets as TG
from revspark.sources.csv import coerce_date, read_raw
from revspark.sources.schemas import TABLES
from revspark.sources.sinks import export_csv, land_once, write_table

from conftest import rows


def test_survey_text_survives_a_roundtrip(spark, tmp_dir):
    spec = TABLES["nps_surveys"]
    comments = ['He said "great", really', "two\nlines", "back\\slash,", " lead and trail ", "c:\\path a,b\\", " NA "]
    df = spark.createDataFrame(
        [(f"s{i}", "a", None, None, "q", 5, "passive", c, "email") for i, c in enumerate(comments)], spec.schema)
    export_csv(df, os.path.join(tmp_dir, "nps"))
    got = {r.survey_id: (r.comment, r.survey_channel) for r in read_raw(spark, os.path.join(tmp_dir, "nps"), spec).collect()}
    assert got == {f"s{i}": (c, "email") for i, c in enumerate(comments)}


def test_each_file_is_read_by_its_own_header(spark, tmp_dir):
    folder = os.path.join(tmp_dir, "products")
    os.makedirs(folder)
    for name, text in (("a.csv", "product,series,sales_price\nGTX Pro,GTX,10\n"),
                       ("b.csv", "series,extra,product\nMG,x,MG Special\n")):
        with open(os.path.join(folder, name), "w") as f:
            f.write(text)
    assert rows(read_raw(spark, folder, TABLES["products"])) == [("GTX Pro", "GTX", 10), ("MG Special", "MG", None)]


def test_dates_of_many_layouts(spark):
    day = dt.date(2017, 3, 5)
    texts = ["2017-03-05", "2017-03-05T10:11:12", "2017-03-05 10:11:12.5", "2017/03/05", "3/5/2017", "20170305",
             "5 Mar 2017", "March 5, 2017", "2017-03-05T10:11:12.123"]
    df = spark.createDataFrame([(t,) for t in [*texts, "soon", "2017-13-45", None]], "t string")
    assert [r[0] for r in df.select(coerce_date(F.col("t"))).collect()] == [day] * len(texts) + [None] * 3


def test_amounts_are_exact_and_wide(spark):
    tiny = spark.range(1000).select(F.lit(0.004).alias("v"))
    assert tiny.agg(money_sum("v")).first()[0] == 4.0
    deal = spark.createDataFrame([("Won", 1e11, 1.0, 1.0, 1.0, 0.12345), ("Won", 100000.0, 4.0, 3.0, 6.0, 0.12345)],
                                 "s string, v double, c double, h double, u double, r double")
    got = [r[0] for r in deal.select(R.net_profit("s", "v", "c", "h", "u", "r")).collect()]
    assert got == [87654999997.0, 87642.0]


def test_a_null_match_is_no_missing_match(spark):
    fact = spark.createDataFrame([("a",), ("z",)], "k string")
    dim = spark.createDataFrame([("a", None)], "k string, v int")
    assert rows(left_lookup(fact, dim, "k", {"v": 7})) == [("a", None), ("z", 7)]


def test_wins_without_value_give_the_floor(spark):
    teams = spark.createDataFrame([("ann", "m", "west"), ("bob", "m", "west")],
                                  "agent_name string, manager_name string, regional_office string")
    deals = spark.createDataFrame([("ann", "Won", dt.date(1998, 1, 2), None)],
                                  "agent_name string, deal_stage string, close_date date, close_value_usd double")
    got = {r.sales_agent: r.quota_amount_usd for r in TG.quota_targets(teams, deals, "1998-01", "1998-01").collect()}
    assert got == {"ann": 5000.0, "bob": 14662.5}


def test_rolling_attainment_with_gaps_and_a_malformed_month(spark):
    perf = spark.createDataFrame(
        [("a", "2017-11", 10.0, 100.0), ("a", "2018-02", 5.0, 50.0), ("a", "2017/01", 7.0, 70.0), ("b", "2017-12", None, None)],
        "agent_name string, period_month string, total_revenue_usd double, quota_amount_usd double")
    assert rows(DSH.rolling_attainment(perf)) == [
        ("a", "2017-11", 10.0, 100.0, 10.0), ("a", "2017-12", 10.0, 100.0, 10.0), ("a", "2017/01", 7.0, 70.0, 10.0),
        ("a", "2018-01", 10.0, 100.0, 10.0), ("a", "2018-02", 5.0, 50.0, 10.0), ("b", "2017-12", 0.0, 0.0, None)]


def test_landed_folders_do_not_collide(spark):
    one = land_once(spark, "x/y_z", "t", lambda: spark.range(3).toDF("n"))
    two = land_once(spark, "x_y/z", "t", lambda: spark.range(5).toDF("n"))
    assert (one.count(), two.count()) == (3, 5)


def test_partitioned_write_makes_few_files(spark, tmp_dir):
    df = spark.range(0, 4000, 1, 8).select((F.col("id") % 10).alias("m"), "id")
    path = os.path.join(tmp_dir, "t")
    write_table(df, path, ["m"])
    files = [f for _, _, names in os.walk(path) for f in names if f.endswith(".parquet")]
    assert len(files) <= 20
