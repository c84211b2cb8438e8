"""CSV ingestion: declared schemas, missing tokens, lenient dates, missing files, audit."""

from __future__ import annotations

import datetime as dt
import os

from revspark.sources.csv import ingest, read_raw
from revspark.sources.schemas import RAW_SCHEMAS, TABLES, TableSpec
from revspark.sources.sinks import current

PIPELINE_CSV = """opportunity_id,sales_agent,product,account,deal_stage,engage_date,close_date,close_value
OPP1,Ann,GTXPro,Acme,Won,2017-01-02,2017-02-03,1054.5
OPP2,Bob,MG Special,NA,Lost,not a date,2017-02-30,0
OPP3,,GTK 500,null,Engaging,2017/03/04,,
OPP4,Cid,GTX Basic,N/A,Prospecting,3/5/2017,NaN,NaN
"""


def write(path: str, text: str) -> None:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_read_raw_types_tokens_and_dates(spark, tmp_dir):
    path = os.path.join(tmp_dir, "raw", "sales_pipeline.csv")
    write(path, PIPELINE_CSV)
    df = read_raw(spark, path, TABLES["sales_pipeline"])
    assert df.schema == RAW_SCHEMAS["sales_pipeline"]
    got = {r.opportunity_id: r for r in df.collect()}
    assert got["OPP1"].engage_date == dt.date(2017, 1, 2) and got["OPP1"].close_value == 1054.5
    assert got["OPP2"].account is None            # 'NA' token
    assert got["OPP2"].engage_date is None        # unparseable -> NULL
    assert got["OPP2"].close_date is None         # impossible date -> NULL
    assert got["OPP3"].sales_agent is None and got["OPP3"].account is None
    assert got["OPP3"].engage_date == dt.date(2017, 3, 4)
    assert got["OPP3"].close_value is None
    assert got["OPP4"].engage_date == dt.date(2017, 3, 5)
    assert got["OPP4"].close_value is None        # 'NaN' is missing, never a NaN double


def test_ingest_audit_and_missing_files(spark, tmp_dir):
    landing, wh = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "wh")
    write(os.path.join(landing, "raw", "sales_pipeline.csv"), PIPELINE_CSV)
    write(os.path.join(landing, "raw", "products.csv"),
          "product,series,sales_price\nGTX Pro,GTX,4821\nMG Special,MG,55.0\n")
    audit = {r.table_name: (r.rows, r.status) for r in ingest(spark, landing, wh).collect()}
    assert audit["sales_pipeline"] == (4, "loaded")
    assert audit["products"] == (2, "loaded")
    assert audit["accounts"] == (None, "missing")
    assert audit["TOTAL"] == (6, "loaded")
    prod = spark.read.parquet(current(spark, os.path.join(wh, "products")))
    assert sorted(r.sales_price for r in prod.collect()) == [55, 4821]


def test_header_matching_by_name(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t.csv")
    write(path, "series,extra,product\nGTX,1,GTX Pro\n")
    df = read_raw(spark, path, TableSpec("products", "t.csv", "x"))
    assert [tuple(r) for r in df.collect()] == [("GTX Pro", "GTX", None)]


def test_source_bindings(spark, tmp_dir):
    from revspark.plans.project import Project
    from revspark.sources.binding import catalog_source, parquet_source
    landing, wh = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "wh")
    write(os.path.join(landing, "raw", "products.csv"),
          "product,series,sales_price\nGTX Pro,GTX,4821\nMG Special,MG,55\n")
    ingest(spark, landing, wh)
    p = Project(parquet_source(spark, wh))
    assert sorted(r.product_name for r in p.stg_products.collect()) == ["GTX Pro", "MG Special"]
    p.stg_products.createOrReplaceTempView("products")
    assert catalog_source(spark)("products").count() == 2


def test_land_once_under_concurrent_callers(spark):
    from revspark.sources.sinks import land_once, run_concurrently
    calls = []

    def build():
        calls.append(1)
        return spark.range(1000).withColumnRenamed("id", "k")

    ns = f"test/{os.getpid()}/{id(calls)}"
    readers = run_concurrently([lambda: land_once(spark, ns, "t", build) for _ in range(6)], threads=6)
    assert len(calls) == 1                       # built and written once
    assert all(r.count() == 1000 for r in readers)
    assert land_once(spark, ns, "t", build).agg({"k": "sum"}).first()[0] == sum(range(1000))
    assert len(calls) == 1


def test_records_of_another_width(spark, tmp_dir):
    from revspark.sources.csv import load_report, rejected
    landing, wh = os.path.join(tmp_dir, "a landing"), os.path.join(tmp_dir, "wh")
    folder = os.path.join(landing, "generated", "support_tickets.csv")
    head = "ticket_id,account,created_date,resolved_date,category,priority,status,resolution_hours,satisfaction_rating,agent_name\n"
    write(os.path.join(folder, "a.csv"), head
          + 'T1,"Acme\nInc, ""x""",2017-01-02,,bug,high,open,1.5,4,Ann\n'
          + "T2,Acme,2017-01-02\n"                                        # short: loaded
          + "T3,Acme,2017-01-02,,bug,high,open,1.5,4,Ann,more\n"          # long: set aside
          + "T4,Acme,whenever,2017-01-05,bug,high,open,soon,4,Ann,\n"     # long by an empty field
          + "T5,Acme,whenever,2017-01-05,bug,high,open,soon,4,Ann\n")
    write(os.path.join(folder, "b.csv"), "account,ticket_id\nAcme,T6\nNone,T7\n")
    write(os.path.join(folder, "c.csv"), head + 'T8,"never closed,2017-01-02,,bug,high,open,1.5,4,Ann\nT9,x,,,,,,,,\n')
    write(os.path.join(folder, "d.csv"), "")
    spec = TABLES["support_tickets"]
    got = {r.ticket_id: r for r in read_raw(spark, folder, spec).collect()}
    assert sorted(got) == ["T1", "T2", "T5", "T6", "T7"]
    assert got["T1"].account == 'Acme\nInc, "x"' and got["T2"].category is None and got["T7"].account is None
    assert got["T5"].created_date is None and got["T5"].resolution_hours is None
    aside = sorted((r.reason, r.record[:2]) for r in rejected(spark, folder, spec).collect())
    assert aside == [("broken", "T8"), ("long", "T3"), ("long", "T4"), ("short", "T2")]
    ingest(spark, landing, wh, {"support_tickets": spec})
    report = {(r.kind, r.column_name): r.n for r in load_report(spark, wh).collect()}
    assert [report[k, None] for k in ("loaded", "short", "long", "broken")] == [5, 1, 2, 1]
    assert report["lost", "created_date"] == 1 and report["lost", "resolution_hours"] == 1
    assert report["lost", "resolved_date"] == 0
    texts = spark.read.parquet(current(spark, os.path.join(wh, "_rejects", "support_tickets")))
    assert texts.count() == 4


def test_headers_take_one_job(spark, tmp_dir):
    from revspark.sources.csv import headers
    for i in range(12):
        write(os.path.join(tmp_dir, f"{i}.csv"), f"{'a,b' if i % 3 else 'b,a'}\n1,2\n")
    group = f"headers-{os.getpid()}"
    spark.sparkContext.setJobGroup(group, group)
    found = headers(spark, tmp_dir)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert {k: len(v) for k, v in found.items()} == {"a,b": 8, "b,a": 4}
    assert len(jobs) <= 3       # the stages of one adaptive query


def test_refresh_is_whole_or_not_at_all(spark, tmp_dir):
    import pytest
    from pyspark.sql import functions as F
    from revspark.sources.sinks import current, publish, publish_table
    path = os.path.join(tmp_dir, "t")
    first = publish_table(spark.range(100), "refreshed", path)
    at_work = spark.read.parquet(current(spark, path))
    bad = spark.range(0, 100, 1, 4).withColumn("id", F.expr("if(id = 77, raise_error('stop'), id)").cast("long"))
    for attempt in (lambda: publish(bad, path), lambda: publish_table(bad, "refreshed", path)):
        with pytest.raises(Exception, match="stop"):
            attempt()
        assert first.count() == 100 and spark.table("refreshed").count() == 100
        assert spark.read.parquet(current(spark, path)).count() == 100
    publish_table(spark.range(50), "refreshed", path)
    assert spark.table("refreshed").count() == 50 and at_work.count() == 100
    assert len(os.listdir(path)) == 2            # failed attempts are gone
    publish_table(spark.range(20).withColumn("k", F.col("id") % 2), "refreshed", path, ["k"])
    assert spark.table("refreshed").where("k = 1").count() == 10 and len(os.listdir(path)) == 2
    assert spark.read.parquet(current(spark, path)).count() == 20
    spark.sql("DROP TABLE refreshed")
