"""Operator 5: long urls, and judgements over alias links against the DuckDB statement."""

from __future__ import annotations

import random

import duckdb
import pandas as pd

from revspark.llm import url_filter

SF = "/root/testdata/sf0.001"


def judged_by_sql(pages):
    con = duckdb.connect()
    con.register("given", pd.DataFrame(pages, columns=["page_id", "url", "html"]))
    con.execute("create view pages as select cast(page_id as int) as page_id, cast(url as varchar) as url, "
                "cast(html as varchar) as html from given")
    return sorted(con.execute(url_filter.ORACLE_SQL).fetchall(), key=str)


def judged(spark, pages):
    df = spark.createDataFrame(pages, "page_id int, url string, html string")
    return sorted((tuple(r) for r in url_filter.judge(df).collect()), key=str)


def test_long_urls_of_mixed_characters(spark):
    mixed = "a😀" * 250_000
    pages = [(1, f"http://{mixed}/x", None), (2, f"{mixed}://h.net/fr/{mixed}?{mixed}", f"<link rel=canonical href='{mixed}'>"),
             (3, mixed, ""), (4, ":/" * 300_000, "<link " + "x " * 200_000)]
    got = {r[0]: r for r in judged(spark, pages)}
    assert got[1][1] == mixed and got[1][2] == "/x" and got[2][1] == "h.net" and got[2][4] == "block"
    assert got[3][1:] == ("", "", None, "allow") and got[4][1:] == ("", "", None, "allow")


def test_alias_groups_equal_sql(spark):
    rng = random.Random(9)
    hosts = ["a.org", "b.org", "x.example.com", "WWW.example.com", "k.net", "q.fr", "ok.com"]
    paths = ["/", "/en/", "/en/1", "/es/", "/fr/z", "", "/p?x=1", "/p#f", "/d/e"]
    urls = [f"http://{h}{p}" for h in hosts for p in paths] + [None, "no scheme", "x://y://z"]
    pages = []
    for i in range(90):
        links = "".join(rng.choice([
            '<link rel="canonical" href="{}">', "<LINK href='{}' REL='next Canonical'>", "<link rel=canonical href={}>",
            '<meta http-equiv="Refresh" content="0; URL={}">', "<meta name=x content='url={}'>", "<link rel=icon href={}>"]).format(
            rng.choice([rng.choice(urls[:-3]), "/es/", "?q=2", "e/f", "//k.net/fr/", "../x", ""])) for _ in range(rng.randrange(3)))
        pages.append((i, rng.choice(urls), rng.choice([links, links, links, None])))
    # a chain that joins a blocked and an allowed end, and one that meets a block only
    pages += [(100 + i, f"http://c{i}.org/", f"<link rel=canonical href=http://c{i + 1}.org/>") for i in range(9)]
    pages += [(110, "http://c9.org/", "<link rel=canonical href=http://k.net/es/1>"),
              (111, "http://c0.org/", "<meta http-equiv=refresh content='1;url=http://ok.com/'>")]
    pages += [(120, "http://d.org/1", "<link rel=canonical href=http://k.net/es/2>"), (121, "http://d.org/2", "<link rel=canonical href=/1>")]
    got = judged(spark, pages)
    assert got == judged_by_sql(pages)
    verdicts = {r[0]: r[4] for r in got}
    assert verdicts[105] == "allow" and verdicts[121] == "block"


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{SF}/pages.parquet'")
    want = sorted(con.execute(url_filter.ORACLE_SQL).fetchall(), key=str)
    assert sorted((tuple(r) for r in url_filter.op5_url_filter(spark, SF).collect()), key=str) == want
