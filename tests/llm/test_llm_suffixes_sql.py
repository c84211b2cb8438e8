"""Operator 13 against its DuckDB statement."""

from __future__ import annotations

import duckdb

from revspark.llm import suffixes as S

SF = "/root/testdata/sf0.001"


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    found = con.execute(S.ORACLE_SQL)
    names, want = [c[0] for c in found.description], sorted(found.fetchall())
    assert sorted(map(tuple, S.op13_suffix_dedup(spark, SF).select(*names).collect())) == want
