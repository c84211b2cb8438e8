"""The similarity join on long chains: blocks that share no bucket are not compared, no link is lost."""

from __future__ import annotations

import random

import duckdb
import pytest

from pyspark.sql import functions as F


def test_chain_is_compared_by_buckets(spark, monkeypatch):
    from revspark.llm import jaccard as J
    monkeypatch.setattr(J, "BLOCK", 16)
    rng = random.Random(11)
    words = [f"w{rng.randrange(10 ** 6)}" for _ in range(60 + 6 * 300)]
    texts = [" ".join(words[6 * k:6 * k + 60]) for k in range(300)]  # each shares 50 of 56 shingles with the next
    grams = [set(zip(*(t.split()[i:] for i in range(5)))) for t in texts]
    want = [sum(len(g & h) / len(g | h) >= 0.8 for h in grams) - 1 for g in grams]
    made = []
    pairs = J.block_pairs
    monkeypatch.setattr(J, "block_pairs", lambda dealt, bands: made.append((dealt, pairs(dealt, bands))) or made[-1][1])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in J.joined(docs).collect()}
    assert [got[i].n_links for i in range(300)] == want and max(want) >= 1
    dealt, compared = made[0]
    sizes = dealt.groupBy("component", "block").agg(F.count(F.lit(1)).alias("n"), F.lit(1).alias("b"))
    per = {r.component: r.b for r in sizes.groupBy("component").agg(F.sum("b").alias("b")).collect()}
    longest = max(per, key=per.get)
    n = per[longest]
    assert n >= 8 and sizes.agg(F.max("n")).head()[0] <= 64
    assert compared.where(F.col("component") == longest).count() < n * (n + 1) / 4


def test_equal_rows_and_large_groups(spark, monkeypatch):
    from revspark.llm import jaccard as J
    monkeypatch.setattr(J, "BLOCK", 8)
    rng = random.Random(12)
    base = [f"b{k}" for k in range(200)]
    texts = []
    for k in range(90):  # all alike
        w = list(base)
        w[rng.randrange(200)] = f"n{k}"
        texts.append(" ".join(w))
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts + texts[:30] + [None, ""])],
                                 "doc_id long, text string")
    got = {r.doc_id: r for r in J.joined(docs).collect()}
    assert len(got) == 122 and {got[i].class_id for i in range(120)} == {0}
    assert {got[i].n_links for i in range(120)} == {89}
    assert (got[120].n_links, got[121].n_links) == (0, 0)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_sql(spark, sf):
    from revspark.llm import jaccard as J
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '/root/testdata/{sf}/documents.parquet'")
    found = con.execute(J.ORACLE_SQL)
    names, want = [c[0] for c in found.description], sorted(found.fetchall())
    assert sorted(map(tuple, J.op9_ngram_jaccard(spark, f"/root/testdata/{sf}").select(*names).collect())) == want


def test_sql_on_ties_nulls_and_short_texts(spark):
    from revspark.llm import jaccard as J
    words = [f"w{i}" for i in range(13)]
    texts = [(1, " ".join(words[:12])), (2, " ".join(words)), (3, " ".join(words[1:])),  # 8 of 9, 8 of 9, 7 of 9 shingles
             (4, " ".join(words[:12])), (5, None), (6, None), (7, ""), (8, "  "), (9, "a b"), (9, "a  b"), (10, "a b")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    con = duckdb.connect()
    con.register("documents", docs.toArrow())
    found = con.execute(J.ORACLE_SQL)
    names, want = [c[0] for c in found.description], sorted(found.fetchall())
    assert sorted(map(tuple, J.joined(docs).select(*names).collect())) == want
    assert {r[0]: r[1] for r in want}[3] == 1
