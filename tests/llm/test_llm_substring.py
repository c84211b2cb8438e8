"""Operator 8: hot anchors, clashing names, and its SQL."""

from __future__ import annotations

import random

import duckdb
import pytest

from revspark.llm import substring as S
from test_llm_operators import brute_repeats, words_of

SF = "/root/testdata/sf0.001"


def test_hot_anchors(spark, monkeypatch):
    import hashlib
    rng = random.Random(8)
    shared = words_of(rng, 30)
    texts = [" ".join(words_of(rng, 30) + shared + [rng.choice("ab") for _ in range(rng.randrange(20))] + words_of(rng, 9, 3))
             for _ in range(60)]
    plain = S._recurring

    def recurring(rows):
        S.HOT = 2       # workers import the module anew
        return plain(rows)
    monkeypatch.setattr(S, "_recurring", recurring)
    monkeypatch.setattr(S, "SHARD_BYTES", 3000)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts + texts[:3])], "doc_id long, text string")
    got = sorted((r.n_words, r.n_removed, hashlib.sha256(r.kept).hexdigest()) for r in S.without_repeats(df).collect())
    assert got == sorted(brute_repeats(texts + texts[:3])) and sum(r[1] for r in got) > 0


def test_names_that_clash(spark):
    names = ["doc_id", "text", "__text", "__shard", "a.b", "kept", "n_words", "c0", "input", "shard", "row"]
    row = (1, "w " * 80, "t", 2, "x", "k", 3.5, "c", "i", "s", "r")
    df = spark.createDataFrame([row, row], names)
    out = S.deduplicated(df)
    assert out.columns == names
    for r in out.collect():
        assert r.text == "" and tuple(r)[2:] == row[2:]
    assert set(names) <= set(S.without_repeats(df).columns)


def test_confirmed_passages_and_automaton():
    import numpy as np
    text = np.arange(80, dtype=np.int32)
    other = np.concatenate([np.arange(500, 520), np.arange(10, 60), np.arange(600, 610)]).astype(np.int32)
    assert S.confirmed([text, other], np.array([1, 1])) == [[(10, 60)], [(20, 70)]]
    assert S.confirmed([text], np.array([2])) == [[(0, 80)]] and S.confirmed([text], np.array([1])) == [[]]


@pytest.mark.parametrize("sf", [SF])
def test_query_equals_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf}/documents.parquet'")
    want = sorted(con.execute(S.ORACLE_SQL).fetchall())
    assert sorted(tuple(r) for r in S.op8_substring_dedup(spark, sf).collect()) == want
