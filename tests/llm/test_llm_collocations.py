"""Operator 11 against plain counting and against its SQL."""

from __future__ import annotations

import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from revspark.llm import collocations as C

SF = "/root/testdata/sf0.001"


def plain(rows, top=2000):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = lang or "und"
        text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", text):
            w = re.findall(r"[^ \t]+", piece)
            n[lang] += len(w)
            for m in range(1, 6):
                for i in range(len(w) - m + 1):
                    f[lang, tuple(w[i:i + m])] += 1
    cand = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= 100}
    gone = set()
    for (lang, p), a in cand.items():
        for k in range(2, len(p)):
            for i in range(len(p) - k + 1):
                if a >= cand.get((lang, p[i:i + k]), a + 1):
                    gone.add((lang, p[i:i + k]))
    out = []
    for (lang, p), a in cand.items():
        if (lang, p) not in gone:
            score, k = min((1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
            out.append((lang, " ".join(p), a, f[lang, p[:k]], f[lang, p[k:]], n[lang], score))
    ranked = []
    for lang in {r[0] for r in out}:
        mine = sorted((r for r in out if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))
        ranked += [(r[0], i, *r[1:]) for i, r in enumerate(mine[:top], 1)]
    return sorted(ranked)


def corpus():
    rng = random.Random(5)
    vocabulary = ["the", "of", "été", "New", "York", "a b", "x" * 40] + [f"w{i}" for i in range(3)]
    phrases = [" ".join(rng.choice("abcdefgh") * 2 for _ in range(rng.randrange(2, 6))) for _ in range(25)]
    rows = [(None, "en"), ("", None), (" \t ", "en"), (".,;:!?\n\r", "de"), ("the " * 300, None), ("ab cd " * 500, "fr")]
    for _ in range(700):
        out = []
        for _ in range(rng.randrange(40)):
            out.append(rng.choice(phrases) if rng.random() < .5 else rng.choice(["new york city", "New York", "on the other hand as", *vocabulary]))
            out.append(rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n"]))
        rows.append(("".join(out), rng.choice(["en", "de", None])))
    return rows + rows[-30:]


@pytest.mark.parametrize("shard,span", [(8 << 20, 4 << 20), (3000, 4 << 20), (3000, 2500)])
def test_equals_plain_counting(spark, monkeypatch, shard, span):
    monkeypatch.setattr(C, "RANGE_BYTES", span)
    plain_shards = C._shards

    def shards(batches):
        C.SHARD_BYTES = shard        # workers import the module anew
        return plain_shards(batches)
    monkeypatch.setattr(C, "_shards", shards)
    rows = corpus()
    df = spark.createDataFrame([(t, a, 1, "p") for t, a in rows], "text string, lang string, n int, phrase string").repartition(3)
    got = sorted(tuple(r) for r in C.collocations(df).collect())
    want = plain(rows)
    assert got == want and len(want) > 60
    assert C.collocations(df.limit(0)).count() == 0


def test_transducer():
    grams = np.array([[1, 0, 0, 0, 0], [1, 2, 0, 0, 0], [1, 2, 3, 4, 5], [2, 2, 0, 0, 0], [2, 2, 1, 0, 0]])
    one = C.CountTransducer.of_sorted([b"a", b"b", b"c", b"d", b"e"], grams, np.array([7, 1, 2, 300, 5]))
    assert one.weight[0].tolist() == [10, 305] and one.weight[1].tolist() == [3, 305]
    again = C.CountTransducer.unpack(one.pack())
    rows, counts = again.grams()
    assert sorted((*r, n) for r, n in zip(rows.tolist(), counts.tolist())) == sorted(
        (*r, n) for r, n in zip(grams.tolist(), [7, 1, 2, 300, 5]))
    both = C._joined([one.pack(), one.pack()])
    assert both.weight[0].tolist() == [20, 610]
    assert one.compose([[1], [1, 2, 3, 4, 5], [2], [2, 2], [3], [1, 1]]).tolist() == [7, 2, 0, 300, 0, 0]


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    want = sorted(con.execute(C.ORACLE_SQL).fetchall())
    got = sorted(tuple(r) for r in C.op11_collocations(spark, SF).collect())
    assert got == want and want
