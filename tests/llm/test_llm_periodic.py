"""Operator 12 against a plain version that tries every period."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np

from revspark.llm import periodic

SF = "/root/testdata/sf0.001"


def plain_runs(x):
    """Every maximal stretch of every period, smallest period of each."""
    x = np.asarray(x)
    best = {}
    for q in range(1, len(x) // 2 + 1):
        agree = list(x[q:] == x[:-q]) + [False]
        start = None
        for i, a in enumerate(agree):
            if a and start is None:
                start = i
            elif not a and start is not None:
                if i - start + q >= max(12, 2 * q):
                    best.setdefault((start, i + q), q)
                start = None
    return sorted(((s, e, q) for (s, e), q in best.items()), key=lambda r: (r[0], r[2]))


def fibonacci(n):
    a, b = [0], [0, 1]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


def shapes():
    rng = random.Random(7)
    yield []
    yield [1]
    yield [5] * 700
    yield [0, 1] * 200 + [0] + [0, 1] * 200
    yield ([0, 1] * 90 + [0]) * 3
    yield [0, 1, 2] * 100 + [0, 1] + [0, 1, 2] * 150 + [2] + [0, 1, 2] * 80
    yield fibonacci(900)
    yield [bin(i).count("1") % 2 for i in range(1024)]
    for size in (1, 2, 3, 400):
        for n in (11, 12, 13, 200, 900):
            yield [rng.randrange(size) for _ in range(n)]
    for _ in range(12):
        unit = [rng.randrange(50) for _ in range(rng.choice([1, 5, 63, 64, 65, 127, 128, 129, 200]))]
        times = rng.choice([2, 2, 3, 5])
        head = [rng.randrange(50) for _ in range(rng.randrange(80))]
        yield head + (unit * times) + unit[:rng.randrange(len(unit) + 1)] + head
    for _ in range(12):     # runs of runs
        inner = [rng.randrange(3) for _ in range(rng.randrange(1, 4))] * rng.randrange(20, 60)
        unit = inner + [rng.randrange(3) for _ in range(rng.randrange(4))]
        yield (unit * 4)[:rng.randrange(len(unit), 4 * len(unit))]


def test_runs_equal_every_period_tried():
    texts = [np.array(t, dtype=np.int32) for t in shapes()]
    together = periodic.find_runs(texts)
    for t, got in zip(texts, together):
        assert got == plain_runs(t), (len(t), t[:40].tolist())


def test_texts_do_not_meet():
    same = np.arange(100, dtype=np.int32)
    assert periodic.find_runs([same, same, same]) == [[], [], []]
    assert periodic.find_runs([]) == []


def test_odd_rows(spark):
    texts = [None, "", " \n", "a", "a " * 12, "a " * 11, "ab " * 30000, "é  é  " * 9, "a " * 12]
    df = spark.createDataFrame([(i, t, "x", 1.5, "keep") for i, t in enumerate(texts)],
                               "doc_id long, text string, runs string, n_words double, `a.b` string")
    out = {r.doc_id: r for r in periodic.with_runs(df).collect()}
    assert [out[i].n_words for i in range(9)] == [0, 0, 0, 1, 12, 11, 30000, 18, 12]
    assert [len(out[i].runs) for i in range(9)] == [0, 0, 0, 0, 1, 0, 1, 1, 1]
    assert bytes(out[6].collapsed) == b"ab" and out[4]["a.b"] == "keep"
    assert tuple(out[7].runs[0]) == (0, 18, 1)
    assert periodic.with_runs(df.limit(0)).count() == 0


def test_query_equals_plain_version(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in periodic.op12_periodic_runs(spark, SF).collect()}
    assert len(got) == len(docs)
    planted = 0
    for d in docs:
        words = re.findall(rb"[^\x20\x09-\x0D]+", (d.text or "").encode())
        h, n = zlib.crc32(str(d.doc_id).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            planted += 1
        if n > 3000:
            continue        # the plain version is quadratic
        numbers = {w: i for i, w in enumerate(dict.fromkeys(words))}
        runs = plain_runs([numbers[w] for w in words])
        gone = {i for s, e, q in runs for i in range(s + q, e)}
        r = got[d.doc_id]
        assert r.n_runs == len(runs)
        text = "".join(f"{s},{e - s},{q}\n" for s, e, q in runs)
        assert r.runs_sha256 == hashlib.sha256(text.encode()).hexdigest()
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        assert r.collapsed_sha256 == hashlib.sha256(kept).hexdigest()
        if runs:
            s, e, q = min(runs, key=lambda t: (t[0] - t[1], t[0], t[2]))
            assert (r.start, r.length, r.period, r.exponent_milli) == (s, e - s, q, 1000 * (e - s) // q)
        else:
            assert (r.start, r.length, r.period, r.exponent_milli) == (None,) * 4
    assert planted
