"""Operator 7: short items, items of numbers, unspaced scripts; clashing names in the table functions."""

from __future__ import annotations

import random

from test_llm_operators import words_of

ITEMS = ["What is 12 times 7?", "小明有三个苹果，小红有五个苹果，请问他们一共有多少个苹果？", "Solve 3 x + 5 = 20 for x.",
         " ".join(str(2 ** i) for i in range(16)), "東京タワーの高さは何メートルですか。", "Paris", "Ok then", None, ""]


def test_short_items_word_by_word(spark):
    from revspark.llm.decontaminate import leaks, without_leaks
    rng = random.Random(4)
    clean = [" ".join(words_of(rng, 60)) for _ in range(6)]
    clean += ["What is 13 times 7?", "Solve 4 x + 5 = 20 for x.", "小明有三个苹果", " ".join(str(3 ** i) for i in range(16)),
              "Paris is a city. Ok then, we go.", None, "", "12 times 7"]
    texts = clean + [f"{clean[0]} {item} {clean[1]}" for item in ITEMS[:5]] + ["Question: what is 12 TIMES 7?"]
    docs = spark.createDataFrame([(i, t, "x", 2, "y") for i, t in enumerate(texts)],
                                 "doc_id long, text string, __key string, key int, `a.b` string")
    bench = spark.createDataFrame(list(enumerate(ITEMS)), "item_id long, text string")
    from pyspark.sql import functions as F
    got = {(r.key, r.item_id) for r in leaks(docs.select(F.col("doc_id").alias("key"), "text"), bench).collect()}
    first = len(clean)
    assert got == {(first + i, i) for i in range(5)} | {(first + 5, 0)}
    kept = without_leaks(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(tuple(r) for r in kept.collect()) == [(i, t, "x", 2, "y") for i, t in enumerate(texts[:first])]


def test_names_that_clash_elsewhere(spark):
    from revspark.llm.jaccard import one_of_each
    from revspark.llm.quality import accepted
    text = "word " + " ".join(f"w{i}" for i in range(60))
    names = "doc_id long, text string, __key string, key int, id string, `a.b` string, score double, __quality double"
    rows = [(i, text if i % 2 else f"{i} {text} {i}", "k", i, "i", "d", 0.5, 9.0) for i in range(8)]
    docs = spark.createDataFrame(rows, names)
    out = one_of_each(docs)
    assert out.columns == docs.columns and 1 <= out.count() <= 8
    for r in out.collect():
        assert tuple(r) == rows[r.doc_id]
    labels = spark.createDataFrame([(i, i % 2) for i in range(8)], "doc_id long, quality int")
    kept = accepted(docs, labels)
    assert kept.columns == docs.columns
    assert all(tuple(r) == rows[r.doc_id] for r in kept.collect())


def test_the_sample_counts_labels_with_documents_only(spark):
    from revspark.llm.quality import fit
    rng = random.Random(1)
    docs = spark.createDataFrame([(i, ("good fine text " if i % 2 else "bad junk spam ") * 9 + " ".join(words_of(rng, 9)))
                                  for i in range(200)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)] + [(10 ** 6 + i, i % 2) for i in range(5000)],
                                   "doc_id long, quality int")
    model = fit(docs, labels, sample=150)
    good, bad = model.scores(["good fine text " * 9, "bad junk spam " * 9])
    assert good > 0.7 > 0.3 > bad
