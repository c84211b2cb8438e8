"""The training-data operators against brute force, round trips and hand-made cases."""

from __future__ import annotations

import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, score int, key string, class_id string"  # clashing extras


def docs_of(spark, texts, ids=None):
    ids = ids or range(len(texts))
    return spark.createDataFrame([(i, t, 1, "k", "c") for i, t in zip(ids, texts)], DOCS)


def words_of(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


ODD = [None, "", "  \n\t ", "one", "a b c", "é", "x" * 30000, "the " * 9000]


# ---- 1
def test_preference_pairs(spark):
    from revspark.llm.chat import format_pairs, pairs_from, preference_pairs
    kind = "pair_id long, turn long, role string, text string, prompt string"
    a = spark.createDataFrame([(1, 0, "user", "hi", "x"), (1, 1, "assistant", "yes", "x"), (1, 1, "assistant", "yes", "x"),
                               (2, 0, "user", "q", "x"), (3, 0, None, None, "x"), (None, 0, "user", "q", "x")], kind)
    b = spark.createDataFrame([(1, 0, "user", "hi", "x"), (1, 1, "assistant", "no", "x"), (2, 0, "user", "q", "x"),
                               (3, 0, "user", "z", "x")], kind)
    got = {r.pair_id: r for r in preference_pairs(a, b).collect()}
    assert got[1].prompt == "<|user|>\nhi<|end|>\n" and got[1].prompt_turns == 1
    assert [(s.text, s.train) for s in got[1].chosen] == [("<|assistant|>\n", False), ("yes<|end|>\n", True)]
    assert got[2].prompt_turns == 1 and got[2].chosen == [] and got[2].rejected == []
    assert got[3].prompt == "" and set(got) == {1, 2, 3}
    turns = a.withColumnRenamed("pair_id", "conv_id")
    assert format_pairs(pairs_from(turns)).count() == 3
    assert format_pairs(pairs_from(turns.limit(0))).count() == 0


def test_preference_query_equals_sql(spark):
    import duckdb
    from revspark.llm.chat import ORACLE_SQL, op1_preference_format
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from read_parquet('{SF}/conversations.parquet')")
    cur = con.execute(ORACLE_SQL)
    names = [d[0] for d in cur.description]
    want = {r[names.index("conv_id")]: dict(zip(names, r)) for r in cur.fetchall()}
    got = {r.conv_id: r.asDict() for r in op1_preference_format(spark, SF).collect()}
    assert got == want


# ---- 2
def test_quality_separates_and_takes_odd_texts(spark):
    from revspark.llm.quality import fit, scored
    rng = random.Random(1)
    good = [" ".join(rng.choice("the cat sat on a mat and saw birds fly".split()) for _ in range(40)) + "." for _ in range(60)]
    bad = [" ".join(f"zz{rng.randrange(9)}###" for _ in range(40)) for _ in range(60)]
    texts = good + bad + ODD
    docs = docs_of(spark, texts)
    labels = spark.createDataFrame([(i, int(i < 60), 0) for i in range(120)] + [(None, 1, 0), (3, None, 0)],
                                   "doc_id long, quality int, toxic int")
    out = {r.doc_id: r.score for r in scored(docs, fit(docs, labels)).collect()}
    assert len(out) == len(texts) and all(0 <= s <= 1 for s in out.values())
    assert np.mean([out[i] > 0.5 for i in range(60)]) > 0.95 and np.mean([out[i] < 0.5 for i in range(60, 120)]) > 0.95
    none = fit(docs.limit(0), labels.limit(0))
    assert {r.score for r in scored(docs, none).collect()} == {0.5}


# ---- 3
def test_bpe_equals_tiktoken(spark):
    import tiktoken
    from revspark.llm.bpe import Encoder, default_vocabulary, digests, merge_parts
    v = default_vocabulary()
    e = Encoder(v)
    t = tiktoken.Encoding("own", pat_str=v.pattern, mergeable_ranks=v.ranks, special_tokens={})
    rng = random.Random(2)
    texts = ["".join(rng.choice("abcdeé thes\n\t'sß漢🙂 1٣\x1c\x85\xa0.,") for _ in range(rng.randrange(50))) for _ in range(3000)]
    for s in [*texts, *(x for x in ODD if x is not None), "ab" * 3000]:
        assert np.frombuffer(e.encode(s), "<u4").tolist() == t.encode_ordinary(s)
        assert e.decode(e.encode(s)) == s.encode()
    ids = list(v.ranks.values())
    for _ in range(5000):
        a, b = rng.choice(ids), rng.choice(ids)
        both = [v.ranks[p] for p in merge_parts(e.token[a] + e.token[b], v.ranks)]
        assert e.compatible(a, b) == (both == [a, b])
    got = {r.doc_id: r for r in digests(docs_of(spark, ODD), v).collect()}
    for i, s in enumerate(ODD):
        want = np.array(t.encode_ordinary(s or ""), "<u4")
        assert (got[i].n_tokens, got[i].ids_sha256, got[i].decoded_sha256) == (
            len(want), hashlib.sha256(want.tobytes()).hexdigest(), hashlib.sha256((s or "").encode()).hexdigest())


# ---- 4
def test_neighbours(spark):
    from revspark.llm.neighbours import nearest, op4_neighbours
    kind = "vec_id long, embedding array<double>, score double, rank int"
    v = spark.createDataFrame([(i, x, 0.0, 0) for i, x in [
        (0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.5, None]), (3, None), (4, [0.0, 0.0]), (5, [float("nan"), 1.0]),
        (6, [2.0]), (7, [0.0, 1.0]), (20, [1.0, 0.0]), (8, [-1.0, 0.0]), (40, [])]], kind)
    got = [(r.query_id, r["rank"], r.vec_id, r.score) for r in
           nearest(v, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 6, 2.0), (0, 2, 1, 1.0), (0, 3, 20, 1.0), (0, 4, 7, 0.0), (0, 5, 8, -1.0),
                   (20, 1, 6, 2.0), (20, 2, 0, 1.0), (20, 3, 1, 1.0), (20, 4, 7, 0.0), (20, 5, 8, -1.0)]
    assert nearest(v.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()
    x, ids = np.array([r.embedding for r in rows], dtype=np.float64), np.array([r.vec_id for r in rows])
    found = {}
    for r in op4_neighbours(spark, "/root/testdata/sf0.1").collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    hit = total = 0
    for q in np.flatnonzero(ids % 20 == 0):
        sims = x @ x[q]
        sims[q] = -np.inf
        hit += len(found[ids[q]] & set(ids[np.lexsort((ids, -sims))[:20]].tolist()))
        total += 20
    assert hit / total >= 0.9


def neighbour_recall(spark, x):
    """Of the 20 nearest of every 20th row of ``x``, the share that is found."""
    from revspark.llm.neighbours import nearest
    v = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "vec_id long, embedding array<double>")
    found = {}
    for r in nearest(v, F.col("vec_id") % 20 == 0).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    hit = 0
    for q in range(0, len(x), 20):
        sims = x @ x[q]
        sims[q] = -np.inf
        hit += len(found[q] & set(np.argsort(-sims)[:20].tolist()))
    return hit / len(range(0, len(x), 20)) / 20


def test_neighbours_in_a_close_group_and_beside_a_long_vector(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(3000, 64))
    x[:2500] = x[0] / np.linalg.norm(x[0]) + rng.normal(size=(2500, 64)) * 0.0003
    x /= np.linalg.norm(x, axis=1)[:, None]
    assert neighbour_recall(spark, x) >= 0.95
    y = rng.normal(size=(2000, 64))
    y /= np.linalg.norm(y, axis=1)[:, None]
    y[7] *= 1000
    assert neighbour_recall(spark, y) >= 0.95


def test_neighbours_walk_to_the_end(spark):
    from revspark.llm import neighbours as N
    # a chain: the largest inner product is at its far end, many rounds from the query
    x = [[1.0, i / 10] for i in range(12)]
    chain = spark.createDataFrame([(i, np.array(v).tobytes(), i % 7) for i, v in enumerate(x)], "node long, vector binary, block long")
    graph = spark.createDataFrame([(i, [(0.0, i + 1)]) for i in range(11)], f"node long, near {N._LIST}")
    query = spark.createDataFrame([(0, np.array([1.0, 1.0]).tobytes(), [])], f"query long, own binary, best {N._LIST}")
    pool = N.searched(query, graph, chain, N.Form("<f8", 1e6)).first().pool
    assert {e.id for e in pool} == set(range(1, 12))


# ---- 5
def test_url_verdicts(spark):
    from revspark.llm.url_filter import judge
    pages = spark.createDataFrame([
        (1, "http://a.example.org/x", '<link rel="canonical" href="http://q.example.com/en/1">'),
        (2, "http://b.example.org/y", "<meta HTTP-EQUIV='refresh' content='0; url=http://a.example.org/x'>"),
        (3, None, None), (4, "nourl/x", "x"), (5, "HTTP://WWW.Example.COM/en/", "<link href=/z rel=canonical>"),
        (6, "http://c.example.org/", "<link rel=canonical href='//d.net/es/?a=1#x'>"),
        (7, "http://d.example.org/q?u=http://e.com/en/", ""), (8, "http://example.net/es", ""), (9, "x://y://z/k", None),
        (10, "http://c.org/k", "<link rel=canonical href='http://n.net/fr/'><link rel=canonical href='http://ok.com/'>"),
        (10, "http://c.org/k", "")], "page_id int, url string, html string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in judge(pages).collect()}
    assert got == {
        1: ("a.example.org", "/x", None, "block"), 2: ("b.example.org", "/y", None, "block"), 3: ("", "", None, "allow"),
        4: ("", "", None, "allow"), 5: ("www.example.com", "/en/", "www.example.com/en/", "allow"),
        6: ("c.example.org", "/", None, "block"), 7: ("d.example.org", "/q", None, "allow"),
        8: ("example.net", "/es", None, "allow"), 9: ("y:", "//z/k", None, "allow"), 10: ("c.org", "/k", None, "allow")}
    assert judge(pages).count() == 11 and judge(pages.limit(0)).count() == 0


def test_components(spark):
    from revspark.llm.components import components
    rng = random.Random(4)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(40)]
    root = {n: n for e in edges for n in e}
    for _ in root:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    got = components(spark.createDataFrame([*edges, (None, 3)], "a long, b long"), "a", "b").collect()
    assert {r.node: r.component for r in got} == root


# ---- 6
def test_licenses(spark):
    from revspark.llm.licenses import licenses
    f = spark.createDataFrame([
        (1, "a/LICENSE", "Released under the MIT License."), (2, "a/b/c.py", "x"), (3, "a/b/d/e.py", None),
        (4, "z.py", "foo bar baz\nLicensed under CC BY-NC 4.0.\nmany other words follow here in the file and more"),
        (5, None, "q"), (6, "a/b/d/COPYING", "hello\nLicensed under the Apache License, Version 2.0."),
        (7, "/a/b/d/k.txt", ""), (8, "ab/x.txt", "t " * 20000), (2, "a/b/c.py", "x")],
        "file_id long, path string, text string")
    got = {r.file_id: (r.license, r.origin, r.directory) for r in licenses(f).collect()}
    assert got == {1: ("MIT", "own", None), 2: ("MIT", "inherited", "a"), 3: ("Apache-2.0", "inherited", "a/b/d"),
                   4: ("CC-BY-NC-4.0", "own", None), 5: (None, None, None), 6: ("Apache-2.0", "own", None),
                   7: ("Apache-2.0", "inherited", "a/b/d"), 8: (None, None, None)}
    assert licenses(f).count() == 9 and licenses(f.limit(0)).count() == 0


# ---- 7
def test_reparameterised_questions(spark, monkeypatch):
    from revspark.llm import decontaminate as D
    items = spark.createDataFrame([
        (1, "Alice bought 12 kg of rice for 30 dollars and then Alice sold 5 kg to Bob Jones near the old river"),
        (2, "too short"), (3, None), (4, "")], "item_id long, text string")
    docs = spark.createDataFrame([
        ("ok", "We know that Carla bought 99 lb of rice for 3 euros and then Carla sold 8 lb to Dan near the old river."),
        ("slots", "We know that Carla bought 99 lb of rice for 3 euros and then Erik sold 8 kg to Dan near the old river."),
        ("null", None), ("empty", ""), ("long", "some other words " * 5000)], "key string, text string")
    for limit in (D.BROADCAST_WINDOWS, 0):  # both ways to join
        monkeypatch.setattr(D, "BROADCAST_WINDOWS", limit)
        assert {(r.key, r.item_id) for r in D.leaks(docs, items).collect()} == {("ok", 1)}
    assert D.leaks(docs, items.limit(0)).count() == 0 and D.leaks(docs.limit(0), items).count() == 0


def test_verbatim_windows_beside_a_changed_value(spark):
    from revspark.llm.decontaminate import leaks
    body = "while the slow green train kept rolling past the wide empty fields and the low stone walls of a quiet farm"
    items = spark.createDataFrame([
        (1, f"the car went 60 km on the first day {body} and it went 60 km on the second"),
        (2, f"the van went 40 km on the first night {body.replace('train', 'coach')} and it went 50 km on the next"),
        (3, "we saw that Ann met her friends at the small market and later they all went home with Ann")],
        "item_id long, text string")
    texts = {r.item_id: r.text for r in items.collect()}
    docs = spark.createDataFrame([
        ("one of two equal", texts[1].replace("60 km on the second", "70 km on the second")),
        ("two made equal", texts[2].replace("50 km", "40 km")),
        ("runs on", texts[3] + " Then it rained."),
        ("runs on, other name", texts[3].replace("Ann", "Mary Jones") + " Then it rained."),
        ("another", texts[3].replace("with Ann", "with Eve").replace("that Ann", "that Bob"))], "key string, text string")
    assert {(r.key, r.item_id) for r in leaks(docs, items).collect()} >= {
        ("one of two equal", 1), ("two made equal", 2), ("runs on", 3), ("runs on, other name", 3)}


def test_leaks_of_the_fixture(spark):
    from revspark.llm.decontaminate import op7_decontaminate, without_leaks
    docs, items = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    exact = {(d, r.item_id) for r in items.collect() for d, t in texts.items() if r.text in t}
    got = {(r.doc_id, r.item_id) for r in op7_decontaminate(spark, SF).collect()}
    assert exact <= got and len(got) <= len(exact) + 2
    kept = without_leaks(docs, items)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == set(texts) - {d for d, _ in got}


# ---- 8
def brute_repeats(texts, n=35):
    words = [re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode()) for t in texts]
    seen = {}
    for w in words:
        for i in range(len(w) - n + 1):
            k = tuple(w[i:i + n])
            seen[k] = seen.get(k, 0) + 1
    out = []
    for w in words:
        gone = set()
        for i in range(len(w) - n + 1):
            if seen[tuple(w[i:i + n])] > 1:
                gone.update(range(i, i + n))
        out.append((len(w), len(gone), hashlib.sha256(b" ".join(x for i, x in enumerate(w) if i not in gone)).hexdigest()))
    return out


def test_repeated_passages(spark, monkeypatch):
    from revspark.llm import substring as S
    rng = random.Random(3)
    passage = words_of(rng, 60)
    texts = [" ".join(words_of(rng, rng.randrange(20, 200))) for _ in range(30)]
    for n in (34, 35, 36, 60):
        for _ in range(2):
            w = words_of(rng, 90)
            at = rng.randrange(60)
            texts.append(" ".join(w[:at] + passage[:n] + w[at:]))
    texts += [texts[0], " ".join(passage + words_of(rng, 3) + passage), "a b " * 60, "z " * 35, "y " * 36, *ODD]
    ids = [None if i % 7 == 0 else i for i in range(len(texts))]
    docs = docs_of(spark, texts, ids)
    for shard in (S.SHARD_BYTES, 4000):  # one shard, many shards
        monkeypatch.setattr(S, "SHARD_BYTES", shard)
        got = sorted((r.n_words, r.n_removed, r.h) for r in
                     S.without_repeats(docs).withColumn("h", F.sha2("kept", 256)).collect())
        assert got == sorted(brute_repeats(texts))
    assert S.without_repeats(docs.limit(0)).count() == 0
    assert S.deduplicated(docs).columns == docs.columns


# ---- 9
def brute_links(texts, t=0.8, n=5):
    distinct = sorted({x for x in texts if x is not None})
    grams = []
    for x in distinct:
        w = re.findall(r"[^\x20\x09-\x0D]+", x)
        k = max(1, min(n, len(w)))
        grams.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)})
    links = {x: set() for x in distinct}
    for (x, a), (y, b) in itertools.combinations(zip(distinct, grams), 2):
        if a and b and len(a & b) / len(a | b) >= t:
            links[x].add(y)
            links[y].add(x)
    return links


def test_similarity_join(spark, monkeypatch):
    from revspark.llm import jaccard as J
    rng = random.Random(5)
    base = words_of(rng, 120, 5000)
    texts = []
    for _ in range(60):  # a group of near copies of which not all are linked
        w = list(base)
        for _ in range(rng.randrange(4)):
            w[rng.randrange(len(w))] = f"n{rng.randrange(10 ** 6)}"
        texts.append(" ".join(w))
    texts += [" ".join(words_of(rng, 50, 5000)) for _ in range(20)] + texts[:3] * 5 + ODD + ["a  b c", "b c"]
    links = brute_links(texts)
    docs = docs_of(spark, texts)
    for block in (J.BLOCK, 16):
        monkeypatch.setattr(J, "BLOCK", block)
        got = {r.doc_id: r for r in J.joined(docs).collect()}
        assert len(got) == len(texts)
        for i, t in enumerate(texts):
            assert got[i].n_links == len(links.get(t, ()))
            assert got[i].copy_of == (i if t is None else texts.index(t))
    group = {}
    for t in links:
        todo, members = [t], set()
        while todo:
            x = todo.pop()
            if x not in members:
                members.add(x)
                todo += links[x]
        group[t] = min(texts.index(x) for x in members)
    assert all(got[i].class_id == (i if t is None else group[t]) for i, t in enumerate(texts))
    kept = J.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({*group.values()} | {i for i, t in enumerate(texts) if t is None})
    assert J.joined(docs.limit(0)).count() == 0


def test_pairs_are_dropped_by_the_posterior():
    from revspark.llm.jaccard import least_matches
    least = least_matches()
    assert 0 < least[128] < 102 and least[128] > least[64] > least[16] >= 0


# ---- 10
def test_languages(spark):
    from revspark.llm import language as L
    train = spark.createDataFrame([("hello there my friend", "en"), ("привет мой друг", "ru"), (None, "en"), ("x", None)],
                                  "text string, lang string")
    texts = ["hello друг мой привет there friend my hello", *ODD, "123", "ПРИВЕТ"]
    got = {r.doc_id: r for r in L.identify(docs_of(spark, texts), L.learn(train)).collect()}
    assert [(s.n_words, s.lang) for s in got[0].spans] == [(1, "en"), (3, "ru"), (4, "en")]
    assert [got[i].lang_pred for i in (1, 2, 3, 9)] == ["und"] * 4 and got[10].lang_pred == "ru"
    assert got[1].score == 0.0 and got[10].score == 1.0
    none = L.learn(train.limit(0))
    assert {r.lang_pred for r in L.identify(docs_of(spark, texts), none).collect()} == {"und"}
    rng = np.random.default_rng(0)
    for _ in range(100):
        n, size = rng.integers(1, 4), rng.integers(1, 6, 3)
        scores, starts = rng.normal(size=(size.sum(), n)) * 3, np.r_[0, np.cumsum(size)[:-1]]
        labels = L.viterbi(scores, starts, 2.0)
        for a, b in zip(starts, np.cumsum(size)):
            value = lambda p: sum(scores[a + i, x] for i, x in enumerate(p)) - 2.0 * sum(x != y for x, y in zip(p, p[1:]))
            assert value(labels[a:b]) == pytest.approx(max(value(p) for p in itertools.product(range(n), repeat=b - a)))


def test_language_of_the_fixture(spark):
    from revspark.llm.language import op10_language_id
    lang = {r.doc_id: r.lang for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    held = [r for r in op10_language_id(spark, "/root/testdata/sf0.01").collect() if r.held_out]
    assert np.mean([lang[r.doc_id] == r.lang_pred for r in held]) > 0.95


# ---- pipeline
def test_pipeline(spark):
    import corpus_pipeline as P
    docs, names = spark.read.parquet(f"{SF}/documents.parquet"), [n for n, _ in P.STAGES]
    assert names == ["quality", "near_dups", "substrings", "leaks", "tokens"]
    at = docs
    for name, stage in P.STAGES[:-1]:
        before, at = at, P.stored(stage(spark, at, SF), f"test-{name}")
        assert at.columns == docs.columns
        old, new = ({r.doc_id: r.text for r in x.collect()} for x in (before, at))
        assert set(new) <= set(old) and len(new) == at.count()
        if name == "near_dups":
            links = brute_links(list(old.values()))
            texts = list(new.values())
            assert len(set(texts)) == len(texts)
            todo = set(links)
            groups = 0
            while todo:
                reach, stack = set(), [todo.pop()]
                while stack:
                    x = stack.pop()
                    if x not in reach:
                        reach.add(x)
                        stack += links[x]
                todo -= reach
                groups += 1
                assert len(reach & set(texts)) == 1
            assert groups == len(texts)
        if name == "substrings":
            for i, (_, gone, digest) in zip(old, brute_repeats(list(old.values()))):
                assert hashlib.sha256(new[i].encode()).hexdigest() == digest if gone else new[i] == old[i]
        if name == "leaks":
            items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            assert not any(t in x for t in items for x in new.values())
    assert P.run(spark, SF).count() == at.count()
