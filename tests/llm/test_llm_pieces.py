"""Texts worked on in pieces and runs give what whole texts give."""

import numpy as np

from revspark.llm import quality
from revspark.llm.common import WordHash, use


def test_pieces_hold_the_tokens_of_the_whole_text(monkeypatch):
    monkeypatch.setattr(quality, "PIECE", 7)
    for text in ("", " ", "one", "ab,c d!! e\n" * 9, "x" * 40, "  a  " * 5):
        assert [t for part in quality._tokens(text) for t in part] == quality._TOKEN.findall(text)


def test_pooling_in_runs_equals_pooling_at_once(monkeypatch):
    texts = [None, "", "a b c", "d, e f! " * 40, " ", "g h"]
    vectors = np.random.default_rng(1).normal(size=(quality.BUCKETS, quality.DIMS)).astype(np.float32)
    whole = quality.pooled(texts, vectors)
    monkeypatch.setattr(quality, "RUN", 5)
    np.testing.assert_allclose(quality.pooled(texts, vectors), whole, atol=1e-6)
    assert not whole[[0, 1, 4]].any()


def test_a_worker_keeps_the_entries_of_one_cache():
    first, second = WordHash(), WordHash()
    use(first)
    first[b"a"]
    use(first)
    assert len(first) == 1
    use(second)
    assert len(first) == 0
