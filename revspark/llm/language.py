"""Operator 10: language identification of whole texts, span by span.

Learned are, per language, the counts of letter trigrams (hashed to BUCKETS) and
of letters per script, over all training texts. A word scores per language the
mean-smoothed log probability of its trigrams; script ranges narrow the
candidates first: a language that hardly ever uses the word's script is out,
unless all would be. Viterbi over the words of a text, with a penalty for every
switch, labels spans of one language; the text's language is the one whose spans
hold the most letters (ties: the first in text order).

Defined cases: null text and text without a letter give ``und`` with score 0 and
no spans; training rows without text, letters or language teach nothing, and
with no training at all every text is ``und``. Repeated rows count as often as
they occur. Extra columns pass through ``identify``, which replaces columns named
like its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revspark.llm.common import fold, slices, table

BUCKETS = 1 << 15
SMOOTHING = 0.5
SWITCH_PENALTY = 12.0
#: Share of a language's letters below which a script is not one of its own.
SCRIPT_SHARE = 0.001
UNDETERMINED = "und"

#: First code point of ranges of scripts, fixed values; what lies between is ``other``.
SCRIPTS = [
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"),
    (0x0590, "hebrew"), (0x0600, "arabic"), (0x0780, "other"), (0x0900, "devanagari"),
    (0x0980, "bengali"), (0x0A00, "other"), (0x0B80, "tamil"), (0x0C00, "other"),
    (0x0E00, "thai"), (0x0E80, "other"), (0x10A0, "georgian"), (0x1100, "hangul"),
    (0x1200, "other"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"),
    (0x3040, "kana"), (0x3100, "other"), (0x3400, "han"), (0xA000, "other"),
    (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "other"),
    (0x20000, "han"),
]
_NAMES = sorted({name for _, name in SCRIPTS})
_SPACE = 32


@lru_cache(1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """For every code point: whether it is a letter, and its script's number."""
    letters = np.fromiter((0xD800 > c and chr(c).isalpha() or c > 0xDFFF and chr(c).isalpha()
                           for c in range(0x110000)), dtype=bool, count=0x110000)
    scripts = np.zeros(0x110000, dtype=np.uint8)
    for start, name in SCRIPTS:
        scripts[start:] = _NAMES.index(name)
    return letters, scripts


class Letters:
    """The letters of some texts: trigram bucket and script of each, grouped to words."""

    def __init__(self, texts: list[str | None]):
        letter, script = _tables()
        lows = [(t or "").lower() for t in texts]
        cps = np.frombuffer(("\n" + "\n".join(lows) + "\n").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        is_letter = letter[cps]
        folded = np.where(is_letter, cps, np.uint32(_SPACE))
        at = np.flatnonzero(is_letter).astype(np.int32)
        mixed = (folded[at - 1] * np.uint32(0x9E3779B1) + folded[at] * np.uint32(0x85EBCA77)
                 + folded[at + 1] * np.uint32(0xC2B2AE3D))
        self.bucket = (mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x2C1B3C6D) >> np.uint32(17)
        self.script = script[cps[at]]
        ends = np.cumsum(np.fromiter(map(len, lows), dtype=np.int64, count=len(lows)) + 1)
        self.doc = np.searchsorted(ends, at - 1, side="right")  # text of each letter
        first = np.empty(len(at), dtype=bool)
        first[:1] = True
        first[1:] = np.diff(at) > 1
        self.word = np.flatnonzero(first)  # first letter of each word


class Model:
    """Log probabilities per language; size: languages x (buckets + scripts)."""

    def __init__(self, counts: dict[str, tuple[np.ndarray, np.ndarray]]):
        self.languages = sorted(counts)
        grams = [counts[k][0] + SMOOTHING for k in self.languages]
        self.log = np.array([np.log(g / g.sum()) for g in grams], dtype=np.float32).T.copy() \
            if counts else np.zeros((BUCKETS, 0), np.float32)
        self.uses = np.array([counts[k][1] >= SCRIPT_SHARE * max(1, counts[k][1].sum())
                              for k in self.languages]).T if counts else np.zeros((len(_NAMES), 0), bool)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, lang) to (lang, kind, slot, n): counts of this task, at most BUCKETS a language."""
    counts: dict[str, list[np.ndarray]] = {}
    for batch in slices(batches, 2048):
        texts, langs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for lang in set(langs):
            own = Letters([t for t, x in zip(texts, langs) if x == lang])
            sums = counts.setdefault(lang, [np.zeros(BUCKETS, np.int64), np.zeros(len(_NAMES), np.int64)])
            sums[0] += np.bincount(own.bucket, minlength=BUCKETS)
            sums[1] += np.bincount(own.script, minlength=len(_NAMES))
    for lang, kinds in counts.items():
        for kind, n in enumerate(kinds):
            slot = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(slot), pa.string()), pa.array([kind] * len(slot), pa.int32()),
                 pa.array(slot, pa.int32()), pa.array(n[slot], pa.int64())],
                names=["lang", "kind", "slot", "n"])


def learn(docs: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """The model of all rows with a language; its counts are summed by Spark.

    What reaches the driver is the model itself, BUCKETS numbers a language.
    """
    known = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang")).dropna()
    sums = (known.mapInArrow(_counted, "lang string, kind int, slot int, n long")
            .groupBy("lang", "kind", "slot").agg(F.sum("n").alias("n")).toPandas())
    counts = {}
    for (name, kind), rows in sums.groupby(["lang", "kind"]):
        own = counts.setdefault(name, (np.zeros(BUCKETS), np.zeros(len(_NAMES))))
        own[kind][rows["slot"].to_numpy()] = rows["n"].to_numpy()
    return Model(counts)


def word_scores(letters: Letters, model: Model) -> np.ndarray:
    """(words, languages): log probabilities, -inf outside the candidates."""
    n_words, n = len(letters.word), len(model.languages)
    out = np.empty((n_words, n), dtype=np.float64)
    uses = model.uses[letters.script[letters.word]]
    some = uses.any(axis=1)
    for k in range(n):
        per_letter = model.log[:, k][letters.bucket]
        out[:, k] = np.add.reduceat(per_letter, letters.word, dtype=np.float64)
        out[some & ~uses[:, k], k] = -np.inf
    return out


def viterbi(scores: np.ndarray, starts: np.ndarray, penalty: float = SWITCH_PENALTY) -> np.ndarray:
    """The best labels of the words of many texts at once; ``starts``: first word of each.

    Texts run side by side, longest first, so a step costs one numpy call for all
    texts that are still going on. Ties keep the label, else take the smaller one.
    """
    total, n = scores.shape
    size = np.diff(np.append(starts, total))
    order = np.argsort(-size, kind="stable")
    begin, left = starts[order], size[order]
    running = np.searchsorted(-left, -np.arange(1, (left[0] if len(left) else 0) + 1), side="right")
    came = np.empty((total, n), dtype=np.uint8 if n < 256 else np.int32)
    labels = np.arange(n)
    best = scores[begin].copy()
    for t in range(1, len(running)):
        k = running[t]
        now, at = best[:k], begin[:k] + t
        top = now.argmax(axis=1)
        switched = now[np.arange(k), top][:, None] - penalty
        stay = now >= switched
        came[at] = np.where(stay, labels, top[:, None])
        best[:k] = np.where(stay, now, switched) + scores[at]
    out = np.empty(total, dtype=np.int64)
    label = best.argmax(axis=1) if n else np.zeros(len(begin), dtype=np.int64)
    for t in range(len(running) - 1, -1, -1):
        k = running[t]
        at = begin[:k] + t
        out[at] = label[:k]
        if t:
            label[:k] = came[at, label[:k]]
    return out


_SPANS = T.ArrayType(T.StructType([T.StructField("first_word", T.IntegerType()),
                                   T.StructField("n_words", T.IntegerType()),
                                   T.StructField("lang", T.StringType())]))
_OWN = ("lang_pred", "score", "spans")


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred, score (share of the letters in its spans) and spans."""
    kept = [c for c in docs.columns if c not in _OWN]
    at = kept.index(text)
    schema = T.StructType([docs.schema[c] for c in kept] + [
        T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
        T.StructField("spans", _SPANS)])
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded, see Model
    kinds = pa.list_(pa.struct([("first_word", pa.int32()), ("n_words", pa.int32()), ("lang", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        names = np.array([*model.languages, UNDETERMINED], dtype=object)
        for batch in slices(batches, 2048):
            size, n = batch.num_rows, len(model.languages)
            letters = Letters(batch.column(at).to_pylist())
            lang, score, spans = np.full(size, n), np.zeros(size), [[] for _ in range(size)]
            if n and len(letters.word):
                doc = letters.doc[letters.word]
                starts = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
                label = viterbi(word_scores(letters, model), starts)
                length = np.diff(np.append(letters.word, len(letters.bucket)))
                sums = np.bincount(doc * n + label, weights=length, minlength=size * n).reshape(size, n)
                some = sums.sum(axis=1) > 0
                lang[some] = sums[some].argmax(axis=1)
                score[some] = sums[some].max(axis=1) / sums[some].sum(axis=1)
                cut = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (label[1:] != label[:-1])])
                first = starts[np.searchsorted(starts, cut, side="right") - 1]
                for i, f, w, k in zip(doc[cut].tolist(), (cut - first).tolist(),
                                      np.diff(np.append(cut, len(doc))).tolist(), label[cut].tolist()):
                    spans[i].append({"first_word": f, "n_words": w, "lang": model.languages[k]})
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(names[lang].tolist(), pa.string()), pa.array(score, pa.float64()),
                 pa.array(spans, kinds)], names=[*kept, *_OWN])

    return docs.select(*kept).mapInArrow(run, schema)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    remainder = fold(F.col("doc_id"), 4)
    model = learn(docs.where(remainder != 2))
    found = identify(docs.select("doc_id", F.coalesce(remainder == 2, F.lit(False)).alias("held_out"), "text"), model)
    return found.select("doc_id", "held_out", "lang_pred", "score", "spans")
