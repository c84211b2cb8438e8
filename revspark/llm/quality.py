"""Operator 2: quality classifier on random-indexing word vectors.

Tokens are words and runs of marks, hashed to BUCKETS. Every bucket has a fixed
sparse random index vector; a bucket's context vector is the sum of the index
vectors around all its occurrences in all documents, summed by Spark. The word
vectors are the context vectors without their common direction, at unit length. A
document is pooled to the mean and the spread of its words' vectors. A two-layer
numpy network learns from at most SAMPLE labelled rows (those with the smallest
hash of doc_id), one fold of which sets the temperature of its probabilities.

Defined cases: null and empty texts have no words and are scored as such; labels
without doc_id or quality teach nothing; of several labels (or texts) of one
doc_id the smaller counts; with one class only, or none, every score is the
share of label 1 among the labels (0.5 without labels). Repeated rows are scored
alike. Columns named like the result's are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revspark.llm.common import fold, numbered, slices, table, use

BUCKETS = 1 << 14
DIMS = 32
NONZERO = 4
REACH = 2
#: At most so many labelled rows are learned from.
SAMPLE = 8000
HIDDEN = 32
EPOCHS = 400
ACCEPT = 0.3
HELD_OUT_FOLD, CALIBRATION_FOLD, FOLDS = 0, 1, 5

#: Tokens that are worked on at a time, and characters that are split at a time.
RUN = 8000
PIECE = 1 << 20

_TOKEN = re.compile(r"\w+|[^\w\s]+")
_BLANK = re.compile(r"\s")


class _Buckets(dict):
    def __missing__(self, token: str) -> int:
        value = self[token] = xxhash.xxh3_64_intdigest(token.encode("utf-8", "surrogatepass")) % BUCKETS
        return value


_CACHE = _Buckets()


def _tokens(text: str) -> Iterator[list[str]]:
    """The tokens of a text, PIECE characters at a time; no token holds a blank."""
    at = 0
    while at < len(text):
        blank = _BLANK.search(text, at + PIECE)
        end = blank.start() if blank else len(text)
        yield _TOKEN.findall(text, at, end)
        at = end


def _runs(texts: list[str | None]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first text, buckets of all tokens, tokens per text) of runs of texts.

    A run has at most RUN tokens or is a single text.
    """
    use(_CACHE)
    none = np.empty(0, dtype=np.int16)
    first, run, size = 0, [], 0
    for i, text in enumerate(texts):
        own = np.concatenate([none, *(np.fromiter(map(_CACHE.__getitem__, tokens), dtype=np.int16, count=len(tokens))
                                      for tokens in _tokens(text or ""))])
        if run and size + len(own) > RUN:
            yield first, np.concatenate(run), np.array([len(r) for r in run])
            first, run, size = i, [], 0
        run.append(own)
        size += len(own)
    if run:
        yield first, np.concatenate(run), np.array([len(r) for r in run])


def index_vectors() -> np.ndarray:
    """(BUCKETS, DIMS): NONZERO entries of a row are 1 or -1; the same in every process."""
    rng = np.random.default_rng(7)
    out = np.zeros((BUCKETS, DIMS), dtype=np.int16)
    places = np.argsort(rng.random((BUCKETS, DIMS)), axis=1)[:, :NONZERO]
    np.put_along_axis(out, places, rng.choice(np.array([-1, 1], np.int16), (BUCKETS, NONZERO)), axis=1)
    return out


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text) to (bucket, v0, v1, ...): this task's context sums, one row a bucket."""
    index = np.vstack([index_vectors(), np.zeros((1, DIMS), dtype=np.int16)])  # the last is the gap's
    sums = np.zeros((BUCKETS + 1, DIMS), dtype=np.int64)
    seen = np.zeros(BUCKETS + 1, dtype=bool)
    for batch in slices(batches, 256):
        for _, bucket, n in _runs(batch.column(0).to_pylist()):
            # REACH gaps before, between and after the texts, so that none sees another
            spaced = np.full(len(bucket) + REACH * (len(n) + 1), BUCKETS, dtype=np.int16)
            spaced[np.arange(len(bucket)) + REACH * np.repeat(np.arange(1, len(n) + 1), n)] = bucket
            for lo in range(REACH, len(spaced) - REACH, RUN):
                hi = min(lo + RUN, len(spaced) - REACH)
                v = index[spaced[lo - REACH:hi + REACH]]
                around = np.zeros((hi - lo, DIMS), dtype=np.int16)
                for step in range(2 * REACH + 1):
                    if step != REACH:
                        around += v[step:step + hi - lo]
                order = np.argsort(spaced[lo:hi], kind="stable")
                centre = spaced[lo:hi][order]
                starts = np.flatnonzero(np.r_[True, centre[1:] != centre[:-1]])
                # 2 REACH ones a token, RUN tokens: within int16
                sums[centre[starts]] += np.add.reduceat(around[order], starts, axis=0)
                seen[centre[starts]] = True
    sums, seen = sums[:BUCKETS], seen[:BUCKETS]
    at = np.flatnonzero(seen)
    yield pa.RecordBatch.from_arrays(
        [pa.array(at, pa.int32()), *(pa.array(sums[at, d], pa.int64()) for d in range(DIMS))],
        names=["bucket", *(f"v{d}" for d in range(DIMS))])


def word_vectors(docs: DataFrame, text: str = "text") -> np.ndarray:
    """(BUCKETS, DIMS) from all rows; only this table of fixed size reaches the driver."""
    names = [f"v{d}" for d in range(DIMS)]
    sums = (docs.select(F.col(text).alias("text"))
            .mapInArrow(_contexts, "bucket int, " + ", ".join(f"{c} long" for c in names))
            .groupBy("bucket").agg(*(F.sum(c).alias(c) for c in names)).toPandas())
    out = np.zeros((BUCKETS, DIMS))
    out[sums["bucket"].to_numpy(dtype=np.int64)] = sums[names].to_numpy(dtype=np.float64)
    size = np.linalg.norm(out, axis=1, keepdims=True)
    out = np.divide(out, size, out=np.zeros_like(out), where=size > 0)
    common = out.mean(axis=0)
    if np.linalg.norm(common):
        common /= np.linalg.norm(common)
        out -= np.outer(out @ common, common)
    size = np.linalg.norm(out, axis=1, keepdims=True)
    return np.divide(out, size, out=np.zeros_like(out), where=size > 0).astype(np.float32)


def pooled(texts: list[str | None], vectors: np.ndarray) -> np.ndarray:
    """(texts, 2 DIMS): mean and standard deviation of the words' vectors (0 without words)."""
    out = np.zeros((len(texts), 2 * DIMS))
    for first, bucket, n in _runs(texts):
        some = np.flatnonzero(n)
        starts = (np.cumsum(n) - n)[some]
        total = np.zeros((len(some), 2 * DIMS))
        for lo in range(0, len(bucket), RUN):  # one round, but for a single long text
            v = vectors[bucket[lo:lo + RUN]]
            total[:, :DIMS] += np.add.reduceat(v, starts, axis=0, dtype=np.float64)
            total[:, DIMS:] += np.add.reduceat(v * v, starts, axis=0, dtype=np.float64)
        total /= n[some, None]
        total[:, DIMS:] = np.sqrt(np.maximum(total[:, DIMS:] - total[:, :DIMS] ** 2, 0))
        out[first + some] = total
    return out


class Network:
    """Two layers on standardised inputs; probabilities at a calibrated temperature."""

    def __init__(self, x: np.ndarray, y: np.ndarray, calibration: np.ndarray):
        """``calibration`` marks the rows that set the temperature and are not learned from."""
        self.prior = float(y.mean()) if len(y) else 0.5
        train = ~calibration
        self.constant = len(set(y[train].tolist())) < 2
        if self.constant:
            return
        self.mean, self.scale = x[train].mean(0), x[train].std(0) + 1e-6
        rng = np.random.default_rng(11)
        self.weights = [rng.normal(size=(x.shape[1], HIDDEN)) / np.sqrt(x.shape[1]), np.zeros(HIDDEN),
                        rng.normal(size=HIDDEN) / np.sqrt(HIDDEN), np.zeros(())]
        self.temperature = 1.0
        self._fit((x[train] - self.mean) / self.scale, y[train].astype(np.float64))
        held = calibration if calibration.any() else train
        logits, labels = self.logits(x[held]), y[held]
        losses = {t: np.logaddexp(0, np.where(labels > 0, -logits, logits) / t).mean()
                  for t in np.geomspace(0.25, 8, 61)}
        self.temperature = float(min(losses, key=losses.get))

    def _fit(self, x: np.ndarray, y: np.ndarray, rate: float = 0.01, decay: float = 1e-4) -> None:
        first = [np.zeros_like(w) for w in self.weights]
        second = [np.zeros_like(w) for w in self.weights]
        for step in range(1, EPOCHS + 1):
            a, b, c, d = self.weights
            hidden = np.tanh(x @ a + b)
            error = (1 / (1 + np.exp(-(hidden @ c + d))) - y) / len(y)
            back = np.outer(error, c) * (1 - hidden * hidden)
            slopes = [x.T @ back + decay * a, back.sum(0), hidden.T @ error + decay * c, error.sum()]
            for i, g in enumerate(slopes):
                first[i] = 0.9 * first[i] + 0.1 * g
                second[i] = 0.999 * second[i] + 0.001 * g * g
                self.weights[i] = self.weights[i] - rate * (first[i] / (1 - 0.9 ** step)) / (
                    np.sqrt(second[i] / (1 - 0.999 ** step)) + 1e-8)

    def logits(self, x: np.ndarray) -> np.ndarray:
        a, b, c, d = self.weights
        return np.tanh((x - self.mean) / self.scale @ a + b) @ c + d

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.constant:
            return np.full(len(x), self.prior)
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -500, 500)))


class Classifier:
    """Word vectors and network, of fixed size."""

    def __init__(self, vectors: np.ndarray, network: Network):
        self.vectors, self.network = vectors, network

    def scores(self, texts: list[str | None]) -> np.ndarray:
        return self.network.scores(pooled(texts, self.vectors))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Classifier:
    """Word vectors from all of ``docs`` (doc_id, text), the network from ``labels``
    (doc_id, quality) outside the held-out fold."""
    vectors = word_vectors(docs)
    # only labels whose document is there count towards the bound
    there = docs.where(F.col("text").isNotNull()).select("doc_id")
    known = (labels.where(F.col("quality").isNotNull() & (fold(F.col("doc_id"), FOLDS) != HELD_OUT_FOLD))
             .join(there, "doc_id", "left_semi").groupBy("doc_id").agg(F.min("quality").alias("_quality"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))  # the documented bound
    shared = docs.sparkSession.sparkContext.broadcast(vectors)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 256):
            x = pooled(batch.column(2).to_pylist(), shared.value)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(list(x), pa.list_(pa.float64()))],
                                             names=["doc_id", "quality", "x"])

    rows = (docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")  # at most ``sample`` rows
            .select("doc_id", F.col("_quality").cast("int").alias("quality"), "text")
            .mapInArrow(features, T.StructType([
                docs.schema["doc_id"], T.StructField("quality", T.IntegerType()),
                T.StructField("x", T.ArrayType(T.DoubleType()))]))
            .groupBy("doc_id", "quality").agg(F.min("x").alias("x"))
            .withColumn("calibration", fold(F.col("doc_id"), FOLDS) == CALIBRATION_FOLD)
            .orderBy("doc_id").toPandas())
    x = np.array(rows["x"].tolist(), dtype=np.float64).reshape(len(rows), 2 * DIMS)
    return Classifier(vectors, Network(x, (rows["quality"] > 0).to_numpy(dtype=np.int64),
                                       rows["calibration"].to_numpy(dtype=bool)))


def scored(docs: DataFrame, classifier: Classifier, name: str = "score", text: str = "text") -> DataFrame:
    """``docs`` with a double column ``name``, the probability of quality 1."""
    kept = [c for c in docs.columns if c != name]
    at = kept.index(text)
    shared = docs.sparkSession.sparkContext.broadcast(classifier)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 256):
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(shared.value.scores(batch.column(at).to_pylist()), pa.float64())],
                names=[*kept, name])

    return docs.select(*kept).mapInArrow(
        run, T.StructType([docs.schema[c] for c in kept] + [T.StructField(name, T.DoubleType())]))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, columns as they are."""
    plain, at = numbered(docs)
    return (scored(plain, fit(docs, labels), "score", at["text"])
            .where(F.col("score") >= ACCEPT).select(*at.values()).toDF(*docs.columns))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    classifier = fit(docs, table(spark, sf_dir, "labels"))
    held = F.coalesce(fold(F.col("doc_id"), FOLDS) == HELD_OUT_FOLD, F.lit(False))
    return scored(docs.select("doc_id", "text"), classifier).select(
        "doc_id", held.alias("held_out"), "score", (F.col("score") >= ACCEPT).cast("int").alias("predicted"))
