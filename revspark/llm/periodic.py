"""Operator 12: periodic runs of words, found from multi-scale minimizers.

A run is a stretch of words with smallest period q (words q apart are the same) and
length of at least max(LEAST, 2q) that no neighbouring word extends. A text's words
are numbered, many texts are laid end to end with a mark between them that equals
nothing, and all of them are worked on together:

* Periods under SHORT: direct lag scans; a stretch of agreeing words is a run.
* Scale j holds the periods from 2^j to 2^(j+1). Of each window of 2^j words the least
  hash of its phrases (2^j / 4 words) is a minimizer. A run covers two windows one period
  apart, whose minima are the same phrase: equal minimizers at a distance of that scale
  seed an extension in both directions. Phrases of a period under half their length
  stand for nothing (their run is known from the scales before) and are no minimizers,
  so that equal ones keep their distance and there are a bounded number of pairs.
* A run whose first period is nothing but such phrases lies across two runs of that
  shorter period that touch; the lags at which those two agree are seeds as well.

What has been found twice (as a multiple of its period) has the same ends: the smallest
period stays.

Defined cases: words are runs of bytes other than the six ASCII blanks; null and empty
texts have none, hence no run and an empty ``collapsed``. Equal rows are treated one by
one. Other columns pass through; those named like the result's are replaced.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revspark.llm.common import U64, WORD, mixed, quoted, sequence_hashes, slices, table

LEAST = 12
SHORT = 64
CHUNK_WORDS = 200_000   # texts worked on together hold about so many words

_BASE = 0x9E3779B97F4A7C15
_NONE = U64(0xFFFFFFFFFFFFFFFF)
_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
RESULT = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("runs", T.ArrayType(T.StructType([
        T.StructField(c, T.LongType()) for c in ("start", "length", "period")]))),
    T.StructField("collapsed", T.BinaryType()),
])

Run = tuple[int, int, int]   # start, end, period
Rewrite = Callable[[object, list[bytes]], list[bytes]]


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = len(self)
        return value


def _stretches(agree: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal True stretches of ``least`` or more."""
    breaks = np.concatenate([[-1], np.flatnonzero(~agree), [len(agree)]])
    at = np.flatnonzero(np.diff(breaks) > least)
    return breaks[at] + 1, breaks[at + 1]


def _lag_scans(x: np.ndarray) -> list[Run]:
    found = []
    for q in range(1, min(SHORT, len(x))):
        starts, ends = _stretches(x[q:] == x[:-q], max(LEAST - q, q))
        found += [(s, e + q, q) for s, e in zip(starts.tolist(), ends.tolist())]
    return found


def _extended(x: np.ndarray, at: int, q: int) -> tuple[int, int]:
    """The stretch [first, last) of words around ``at`` that equal those ``q`` later."""
    last, size = at, 64
    while True:
        b = x[last + q:last + q + size]
        a = x[last:last + len(b)]
        off = np.flatnonzero(a != b)
        if len(off) or len(b) < size:
            last += int(off[0]) if len(off) else len(b)
            break
        last, size = last + size, size * 2
    first, size = at, 64
    while first:
        low = max(first - size, 0)
        off = np.flatnonzero(x[low:first] != x[low + q:first + q])
        if len(off):
            return low + int(off[-1]) + 1, last
        first, size = low, size * 2
    return first, last


def _windowed(x: np.ndarray, n: int, best) -> np.ndarray:
    """``best`` (np.minimum or np.maximum) of every n consecutive values."""
    width = 1
    while width < n:
        step = min(width, n - width)
        x = best(x[:-step], x[step:])
        width += step
    return x


def _minimizer_pairs(h: np.ndarray, text: np.ndarray, ends: np.ndarray, known: list[Run],
                     scale: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place, distance) of equal minimizers ``scale`` to under 2 ``scale`` words apart."""
    phrase = scale // 4
    window = scale - phrase + 1
    if len(h) < scale:
        return
    value = mixed(sequence_hashes(h, phrase, _BASE))
    here = np.arange(len(value))
    value[here + phrase > ends[text[:len(value)]]] = _NONE      # runs into the next text
    for s, e, p in known:
        if 2 * p <= phrase <= e - s:
            value[s:e - phrase + 1] = _NONE
    least = _windowed(value, window, np.minimum)
    edge = np.zeros(window - 1, U64)
    reach = _windowed(np.concatenate([edge, least, edge]), window, np.maximum)
    at = np.flatnonzero((reach == value) & (value != _NONE))
    at = at[np.lexsort((at, value[at], text[at]))]
    group_text, group_value = text[at], value[at]
    for step in range(1, len(at)):
        distance = at[step:] - at[:-step]
        same = ((group_text[step:] == group_text[:-step]) & (group_value[step:] == group_value[:-step])
                & (distance < 2 * scale))
        if not same.any():
            return
        far = same & (distance >= scale)
        yield at[:-step][far], distance[far]


def _agreeing_lags(x: np.ndarray, known: list[Run], scale: int) -> Iterator[tuple[int, int]]:
    """Seeds across two touching runs of one short period."""
    long = sorted((p, s, e) for s, e, p in known if 8 * p <= scale <= e - s)
    for (p, a0, a1), (p2, b0, b1) in zip(long, long[1:]):
        if p != p2 or b0 > a1:
            continue
        turn = next((c for c in range(p) if x[a0 + c] == x[b0] and
                     (x[a0 + c:a0 + c + p] == x[b0:b0 + p]).all()), None)
        if turn is None:
            continue
        first = scale + (b0 - a0 - turn - scale) % p
        lags = np.arange(first, 2 * scale, p)
        size = np.minimum(a1, b1 - lags) - np.maximum(a0, b0 - lags)
        for q in lags[size >= lags].tolist():
            yield max(a0, b0 - q), q


def find_runs(texts: list[np.ndarray]) -> list[list[Run]]:
    """Of each text (an array of word numbers), its runs as (start, end, period)."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    ends = np.cumsum(sizes + 1) - 1                      # each text is followed by a mark
    begins = ends - sizes
    x = np.full(int(ends[-1]) + 1 if len(texts) else 0, -1, dtype=np.int32)
    for begin, t in zip(begins.tolist(), texts):
        x[begin:begin + len(t)] = t
    x[ends] = -1 - np.arange(len(texts))
    text = np.repeat(np.arange(len(texts)), sizes + 1)
    found = _lag_scans(x)
    scale = SHORT
    while len(sizes) and sizes.max() >= 2 * scale:
        # of texts that can hold two periods of this scale
        keep = np.flatnonzero(sizes >= 2 * scale)
        part = np.concatenate([np.arange(begins[i], ends[i] + 1) for i in keep])
        shift = np.zeros(len(texts), np.int64)
        part_ends = np.cumsum(sizes[keep] + 1) - 1
        shift[keep] = begins[keep] - (part_ends - sizes[keep])
        y, owner = x[part], np.repeat(np.arange(len(keep)), sizes[keep] + 1)
        moved = [(s - int(shift[text[s]]), e - int(shift[text[s]]), p) for s, e, p in found
                 if sizes[text[s]] >= 2 * scale]
        hashes = mixed(y.astype(np.int64).view(U64) * U64(_BASE) + U64(1))
        seeds = set(_agreeing_lags(y, moved, scale))
        for at, distance in _minimizer_pairs(hashes, owner, part_ends, moved, scale):
            seeds.update(zip(at.tolist(), distance.tolist()))
        passed, lag = -1, 0
        for q, at in sorted((q, at) for at, q in seeds):
            if q != lag:
                passed, lag = -1, q
            if at < passed:
                continue
            first, passed = _extended(y, at, q)
            if passed - first >= q:
                back = int(shift[keep[owner[first]]])
                found.append((first + back, passed + q + back, q))
        scale *= 2
    least: dict[tuple[int, int], int] = {}
    for s, e, q in found:
        least[s, e] = min(q, least.get((s, e), q))
    out: list[list[Run]] = [[] for _ in texts]
    for (s, e), q in least.items():
        i = int(text[s])
        out[i].append((s - int(begins[i]), e - int(begins[i]), q))
    for runs in out:
        runs.sort(key=lambda r: (r[0], r[2]))
    return out


def collapsed(words: list[bytes], runs: list[Run]) -> bytes:
    """The words outside every run's repetitions (its first period stays)."""
    if not runs:
        return b" ".join(words)
    steps = np.zeros(len(words) + 1, dtype=np.int64)
    for s, e, q in runs:
        steps[s + q] += 1
        steps[e] -= 1
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(steps)[:-1] == 0).tolist()])


def _chunks(batch: pa.RecordBatch,
            rewrite: Rewrite | None) -> Iterator[tuple[int, list[list[bytes]], list[np.ndarray]]]:
    """Row ranges of about CHUNK_WORDS words: first row, words and word numbers of each row."""
    column, keys = batch.column("input"), batch.column("key")
    rows, numbers, size, first, known = [], [], 0, 0, _Numbers()
    for i in range(batch.num_rows):
        words = WORD.findall(column[i].as_buffer() or b"") if column[i].is_valid else []
        if rewrite is not None:
            words = rewrite(keys[i].as_py(), words)
        rows.append(words)
        numbers.append(np.fromiter(map(known.__getitem__, words), dtype=np.int32, count=len(words)))
        size += len(words)
        if size >= CHUNK_WORDS:
            yield first, rows, numbers
            rows, numbers, size, first, known = [], [], 0, i + 1, _Numbers()
    if rows:
        yield first, rows, numbers


def with_runs(docs: DataFrame, text: str = "text", key: str | None = None,
              rewrite: Rewrite | None = None) -> DataFrame:
    """The rows of ``docs`` with n_words, runs (array of start, length, period, ordered by
    start and period) and collapsed (the kept words, one blank between them, as UTF-8).

    ``rewrite(value of key, words)`` may replace a row's words before the search.
    """
    others = [c for c in docs.columns if c not in RESULT.names]
    # positional names: any column name may come in, and none can clash
    source = docs.select(*(quoted(c) for c in others), quoted(text).cast("binary"),
                         quoted(key) if key else F.lit(None)).toDF(
        *(f"c{i}" for i in range(len(others))), "input", "key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1024):
            for first, rows, numbers in _chunks(batch, rewrite):
                found = find_runs(numbers)
                part = batch.slice(first, len(rows))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:len(others)],
                     pa.array([len(w) for w in rows], pa.int64()),
                     pa.array([[{"start": s, "length": e - s, "period": q} for s, e, q in runs]
                               for runs in found], _RUNS),
                     pa.array([collapsed(w, r) for w, r in zip(rows, found)], pa.binary())],
                    names=schema.names)

    schema = T.StructType([*source.schema.fields[:len(others)], *RESULT.fields])
    return source.mapInArrow(run, schema).toDF(*others, *RESULT.names)


def echoed(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The contract's input: a tenth of the documents, chosen by the crc32 of their id, repeat
    a stretch of their words up to the end. A null id is never chosen."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n = len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    unit = words[a:a + p]
    return words[:a] + (unit * -(-(n - a) // p))[:n - a]


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = with_runs(docs, key="doc_id", rewrite=echoed)
    longest = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","),
        r["period"].cast("string"), F.lit("\n")))
    return (out.withColumn("longest", longest)
            .select("doc_id", F.size("runs").cast("bigint").alias("n_runs"),
                    (-F.col("longest.start")).alias("start"), F.col("longest.length").alias("length"),
                    (-F.col("longest.period")).alias("period"),
                    F.floor(F.lit(1000) * F.col("longest.length") / -F.col("longest.period"))
                    .cast("bigint").alias("exponent_milli"),
                    F.sha2(F.concat_ws("", lines).cast("binary"), 256).alias("runs_sha256"),
                    F.sha2("collapsed", 256).alias("collapsed_sha256")))
