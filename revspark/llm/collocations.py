"""Operator 11: phrase collocations mined with weighted acyclic automata.

A count transducer is an acyclic automaton over words, one layer per word of a phrase;
a state stands for the phrase that leads to it and weighs its occurrences.

1. Shards: each task's texts, SHARD_BYTES at a time, give a window of up to LONGEST words
   at every word. The sorted windows build a transducer incrementally (a window adds
   states from its first difference to the one before it), which is cut by prefix range:
   ranges of a number made of the leading hash bits of language and words.
2. Union: each range joins its shards' transducers and sums their weights. A phrase whose
   numbers lie in one range is complete there; the few that a border cuts are told from
   every range and summed once more. All phrases are counted; those with LEAST or more stay.
3. Parts: the counted phrases become transducers by bucket, and composing them with the
   parts of the candidates that fall there gives the parts' counts.

The ranges' borders are quantiles over a sample of about SAMPLE_BYTES of text. They decide
how even the ranges are, never what is counted. Hot words, pairs or whole windows are
summed within their shard first, and a range can end within any prefix.

Defined cases: null and empty texts hold no words; a null language is ``und``; repeated rows
count each time; a table without words gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from revspark.llm.common import U64, mixed, quoted, stored, table

LONGEST = 5
LEAST = 100
TOP = 2000
SHARD_BYTES = 8 << 20
RANGE_BYTES = 4 << 20      # of text, for one range
SAMPLE_BYTES = 16 << 20
BROADCAST_LANGS = 10_000
PART_ROWS = 100_000        # lookups of one part that meet in one group

_ENDS = bytes.maketrans(b".,;:!?\x0b\x0c\r", b"\n" * 9)
_TOKEN = re.compile(rb"\n|[^\x20\x09\n]+")
_SHIFTS = [U64(s) for s in (44, 33, 22, 11, 0)]   # language 8 bits, first word 12, the others 11
_DROP = [U64(s) for s in (52, 53, 53, 53, 53)]


class CountTransducer(NamedTuple):
    """Layer by layer the states' labels (numbers of ``words``), parents and weights;
    ``final`` is the weight of the windows that end in a state."""
    words: list[bytes]
    label: list[np.ndarray]
    parent: list[np.ndarray]
    weight: list[np.ndarray]
    final: list[np.ndarray]

    @classmethod
    def of_sorted(cls, words: list[bytes], grams: np.ndarray, counts: np.ndarray) -> CountTransducer:
        """From distinct windows (rows of word numbers from 1, 0 after the end) in ascending order."""
        label, parent, weight, final = [], [], [], []
        differs = np.zeros(len(grams), bool)
        differs[:1] = True
        above = np.zeros(len(grams), np.int64)
        for depth in range(grams.shape[1]):
            column = grams[:, depth]
            differs[1:] |= column[1:] != column[:-1]
            new = differs & (column > 0)
            at = np.flatnonzero(new)
            state = np.cumsum(new) - 1
            inside = column > 0
            label.append(column[at])
            parent.append(above[at])
            sums = np.zeros(len(at), np.int64)
            ends = np.zeros(len(at), np.int64)
            np.add.at(sums, state[inside], counts[inside])
            last = inside & (grams[:, depth + 1] == 0 if depth + 1 < grams.shape[1] else True)
            np.add.at(ends, state[last], counts[last])
            weight.append(sums)
            final.append(ends)
            above = state
        return cls(words, label, parent, weight, final)

    def grams(self) -> tuple[np.ndarray, np.ndarray]:
        """The windows and their counts again, in no particular order."""
        rows, counts, path = [], [], np.zeros((1, 0), np.int64)
        for depth, (label, parent, final) in enumerate(zip(self.label, self.parent, self.final)):
            path = np.concatenate([path[parent], label[:, None]], axis=1)
            at = np.flatnonzero(final)
            rows.append(np.pad(path[at], ((0, 0), (0, len(self.label) - depth - 1))))
            counts.append(final[at])
        return np.concatenate(rows), np.concatenate(counts)

    def compose(self, phrases: list[list[int]]) -> np.ndarray:
        """The final weight of each phrase (0 where no path spells it)."""
        n, out = len(phrases), np.zeros(len(phrases), np.int64)
        size = np.array([len(p) for p in phrases])
        state, alive = np.zeros(n, np.int64), np.ones(n, bool)
        wide = len(self.words) + 1
        for depth, (label, parent, final) in enumerate(zip(self.label, self.parent, self.final)):
            here = np.flatnonzero(alive & (size > depth))
            if not len(here) or not len(label):
                break
            arcs = parent * wide + label        # ascending: states were made in sorted order
            sought = state[here] * wide + np.array([phrases[i][depth] for i in here.tolist()])
            at = np.minimum(np.searchsorted(arcs, sought), len(arcs) - 1)
            found = arcs[at] == sought
            state[here] = at
            alive[here] &= found
            done = here[found & (size[here] == depth + 1)]
            out[done] = final[state[done]]
        return out

    def pack(self) -> bytes:
        parts = []
        for label, parent, final in zip(self.label, self.parent, self.final):
            for x in (label, np.diff(parent, prepend=0), final):
                width = np.min_scalar_type(int(x.max()) if len(x) else 0).itemsize
                parts += [np.array([len(x), width], np.uint32).tobytes(), x.astype(f"u{width}").tobytes()]
        words = b"\n".join(self.words)
        return b"".join([np.uint32(len(words)).tobytes(), words, *parts])

    @classmethod
    def unpack(cls, blob: bytes) -> CountTransducer:
        size = int(np.frombuffer(blob, np.uint32, 1)[0])
        words, at = blob[4:4 + size].split(b"\n"), 4 + size
        columns = []
        for _ in range(3 * LONGEST):
            n, width = np.frombuffer(blob, np.uint32, 2, at).tolist()
            columns.append(np.frombuffer(blob, f"u{width}", n, at + 8).astype(np.int64))
            at += 8 + n * width
        return cls(words, columns[::3], [np.cumsum(x) for x in columns[1::3]], [], columns[2::3])


class _Numbers(dict):
    """Words (numbers from 1); a mark between pieces is 0."""

    def __init__(self):
        super().__init__({b"\n": 0})

    def __missing__(self, word: bytes) -> int:
        value = self[word] = len(self)
        return value


def _sorted_unique(grams: np.ndarray, counts: np.ndarray | None, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows in ascending order, with their counts summed."""
    if bits * 3 <= 64:
        b = U64(bits)
        g = grams.astype(U64)
        keys = [(g[:, 3] << b) | g[:, 4], (g[:, 0] << b << b) | (g[:, 1] << b) | g[:, 2]]
    else:
        keys = [grams[:, d] for d in reversed(range(LONGEST))]
    order = np.lexsort(keys)
    new = np.zeros(len(order), bool)
    new[:1] = True
    for k in keys:
        k = k[order]
        new[1:] |= k[1:] != k[:-1]
    at = np.flatnonzero(new)
    if counts is None:
        return grams[order[at]], np.diff(np.append(at, len(order)))
    return grams[order[at]], np.add.reduceat(counts[order], at) if len(at) else counts


def _windows(x: np.ndarray) -> np.ndarray:
    """A window of up to LONGEST words at every word of ``x`` (0: the end of a piece)."""
    padded = np.concatenate([x, np.zeros(LONGEST, x.dtype)])
    at = np.flatnonzero(x)
    out = np.zeros((len(at), LONGEST), x.dtype)
    open_ = np.ones(len(at), bool)
    for d in range(LONGEST):
        word = padded[at + d]
        open_ &= word > 0
        out[:, d] = np.where(open_, word, 0)
    return out


def _places(lang: str, words: list[bytes], grams: np.ndarray) -> np.ndarray:
    """The numbers that the ranges are made of."""
    h = np.zeros(len(words) + 1, U64)
    h[1:] = mixed(np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words), U64, count=len(words)))
    out = np.full(len(grams), U64(xxhash.xxh3_64_intdigest(lang.encode()) >> 56) << U64(56))
    for d in range(grams.shape[1]):
        out |= (h[grams[:, d]] >> _DROP[d]) << _SHIFTS[d]
    return out


def _range_of(places: np.ndarray, borders: np.ndarray) -> np.ndarray:
    return np.searchsorted(borders, (places >> U64(1)).astype(np.int64))


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes], np.ndarray]]:
    """(language, words, windows) of about SHARD_BYTES of text at a time."""
    texts: dict[str, list[bytes]] = {}
    size = 0

    def taken() -> Iterator[tuple[str, list[bytes], np.ndarray]]:
        for lang, of in texts.items():
            numbers = _Numbers()
            parts = []
            for text in of:
                tokens = _TOKEN.findall(text.lower().translate(_ENDS))
                tokens.append(b"\n")
                parts.append(np.fromiter(map(numbers.__getitem__, tokens), np.int32, count=len(tokens)))
            words = list(numbers)[1:]
            yield lang, words, _windows(np.concatenate(parts))

    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("input")):
            if not text.is_valid:
                continue
            text = text.as_py()
            texts.setdefault(lang, []).append(text)
            size += len(text)
            if size >= SHARD_BYTES:
                yield from taken()
                texts, size = {}, 0
    yield from taken()


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for lang, words, grams in _shards(batches):
        places = _places(lang, words, grams)
        yield pa.RecordBatch.from_arrays([pa.array((places >> U64(1)).astype(np.int64))], names=["place"])


def _counted(borders: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each shard's transducer, cut by range."""
        for lang, words, grams in _shards(batches):
            if not len(grams):
                continue
            grams, counts = _sorted_unique(grams, None, len(words).bit_length())
            number = _range_of(_places(lang, words, grams), borders)
            order = np.argsort(number, kind="stable")
            grams, counts, number = grams[order], counts[order], number[order]
            edges = np.append(np.flatnonzero(np.diff(number, prepend=-1)), len(number))
            blobs = []
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
                used, part = np.unique(grams[a:b], return_inverse=True)
                part = part.reshape(b - a, LONGEST) + (used[0] != 0)
                mine = [words[i - 1] for i in used.tolist() if i]
                blobs.append(CountTransducer.of_sorted(mine, part, counts[a:b]).pack())
            yield pa.RecordBatch.from_arrays(
                [pa.array(number[edges[:-1]].astype(np.int32)), pa.array([lang] * len(blobs), pa.string()),
                 pa.array(blobs, pa.binary())], names=["range", "lang", "transducer"])
    return run


def _joined(blobs: list[bytes]) -> CountTransducer:
    """Union of transducers, weights summed."""
    numbers, grams, counts = _Numbers(), [], []
    for blob in blobs:
        one = CountTransducer.unpack(blob)
        g, n = one.grams()
        to = np.fromiter((0, *map(numbers.__getitem__, one.words)), np.int64, count=len(one.words) + 1)
        grams.append(to[g].astype(np.int32))
        counts.append(n)
    rows, n = _sorted_unique(np.concatenate(grams), np.concatenate(counts), len(numbers).bit_length())
    return CountTransducer.of_sorted(list(numbers)[1:], rows, n)


_PHRASES = "lang string, phrase string, size int, n long"


def _united(borders: np.ndarray):
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        """A range's phrases that are frequent or cut by a border; all its words as size 0."""
        lang = rows.column("lang")[0].as_py()
        union = _joined(rows.column("transducer").to_pylist())
        phrases, sizes, counts = [""], [0], [int(union.weight[0].sum())]
        paths = np.zeros((1, 0), np.int64)
        for depth, (label, parent, weight) in enumerate(zip(union.label, union.parent, union.weight)):
            paths = np.concatenate([paths[parent], label[:, None]], axis=1)
            low = _places(lang, union.words, paths)
            high = low | ((U64(1) << _SHIFTS[depth]) - U64(1))
            told = np.flatnonzero((weight >= LEAST) | (_range_of(low, borders) != _range_of(high, borders)))
            for path, n in zip(paths[told].tolist(), weight[told].tolist()):
                phrases.append(b" ".join([union.words[i - 1] for i in path]).decode("utf-8", "replace"))
                sizes.append(depth + 1)
                counts.append(n)
        return pa.table([pa.array([lang] * len(sizes), pa.string()), pa.array(phrases, pa.string()),
                         pa.array(sizes, pa.int32()), pa.array(counts, pa.int64())],
                        names=["lang", "phrase", "size", "n"])
    return run


def phrase_counts(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, phrase, size, n): every phrase of one to LONGEST words with LEAST or more
    occurrences in a language; the language's word occurrences are the row of size 0."""
    rows = docs.select(F.coalesce(quoted(lang).cast("string"), F.lit("und")).alias("lang"),
                       quoted(text).cast("binary").alias("input"))
    size = rows.agg(F.sum(F.octet_length("input")).alias("n")).first()["n"] or 0
    ranges = size // RANGE_BYTES + 1
    borders = np.empty(0, np.int64)
    if ranges > 1:
        sample = rows.sample(min(1.0, SAMPLE_BYTES / size), seed=11).mapInArrow(_sampled, "place long")
        at = [i / ranges for i in range(1, ranges)]
        found = sample.agg(F.percentile_approx("place", at, 20 * ranges).alias("at")).first()["at"]
        borders = np.unique(np.array(found or [], np.int64))
    shards = rows.mapInArrow(_counted(borders), "range int, lang string, transducer binary")
    # a range's transducers of one language: AQE must not merge ranges back into few tasks
    told = shards.groupBy("range", "lang").applyInArrow(_united(borders), _PHRASES)
    return told.groupBy("lang", "phrase", "size").agg(F.sum("n").alias("n")).where(
        (F.col("n") >= LEAST) | (F.col("size") == 0))


def _looked_up(counted: pa.Table, asked: pa.Table) -> pa.Table:
    """The transducer of a bucket's phrases composed with the parts asked for."""
    numbers: dict[str, int] = {}
    number = lambda word: numbers.setdefault(word, len(numbers) + 1)

    def paths(rows: pa.Table) -> list[list[int]]:
        # the language is the first word of a path
        return [[number(f"\n{a}"), *map(number, p.split(" "))] for a, p in zip(
            rows.column("lang").to_pylist(), rows.column("part").to_pylist())] if rows.num_rows else []

    known, sought = paths(counted), paths(asked)
    out = np.zeros(len(sought), np.int64)
    if known and sought:
        grams = np.array([p + [0] * (LONGEST + 1 - len(p)) for p in known])
        order = np.lexsort([grams[:, d] for d in reversed(range(LONGEST + 1))])
        whole = CountTransducer.of_sorted([str(w).encode() for w in numbers], grams[order],
                                          counted.column("n").to_numpy()[order])
        out = whole.compose(sought)
    names = ["lang", "phrase", "a", "cut", "side"]
    kinds = [pa.string(), pa.string(), pa.int64(), pa.int32(), pa.int32()]
    return pa.table([*(asked.column(c).cast(k) if asked.num_rows else pa.array([], k) for c, k in zip(names, kinds)),
                     pa.array(out, pa.int64())], names=[*names, "n"])


def _first(words: Column, n) -> Column:
    return F.array_join(F.slice(words, 1, n), " ")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first ``top`` phrases."""
    spark = docs.sparkSession
    counted = stored(phrase_counts(docs, text, lang), "phrases")
    phrases = counted.where("size > 0")
    candidates = counted.where("size > 1").select("lang", "phrase", "size", F.col("n").alias("a"))
    words = F.split("phrase", " ")
    cut = candidates.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    parts = cut.select("lang", "phrase", "a", F.col("cut").cast("int").alias("cut"), F.posexplode(F.array(
        _first(words, F.col("cut")),
        F.array_join(F.slice(words, F.col("cut") + 1, F.col("size") - F.col("cut")), " "))).alias("side", "part"))
    hottest = parts.groupBy("lang", "part").agg(F.count(F.lit(1)).alias("k")).agg(F.max("k")).first()[0] or 0
    salts = hottest // PART_ROWS + 1
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1) * 4
    bucket = F.pmod(F.xxhash64("lang", "part"), F.lit(buckets)).cast("int").alias("bucket")
    known = phrases.select("lang", F.col("phrase").alias("part"), "n").select(
        "lang", "part", "n", bucket, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    asked = parts.select("*", bucket, F.pmod(F.xxhash64("phrase"), F.lit(salts)).cast("int").alias("salt"))
    found = known.groupBy("bucket", "salt").cogroup(asked.groupBy("bucket", "salt")).applyInArrow(
        _looked_up, "lang string, phrase string, a long, cut int, side int, n long")
    halves = found.groupBy("lang", "phrase", "a").agg(*[
        F.max(F.when((F.col("cut") == k) & (F.col("side") == s), F.col("n"))).alias(f"{side}{k}")
        for k in range(1, LONGEST) for s, side in enumerate("lr")])
    # dropped: inside a longer candidate as frequent. One word longer is enough: what lies
    # between the two is as frequent, hence a candidate as well
    inner = candidates.where("size > 2").select("lang", F.explode(F.array(
        _first(words, F.col("size") - 1), F.array_join(F.slice(words, 2, F.col("size") - 1), " "))).alias("phrase"),
        F.col("a").alias("longer"))
    inner = inner.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    total = counted.where("size = 0").select("lang", F.col("n").alias("total"))
    if total.count() <= BROADCAST_LANGS:      # a language's rows stay where they are
        total = F.broadcast(total)
    exact = "decimal(38,0)"
    scores = F.array_min(F.filter(F.array(*[F.when(F.col(f"l{k}").isNotNull(), F.struct(
        F.expr(f"(cast(1000 as {exact}) * cast(a as decimal(19,0)) * cast(total as decimal(19,0))) "
               f"div (cast(l{k} as decimal(19,0)) * cast(r{k} as decimal(19,0)))").alias("score"),
        F.lit(k).alias("cut"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")))
        for k in range(1, LONGEST)]), lambda s: s.isNotNull()))
    kept = (halves.join(inner, ["lang", "phrase"], "left")
            .where(F.col("longer").isNull() | (F.col("longer") < F.col("a")))
            .join(total, "lang").withColumn("best", scores))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (kept.select("lang", "phrase", "a", "best.l", "best.r", F.col("total").alias("n"), "best.score")
            .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
            .select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents").select("text", "lang"))


ORACLE_SQL = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), told AS (
    SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS w FROM pieces
), totals AS (
    SELECT lang, sum(len(w))::BIGINT AS n FROM told GROUP BY lang
), counted AS (
    SELECT lang, m, phrase, count(*) AS f
    FROM (SELECT lang, m, unnest(list_transform(range(1, len(w) - m + 2),
                     lambda i: array_to_string(w[i:i + m - 1], ' '))) AS phrase
          FROM told, (SELECT unnest(range(1, 6)) AS m) AS sizes WHERE len(w) >= m) AS grams
    GROUP BY lang, m, phrase HAVING count(*) >= 100
), candidates AS (
    SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM counted WHERE m >= 2
), cuts AS (
    SELECT c.lang, c.m, c.phrase, c.a, k, l.f AS l, r.f AS r,
           (1000::HUGEINT * c.a * t.n) // (l.f::HUGEINT * r.f) AS score, t.n
    FROM (SELECT *, unnest(range(1, m)) AS k FROM candidates) AS c
    JOIN totals AS t ON t.lang = c.lang
    JOIN counted AS l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:c.k], ' ')
    JOIN counted AS r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[c.k + 1:c.m], ' ')
), best AS (
    SELECT lang, m, phrase, a, n, l, r, score FROM cuts
    QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inside AS (
    SELECT c.lang, array_to_string(c.w[i:i + k - 1], ' ') AS phrase, max(c.a) AS longer
    FROM candidates AS c, (SELECT unnest(range(2, 5)) AS k) AS sizes, (SELECT unnest(range(1, 5)) AS i) AS starts
    WHERE k < c.m AND i + k - 1 <= c.m GROUP BY ALL
), kept AS (
    SELECT b.* FROM best AS b LEFT JOIN inside AS i ON i.lang = b.lang AND i.phrase = b.phrase
    WHERE i.longer IS NULL OR i.longer < b.a
)
SELECT * FROM (
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank,
           phrase, a, l, r, n, score::BIGINT AS score
    FROM kept) AS ranked
WHERE rank <= 2000
"""
