"""Operator 8: removal of repeated passages by sharded phrase automata.

A window is WINDOW consecutive words of one document; a word goes if a window
over it has the same words as a window that starts anywhere else.

1. Census: of the PHRASE-word phrases of a window the one with the smallest hash is its
   anchor; consecutive windows of one anchor are a piece. Equal windows have equal
   anchors, so that a window can only repeat if its anchor does. Documents are dealt to
   shards of about SHARD_BYTES; buckets of the anchors' hashes find those that recur.
2. Confirmation: each shard sends one copy of each of its pieces with a recurring anchor,
   and how often it occurs, to the anchor's bucket. Counting the windows there confirms
   the passages: stretches whose every window starts in two places or more.
3. Automata: each bucket compiles its passages to an Aho-Corasick automaton over words
   and streams the pieces of all documents through it. What it finds goes back to the
   shards, as places in their pieces.
4. Removal: each shard cuts what the automata found out of its documents.

A piece in many documents is one row per shard. An anchor with more than HOT distinct
pieces has its windows sent one by one, dealt by their hash to as many parts of the bucket
as that takes, so that a phrase that is common everywhere fills no single automaton.

Defined cases: words are runs of bytes other than the six ASCII blanks, compared
unchanged; null and empty texts have none; documents under WINDOW words keep all.
Equal rows are documents that repeat each other. Pieces are told apart within a shard by
128 bits, passages by their words. Other columns pass through, those named like the
result's are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revspark.llm.common import U64, WORD, WordHash, mixed, quoted, sequence_hashes, table, use

WINDOW = 35
PHRASE = 12
SHARD_BYTES = 4 << 20
CHUNK_WORDS = 1 << 17     # words whose anchors are found together
HOT = 4096

_BASE, _SECOND = 0x9E3779B97F4A7C15, 0xD1B54A32D192ED03
_WORDS = WordHash()
_RESULT = ["n_words", "n_removed", "kept"]


def _least(x: np.ndarray, n: int) -> np.ndarray:
    """Minimum of every run of n values."""
    width = 1
    while width < n:
        step = min(width, n - width)
        x = np.minimum(x[:-step], x[step:])
        width += step
    return x


def _each(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of every range, one range after the other."""
    ends = np.cumsum(counts)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - counts), counts)


def _starts(*keys: np.ndarray) -> np.ndarray:
    """Where a new group begins in arrays that are ordered by the keys."""
    new = np.zeros(len(keys[0]), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def pieces(hashes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of texts laid end to end (word hashes; one past each text's last word): each piece's
    anchor hash, content hash, first window and number of windows."""
    n = len(hashes) - WINDOW + 1
    if n < 1:
        none = np.empty(0, np.int64)
        return none.view(U64), none.view(U64), none, none
    phrase = mixed(sequence_hashes(hashes, PHRASE, _BASE))
    bits = U64(len(phrase).bit_length())
    # the place in the low bits: the first of equal phrases counts, and is known
    anchor = (_least((phrase >> bits << bits) | np.arange(len(phrase), dtype=U64), WINDOW - PHRASE + 1)
              & ((U64(1) << bits) - U64(1))).astype(np.int64)
    at = np.flatnonzero(np.arange(n) + WINDOW <= np.repeat(ends, np.diff(ends, prepend=0))[:n])
    a = anchor[at]
    new = np.flatnonzero(np.concatenate([np.ones(min(len(at), 1), bool), (a[1:] != a[:-1]) | (np.diff(at) != 1)]))
    first, count = at[new], np.diff(np.append(new, len(at)))
    windows = sequence_hashes(hashes, WINDOW, _SECOND)
    content = mixed(mixed(windows[first]) + windows[first + count - 1] * U64(_BASE) + count.astype(U64))
    # minima are small numbers: mixed once more they fill the buckets evenly
    return mixed(phrase[a[new]] + U64(_SECOND)), content, first, count


class Shard:
    """The texts of one shard in order, their words, and the pieces of these."""

    def __init__(self, rows: pa.Table):
        texts = [t or b"" for t in rows.column("input").to_pylist()]
        self.number = rows.column("shard")[0].as_py()
        self.order = sorted(range(len(texts)), key=texts.__getitem__)
        self.words: list[bytes] = []
        sizes, hashes = [], []
        for i in self.order:
            words = WORD.findall(texts[i])
            use(_WORDS)
            hashes.append(_WORDS.of(words))
            sizes.append(len(words))
            self.words += words
        self.sizes = np.array(sizes, dtype=np.int64)
        ends, all_hashes = np.cumsum(self.sizes), np.concatenate(hashes)
        parts, at, i = [], 0, 0
        while i < len(ends):
            j = max(int(np.searchsorted(ends, at + CHUNK_WORDS, side="right")), i + 1)
            key, content, first, count = pieces(all_hashes[at:ends[j - 1]], ends[i:j] - at)
            parts.append((key, content, first + at, count))
            at, i = int(ends[j - 1]), j
        self.key, self.content, self.first, self.count = (np.concatenate(c) for c in zip(*parts))
        order = np.lexsort((self.content, self.key))
        starts = _starts(self.key[order], self.content[order])
        times = np.diff(np.append(starts, len(order)))
        self.same = np.empty(len(order), np.int64)        # the first occurrence of each one's words
        self.same[order] = np.repeat(order[starts], times)
        self.times = np.zeros(len(order), np.int64)
        self.times[order[starts]] = times


def _cut(values: np.ndarray, edges: np.ndarray) -> list[bytes]:
    return [values[a:b].tobytes() for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]


def _names(key: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, name within the bucket) of an anchor: its hash's first bits, the next 32."""
    return (key >> U64(64 - bits)).astype(np.int32), (key >> U64(32 - bits)).astype(np.uint32)


def _census(bits: int):
    def run(rows: pa.Table) -> pa.Table:
        """Per bucket the names of the shard's anchors and the distinct pieces of each (two at
        least, if it occurs twice)."""
        shard = Shard(rows)
        distinct = np.flatnonzero(shard.times)
        order = distinct[np.argsort(shard.key[distinct], kind="stable")]
        starts = _starts(shard.key[order])
        n = np.diff(np.append(starts, len(order)))
        occurrences = np.add.reduceat(shard.times[order], starts) if len(starts) else n
        bucket, name = _names(shard.key[order[starts]], bits)
        edges = np.append(_starts(bucket), len(bucket))
        return pa.table({"shard": pa.array([shard.number] * (len(edges) - 1), pa.int32()),
                         "bucket": pa.array(bucket[edges[:-1]], pa.int32()),
                         "names": pa.array(_cut(name, edges), pa.binary()),
                         "times": pa.array(_cut(np.maximum(n, np.minimum(occurrences, 2)).astype(np.uint32), edges),
                                           pa.binary())})
    return run


def _recurring(rows: pa.Table) -> pa.Table:
    """Of a bucket, per shard the anchors that recur, and the power of two of parts that the
    windows of each go to (0: the pieces go whole)."""
    blobs = [np.frombuffer(b, np.uint32) for b in rows.column("names").to_pylist()]
    every = np.concatenate(blobs)
    times = np.concatenate([np.frombuffer(b, np.uint32) for b in rows.column("times").to_pylist()])
    order = np.argsort(every, kind="stable")
    starts = _starts(every[order])
    names, n = every[order][starts], np.add.reduceat(times[order].astype(np.int64), starts)
    names, n = names[n > 1], n[n > 1]
    parts = np.where(n > HOT, np.ceil(np.log2(np.maximum(n, HOT) / HOT)) + 1, 0).astype(np.uint8)
    kept = [np.isin(names, blob) for blob in blobs]
    return pa.table({"shard": rows.column("shard"), "bucket": rows.column("bucket"),
                     "names": pa.array([names[k].tobytes() for k in kept], pa.binary()),
                     "parts": pa.array([parts[k].tobytes() for k in kept], pa.binary())})


_SENT = "bucket int, part long, shard int, piece binary, skipped binary, times binary, words binary"


def _sent(bits: int):
    schema = pa.schema([("bucket", pa.int32()), ("part", pa.int64()), ("shard", pa.int32())]
                       + [(c, pa.binary()) for c in ("piece", "skipped", "times", "words")])

    def run(rows: pa.Table, recurring: pa.Table) -> pa.Table:
        """A copy of each distinct piece with a recurring anchor, per bucket and part."""
        if not rows.num_rows or not recurring.num_rows:
            return schema.empty_table()
        shard = Shard(rows)
        names = np.concatenate([(b << 32) | np.frombuffer(x, np.uint32).astype(np.int64) for b, x in zip(
            recurring.column("bucket").to_pylist(), recurring.column("names").to_pylist())])
        parts = np.frombuffer(b"".join(recurring.column("parts").to_pylist()), np.uint8)
        order = np.argsort(names)
        names, parts = names[order], parts[order]
        one = np.flatnonzero(shard.times)
        bucket, name = _names(shard.key[one], bits)
        full = (bucket.astype(np.int64) << 32) | name
        where = np.minimum(np.searchsorted(names, full), max(len(names) - 1, 0))
        hit = names[where] == full if len(names) else np.zeros(len(full), bool)
        one, bucket, spread = one[hit], bucket[hit], parts[where[hit]]
        # hot anchors: window by window, dealt by their words
        hot, cold = np.flatnonzero(spread), np.flatnonzero(spread == 0)
        at = _each(shard.first[one[hot]], shard.count[one[hot]])
        mine = np.repeat(hot, shard.count[one[hot]])
        dealt = np.fromiter((xxhash.xxh3_64_intdigest(b" ".join(shard.words[i:i + WINDOW])) for i in at.tolist()),
                            U64, count=len(at))
        dealt = 1 + (dealt & ((U64(1) << spread[mine].astype(U64)) - U64(1))).astype(np.int64)
        owner = np.concatenate([cold, mine])
        first = np.concatenate([shard.first[one[cold]], at])
        size = np.concatenate([shard.count[one[cold]] + WINDOW - 1, np.full(len(at), WINDOW, np.int64)])
        part = np.concatenate([np.zeros(len(cold), np.int64), dealt])
        order = np.lexsort((part, bucket[owner]))
        owner, first, size, part = owner[order], first[order], size[order], part[order]
        b, piece = bucket[owner], one[owner]
        edges = np.append(_starts(b, part), len(b))
        texts = [b" ".join(shard.words[i:i + n]) for i, n in zip(first.tolist(), size.tolist())]
        return pa.table([
            pa.array(b[edges[:-1]], pa.int32()), pa.array(part[edges[:-1]], pa.int64()),
            pa.array([shard.number] * (len(edges) - 1), pa.int32()),
            pa.array(_cut(piece.astype(np.int32), edges), pa.binary()),
            pa.array(_cut((first - shard.first[piece]).astype(np.int32), edges), pa.binary()),
            pa.array(_cut(shard.times[piece].astype(np.uint32), edges), pa.binary()),
            pa.array([b"\n".join(texts[x:y]) for x, y in zip(edges[:-1].tolist(), edges[1:].tolist())], pa.binary()),
        ], schema=schema)
    return run


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = len(self)
        return value


def confirmed(texts: list[np.ndarray], times: np.ndarray) -> list[list[tuple[int, int]]]:
    """Of each text (word numbers), the stretches whose every window starts in two places or
    more of the texts, each counted ``times``; as (first word, one past the last)."""
    sizes = np.array([len(t) for t in texts])
    joined = np.concatenate(texts).astype(np.int32)
    counts = sizes - WINDOW + 1
    begins = np.cumsum(sizes) - sizes
    at, owner = _each(begins, counts), np.repeat(np.arange(len(texts)), counts)
    data = joined.tobytes()
    seen: dict[bytes, int] = {}
    width = 4 * WINDOW
    number = np.fromiter((seen.setdefault(data[i:i + width], len(seen)) for i in (at * 4).tolist()),
                         np.int64, count=len(at))
    total = np.bincount(number, weights=times[owner], minlength=len(seen))
    again = total[number] > 1
    out: list[list[tuple[int, int]]] = [[] for _ in texts]
    kept = np.flatnonzero(again)
    edges = np.append(np.flatnonzero(np.concatenate([
        np.ones(min(len(kept), 1), bool), (np.diff(kept) != 1) | (np.diff(owner[kept]) != 0)])), len(kept))
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
        i = int(owner[kept[a]])
        out[i].append((int(at[kept[a]] - begins[i]), int(at[kept[b - 1]] - begins[i]) + WINDOW))
    return out


_FOUND = "shard int, runs binary"


def _located(rows: pa.Table) -> pa.Table:
    """Per shard what the bucket's automaton finds: (piece, words skipped, words)."""
    ints = lambda c, kind: np.frombuffer(b"".join(rows.column(c).to_pylist()), kind).astype(np.int64)
    piece, skipped, times = ints("piece", np.int32), ints("skipped", np.int32), ints("times", np.uint32)
    shard = np.repeat(rows.column("shard").to_numpy().astype(np.int64),
                      [len(b) // 4 for b in rows.column("piece").to_pylist()])
    # equal pieces of several shards are one text, with the occurrences of all
    numbers: dict[bytes, int] = {}
    which = np.fromiter((numbers.setdefault(t, len(numbers)) for blob in rows.column("words").to_pylist()
                         for t in blob.split(b"\n")), np.int64, count=len(piece))
    words = _Numbers()
    texts = [np.fromiter(map(words.__getitem__, t.split(b" ")), np.int32) for t in numbers]
    passages = {t[a:b].tobytes() for t, runs in zip(texts, confirmed(
        texts, np.bincount(which, weights=times, minlength=len(texts)))) for a, b in runs}
    found, told = [], np.zeros(len(texts) + 1, np.int64)
    if passages:
        automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH, ahocorasick.KEY_SEQUENCE)
        for p in passages:
            automaton.add_word(tuple(np.frombuffer(p, np.int32).tolist()))
        automaton.make_automaton()
        for i, t in enumerate(texts):
            hits: list[list[int]] = []
            for last, size in automaton.iter(tuple(t.tolist())):
                first = last - size + 1
                while hits and hits[-1][0] >= first:        # inside the longer one that ends here
                    hits.pop()
                if not hits or hits[-1][1] <= last:
                    hits.append([first, last + 1])
            found += hits
            told[i + 1] = len(hits)
    runs = np.array(found, np.int64).reshape(-1, 2)
    begin = np.cumsum(told)
    n = told[1:][which]
    run, member = _each(begin[which], n), np.repeat(np.arange(len(which)), n)
    order = np.argsort(shard[member], kind="stable")
    run, member = run[order], member[order]
    to = shard[member]
    edges = np.append(_starts(to), len(to))
    facts = [piece[member], skipped[member] + runs[run, 0], runs[run, 1] - runs[run, 0]]
    return pa.table({"shard": pa.array(to[edges[:-1]].astype(np.int32), pa.int32()),
                     "runs": pa.array([np.concatenate([f[a:b] for f in facts]).astype(np.int32).tobytes()
                                       for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())], pa.binary())})


def _gone(shard: Shard, found: pa.Table) -> np.ndarray:
    """Which words of the shard the automata found, at every occurrence of the pieces."""
    told = [np.frombuffer(b, np.int32).reshape(3, -1).astype(np.int64) for b in found.column("runs").to_pylist()]
    piece, skip, size = np.concatenate(told, axis=1) if told else np.empty((3, 0), np.int64)
    order = np.argsort(piece, kind="stable")
    piece, skip, size = piece[order], skip[order], size[order]
    n = np.bincount(piece, minlength=len(shard.same))
    begin = np.cumsum(n) - n
    mine = np.flatnonzero(n[shard.same]) if len(shard.same) else np.empty(0, np.int64)
    times = n[shard.same[mine]]
    run = _each(begin[shard.same[mine]], times)
    first = np.repeat(shard.first[mine], times) + skip[run]
    steps = np.bincount(first, minlength=len(shard.words) + 1) - np.bincount(
        first + size[run], minlength=len(shard.words) + 1)
    return np.cumsum(steps)[:-1] > 0


def _removed(inner: list[str]):
    def run(rows: pa.Table, found: pa.Table) -> pa.Table:
        """The rows with n_words, n_removed and the kept words."""
        n_words, n_removed, kept, order = [], [], [], []
        if rows.num_rows:
            shard = Shard(rows)
            order, gone, at = shard.order, _gone(shard, found), 0
            for size in shard.sizes.tolist():
                words, off = shard.words[at:at + size], gone[at:at + size]
                lost = int(np.count_nonzero(off))
                n_words.append(size)
                n_removed.append(lost)
                kept.append(b" ".join([words[i] for i in np.flatnonzero(~off).tolist()] if lost else words))
                at += size
        rows = rows.take(pa.array(order, pa.int64()))
        return pa.table([*(rows.column(c) for c in [*inner, "input"]), pa.array(n_words, pa.int64()),
                         pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary())],
                        names=[*inner, "input", *_RESULT])
    return run


def without_repeats(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` with n_words, n_removed and kept (the kept words, one blank
    between them, as UTF-8 bytes)."""
    size = docs.agg(F.sum(F.octet_length(quoted(text))).alias("n")).first()["n"] or 0
    shards = size // SHARD_BYTES + 1
    bits = min(max(int(4 * shards).bit_length(), 6), 24)
    names = [c for c in docs.columns if c not in _RESULT]
    others = [c for c in names if c != text]
    inner = [f"c{i}" for i in range(len(others))]
    base = docs.select(*(quoted(c) for c in others), quoted(text).cast("binary")).toDF(*inner, "input")
    # equal texts part by their other columns, equal rows by their partition: no shard fills with copies
    spread = [c for c, kind in base.dtypes if "map<" not in kind and "variant" not in kind]
    base = base.withColumn("shard", F.pmod(F.xxhash64(*spread, F.spark_partition_id()), F.lit(shards)).cast("int"))
    by_shard = base.groupBy("shard")      # one shuffle of the texts, read three times
    census = by_shard.applyInArrow(_census(bits), "shard int, bucket int, names binary, times binary")
    recurring = census.groupBy("bucket").applyInArrow(_recurring, "shard int, bucket int, names binary, parts binary")
    sent = by_shard.cogroup(recurring.groupBy("shard")).applyInArrow(_sent(bits), _SENT)
    found = sent.groupBy("bucket", "part").applyInArrow(_located, _FOUND)
    schema = T.StructType([*(base.schema[c] for c in [*inner, "input"]), T.StructField("n_words", T.LongType()),
                           T.StructField("n_removed", T.LongType()), T.StructField("kept", T.BinaryType())])
    out = by_shard.cogroup(found.groupBy("shard")).applyInArrow(_removed(inner), schema)
    source = {**{c: quoted(i) for c, i in zip(others, inner)}, text: F.col("input").cast(docs.schema[text].dataType)}
    return out.select(*(source[c].alias(c) for c in names), *_RESULT)


def deduplicated(docs: DataFrame) -> DataFrame:
    """``docs`` with text (and n_chars, if there is one) of what is kept; texts without a
    repeated passage stay as they are."""
    names = docs.columns
    places = [f"c{i}" for i in range(len(names))]
    at = dict(zip(names, places))
    out = without_repeats(docs.toDF(*places), at["text"])
    changed, kept = F.col("n_removed") > 0, F.col("kept").cast("string")
    new = {"text": F.when(changed, kept).otherwise(F.col(at["text"]))}
    if "n_chars" in names:
        new["n_chars"] = F.when(changed, F.length(kept)).otherwise(F.col(at["n_chars"])).cast(
            docs.schema["n_chars"].dataType)
    return out.select(*(new.get(c, F.col(p)) for c, p in at.items())).toDF(*names)


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return without_repeats(docs).select("doc_id", "n_words", "n_removed",
                                        F.sha2("kept", 256).alias("kept_sha256"))


ORACLE_SQL = r"""
WITH words AS (
    SELECT row_number() OVER () AS row, doc_id,
           list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
    FROM documents
), windows AS (
    SELECT row, unnest(range(1, len(w) - 33)) AS i, w FROM words WHERE len(w) >= 35
), hashed AS (
    SELECT row, i, md5(array_to_string(w[i:i + 34], ' ')) AS h FROM windows
), again AS (
    SELECT h FROM hashed GROUP BY h HAVING count(*) > 1
), gone AS (
    SELECT DISTINCT row, unnest(range(i, i + 35)) AS i FROM hashed WHERE h IN (SELECT h FROM again)
), lost AS (
    SELECT row, list(i) AS gone FROM gone GROUP BY row
), kept AS (
    SELECT row, coalesce(string_agg(word, ' ' ORDER BY i), '') AS kept
    FROM (SELECT row, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM words) AS each
    WHERE NOT EXISTS (SELECT 1 FROM gone WHERE gone.row = each.row AND gone.i = each.i) GROUP BY row
)
SELECT doc_id, len(w) AS n_words, coalesce(len(lost.gone), 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM words LEFT JOIN lost ON lost.row = words.row LEFT JOIN kept ON kept.row = words.row
"""
