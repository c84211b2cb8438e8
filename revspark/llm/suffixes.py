"""Operator 13: removal of repeated byte strings through two-stage suffix arrays.

A string is LENGTH consecutive bytes of one document; a byte goes if a string over it
also starts in a document with a smaller id.

1. Survey: of the PHRASE-byte phrases in a string the one with the least hash is its
   anchor. Consecutive strings of one anchor make a piece (their joint bytes). Equal
   strings have equal anchors, so that they can only meet in pieces of one anchor.
   Documents are dealt to shards of about SHARD_BYTES; each shard counts the distinct
   pieces of its anchors, and buckets of the anchors' hashes find those that recur.
2. Suffix arrays: each shard sends one copy of each of its pieces with a recurring
   anchor, with the least document id, to the anchor's bucket. A bucket sorts the
   suffixes that begin a string: those smaller than their successors directly, the rest
   induced by scans of the first-byte buckets; adjacent common prefixes of LENGTH or more
   join them to groups, and a group's least document id goes back to the shards.
3. Removal: each shard drops the bytes under strings whose group has a smaller id.

A piece in many documents is one row per shard. An anchor with more than HOT distinct
pieces has its strings sent one by one, dealt by their hash to as many parts of the bucket
as that takes, so that a phrase that is common everywhere fills no single group.

Defined cases: null and empty texts have no bytes; rows with a null id keep all and take
nothing from others; rows with equal ids take nothing from each other. Pieces are told
apart within a shard by 128 bits, strings by their bytes. Other columns pass through,
those named like the result's are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revspark.llm.common import U64, mixed, quoted, table

LENGTH = 50
PHRASE = 16
SHARD_BYTES = 4 << 20
CHUNK_BYTES = 1 << 19     # documents are surveyed together up to about this size
HOT = 4096

_ONE, _TWO = U64(0x9E3779B97F4A7C15), U64(0xD1B54A32D192ED03)
RESULT = T.StructType([T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans")]
                      + [T.StructField("kept", T.BinaryType())])


def _words(data: np.ndarray) -> np.ndarray:
    """The eight bytes at every place, first byte highest; zeros follow the end."""
    x = np.zeros(len(data) + 7, dtype=U64)
    x[:len(data)] = data
    x = (x[:-1] << U64(8)) | x[1:]
    x = (x[:-2] << U64(16)) | x[2:]
    return (x[:-4] << U64(32)) | x[4:]


def _least(x: np.ndarray, n: int) -> np.ndarray:
    """Minimum of every n consecutive values."""
    width = 1
    while width < n:
        step = min(width, n - width)
        x = np.minimum(x[:-step], x[step:])
        width += step
    return x


def _spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """All of start, start + 1, ... of every range, one after the other."""
    ends = np.cumsum(counts)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - counts), counts)


class Pieces(NamedTuple):
    key: np.ndarray       # hash of the anchor
    content: np.ndarray   # hash of the bytes
    first: np.ndarray     # place of the first string
    count: np.ndarray     # strings


def pieces(data: np.ndarray, ends: np.ndarray) -> Pieces:
    """The pieces of documents laid end to end (``ends``: one past each one's last byte)."""
    n = len(data) - LENGTH + 1
    none = np.empty(0, U64)
    if n < 1:
        return Pieces(none, none, none.astype(np.int64), none.astype(np.int64))
    words = _words(data)
    size = len(data) - PHRASE + 1
    h = mixed(words[:size] * _ONE)
    for at in range(8, PHRASE, 8):
        h = mixed(h + words[at:at + size] * _TWO)
    bits = U64(int(size).bit_length())
    # the place in the low bits: the first of equal phrases counts, and is known
    anchor = (_least((h >> bits << bits) | np.arange(size, dtype=U64), LENGTH - PHRASE + 1)
              & ((U64(1) << bits) - U64(1))).astype(np.int64)
    whole = np.arange(n) + LENGTH <= np.repeat(ends, np.diff(ends, prepend=0))[:n]
    at = np.flatnonzero(whole)
    a = anchor[at]
    new = np.flatnonzero(np.concatenate([np.ones(min(len(at), 1), bool), (a[1:] != a[:-1]) | (np.diff(at) != 1)]))
    first, count = at[new], np.diff(np.append(new, len(at)))
    last = first + count + LENGTH - 9
    content = np.full(len(first), _TWO)
    for step in range(0, 2 * LENGTH - PHRASE, 8):
        content = mixed(content + words[np.minimum(first + step, last)] * _ONE)
    # minima are small numbers: mixed once more they fill the buckets evenly
    return Pieces(mixed(h[a[new]] + _TWO), content + count.astype(U64), first, count)


class Shard:
    """The documents of one shard, ordered by id and text, and their pieces."""

    def __init__(self, rows: pa.Table):
        ids, texts = rows.column("id").to_pylist(), rows.column("input").to_pylist()
        texts = [t or b"" for t in texts]
        self.order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0, texts[i]))
        self.texts = [texts[i] for i in self.order]
        self.sizes = np.array([len(t) for t in self.texts], dtype=np.int64)
        self.data = np.frombuffer(b"".join(self.texts), dtype=np.uint8)
        ends = np.cumsum(self.sizes)
        known = sum(x is not None for x in ids)      # rows without an id come last, and have no pieces
        id_of = np.array([ids[i] for i in self.order[:known]], dtype=np.int64)
        parts, at, i = [], 0, 0
        while i < known:
            j = int(np.searchsorted(ends[:known], at + CHUNK_BYTES, side="right"))
            j = max(j, i + 1)
            part = pieces(self.data[at:ends[j - 1]], ends[i:j] - at)
            parts.append(part._replace(first=part.first + at))
            at, i = int(ends[j - 1]), j
        whole = parts or [pieces(self.data[:0], ends[:0])]
        self.key, self.content, self.first, self.count = (np.concatenate(c) for c in zip(*whole))
        self.id = id_of[np.searchsorted(ends[:known], self.first, side="right")] if known else self.first
        order = np.lexsort((self.content, self.key))      # stable: the least id of a piece first
        key, content = self.key[order], self.content[order]
        new = np.concatenate([np.ones(min(len(key), 1), bool), (key[1:] != key[:-1]) | (content[1:] != content[:-1])])
        self.same = np.empty(len(order), np.int64)        # the first occurrence of each one's bytes
        self.same[order] = order[np.flatnonzero(new)][np.cumsum(new) - 1]


def _cut(values: np.ndarray, edges: np.ndarray) -> list[bytes]:
    return [values[a:b].tobytes() for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]


def _names(key: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, name within the bucket) of an anchor: its hash's first bits, the next 32."""
    return (key >> U64(64 - bits)).astype(np.int32), (key >> U64(32 - bits)).astype(np.uint32)


def _surveyed(bits: int):
    def run(rows: pa.Table) -> pa.Table:
        """Per bucket the names of the shard's anchors and the distinct pieces of each (two at
        least, if in two documents)."""
        shard = Shard(rows)
        order = np.lexsort((shard.id, shard.key))
        key, ids = shard.key[order], shard.id[order]
        starts = np.flatnonzero(np.concatenate([np.ones(min(len(key), 1), bool), key[1:] != key[:-1]]))
        times = np.empty(0, np.int64)
        if len(key):
            distinct = (shard.same == np.arange(len(shard.same)))[order]
            two = ids[np.append(starts[1:], len(key)) - 1] != ids[starts]
            times = np.maximum(np.add.reduceat(distinct.astype(np.int64), starts), 1 + two)
        bucket, name = _names(key[starts], bits)
        edges = np.concatenate([np.flatnonzero(np.diff(bucket, prepend=-1)), [len(bucket)]])
        number = rows.column("shard")[0].as_py()
        return pa.table({"shard": pa.array([number] * (len(edges) - 1), pa.int32()),
                         "bucket": pa.array(bucket[edges[:-1]], pa.int32()),
                         "names": pa.array(_cut(name, edges), pa.binary()),
                         "times": pa.array(_cut(times.astype(np.uint32), edges), pa.binary())})
    return run


def _recurring(rows: pa.Table) -> pa.Table:
    """Of a bucket, per shard the anchors that recur, and the power of two of parts that the
    strings of each go to (0: the pieces go whole)."""
    blobs = [np.frombuffer(b, np.uint32) for b in rows.column("names").to_pylist()]
    every = np.concatenate(blobs)
    times = np.concatenate([np.frombuffer(b, np.uint32) for b in rows.column("times").to_pylist()])
    order = np.argsort(every, kind="stable")
    starts = np.flatnonzero(np.diff(every[order].astype(np.int64), prepend=-1))
    names, n = every[order][starts], np.add.reduceat(times[order].astype(np.int64), starts)
    names, n = names[n > 1], n[n > 1]
    parts = np.where(n > HOT, np.ceil(np.log2(np.maximum(n, HOT) / HOT)) + 1, 0).astype(np.uint8)
    out_names, out_parts = [], []
    for blob in blobs:
        at = np.flatnonzero(np.isin(names, blob))
        out_names.append(names[at].tobytes())
        out_parts.append(parts[at].tobytes())
    return pa.table({"shard": rows.column("shard"), "bucket": rows.column("bucket"),
                     "names": pa.array(out_names, pa.binary()), "parts": pa.array(out_parts, pa.binary())})


_SENT = "bucket int, part long, shard int, piece binary, skipped binary, size binary, id binary, bytes binary"


def _sent(bits: int):
    schema = pa.schema([("bucket", pa.int32()), ("part", pa.int64()), ("shard", pa.int32())]
                       + [(c, pa.binary()) for c in ("piece", "skipped", "size", "id", "bytes")])

    def run(rows: pa.Table, recurring: pa.Table) -> pa.Table:
        """A copy of each distinct piece with a recurring anchor, per bucket and part."""
        if not rows.num_rows or not recurring.num_rows:
            return schema.empty_table()
        shard = Shard(rows)
        known = [((b << 32) | np.frombuffer(x, np.uint32).astype(np.int64), np.frombuffer(y, np.uint8))
                 for b, x, y in zip(recurring.column("bucket").to_pylist(),
                                    recurring.column("names").to_pylist(), recurring.column("parts").to_pylist())]
        names, parts = (np.concatenate(c) for c in zip(*known))
        order = np.argsort(names)
        names, parts = names[order], parts[order]
        one = np.flatnonzero(shard.same == np.arange(len(shard.same)))
        bucket, name = _names(shard.key[one], bits)
        full = (bucket.astype(np.int64) << 32) | name
        where = np.minimum(np.searchsorted(names, full), max(len(names) - 1, 0))
        hit = names[where] == full if len(names) else np.zeros(len(full), bool)
        one, bucket, spread = one[hit], bucket[hit], parts[where[hit]]
        data = shard.data.tobytes()
        # hot anchors: string by string, dealt by their bytes
        hot = np.flatnonzero(spread)
        at = _spread(shard.first[one[hot]], shard.count[one[hot]])
        owner = np.repeat(hot, shard.count[one[hot]])
        dealt = np.fromiter((xxhash.xxh3_64_intdigest(data[i:i + LENGTH]) for i in at.tolist()), U64, count=len(at))
        dealt = 1 + (dealt & ((U64(1) << spread[owner].astype(U64)) - U64(1))).astype(np.int64)
        cold = np.flatnonzero(spread == 0)
        owner = np.concatenate([cold, owner])
        first = np.concatenate([shard.first[one[cold]], at])
        size = np.concatenate([shard.count[one[cold]] + LENGTH - 1, np.full(len(at), LENGTH, np.int64)])
        part = np.concatenate([np.zeros(len(cold), np.int64), dealt])
        order = np.lexsort((part, bucket[owner]))
        owner, first, size, part = owner[order], first[order], size[order], part[order]
        b, piece = bucket[owner], one[owner]
        edges = np.flatnonzero(np.concatenate([np.ones(min(len(b), 1), bool), (b[1:] != b[:-1]) | (part[1:] != part[:-1])]))
        edges = np.append(edges, len(b))
        span = np.concatenate([[0], np.cumsum(size)])
        taken = shard.data[_spread(first, size)]
        return pa.table([
            pa.array(b[edges[:-1]], pa.int32()), pa.array(part[edges[:-1]], pa.int64()),
            pa.array([rows.column("shard")[0].as_py()] * (len(edges) - 1), pa.int32()),
            pa.array(_cut(piece.astype(np.int32), edges), pa.binary()),
            pa.array(_cut((first - shard.first[piece]).astype(np.int32), edges), pa.binary()),
            pa.array(_cut(size.astype(np.int32), edges), pa.binary()),
            pa.array(_cut(shard.id[piece], edges), pa.binary()),
            pa.array(_cut(taken, span[edges]), pa.binary())], schema=schema)
    return run


def _direct(words: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Places ordered by the LENGTH bytes that follow, eight at a time; what is still tied
    with a neighbour goes on to the next eight."""
    at = at[np.argsort(words[at], kind="stable")]
    key = words[at]
    tied = np.arange(len(at))
    group = np.cumsum(np.concatenate([[0], key[1:] != key[:-1]])) if len(at) else tied
    for depth in range(8, LENGTH, 8):
        size = np.bincount(group)
        more = size[group] > 1
        tied, group = tied[more], group[more]
        if not len(tied):
            break
        key = words[np.minimum(at[tied] + depth, len(words) - 1)]
        order = np.lexsort((key, group))
        at[tied] = at[tied][order]
        key = key[order]
        group = np.cumsum(np.concatenate([[0], (key[1:] != key[:-1]) | (group[1:] != group[:-1])]))
    return at


def two_stage(data: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The wanted places (ascending) in the order of their suffixes (LENGTH bytes at least).

    Suffixes smaller than their successors are sorted directly. A scan over the first-byte
    buckets in ascending order then meets each suffix before the larger one that starts a
    byte before it, and appends that one to its own bucket.
    """
    n = len(data)
    if not len(wanted):
        return wanted
    other = np.append(np.flatnonzero(data[1:] != data[:-1]), n - 1)       # last place of each run of one byte
    rising_end = np.append(data[1:] > data[:-1], False)[other]
    rising = np.repeat(rising_end, np.diff(other, prepend=-1))
    # up to the next rising place, every successor takes part
    rises = np.flatnonzero(rising)
    stop = np.searchsorted(rises, wanted)
    stop = np.where(stop < len(rises), rises[np.minimum(stop, max(len(rises) - 1, 0))] if len(rises) else n - 1, n - 1)
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, wanted, 1)
    np.add.at(steps, stop + 1, -1)
    member = np.cumsum(steps[:n]) > 0
    words = _words(data)
    sorted_rising = _direct(words, np.flatnonzero(member & rising))
    cuts = np.searchsorted(data[sorted_rising], np.arange(257))
    induced: list[list[np.ndarray]] = [[] for _ in range(256)]
    if member[n - 1]:
        induced[data[n - 1]].append(np.array([n - 1]))
    falling = member & ~rising
    out = []
    for byte in range(256):
        layer = np.concatenate(induced[byte]) if induced[byte] else np.empty(0, np.int64)
        layers = []
        while len(layer):
            layers.append(layer)
            before = layer - 1
            before = before[(before >= 0) & falling[before]]
            layer = before[data[before] == byte]
        layers.append(sorted_rising[cuts[byte]:cuts[byte + 1]])
        bucket = np.concatenate(layers)
        if not len(bucket):
            continue
        out.append(bucket)
        before = bucket - 1
        before = before[(before >= 0) & falling[before]]
        before = before[data[before] > byte]
        if len(before):
            first = data[before]
            order = np.argsort(first, kind="stable")
            before, first = before[order], first[order]
            for part in np.split(before, np.flatnonzero(np.diff(first)) + 1):
                induced[data[part[0]]].append(part)
    sa = np.concatenate(out)
    asked = np.zeros(n, bool)
    asked[wanted] = True
    return sa[asked[sa]]


def common_prefixes(data: np.ndarray, sa: np.ndarray) -> np.ndarray:
    """Of each place and the one before it in ``sa``, the bytes in common (LENGTH at most)."""
    words = _words(data)
    out = np.zeros(len(sa), np.int64)
    alive = np.arange(1, len(sa))
    for depth in range(0, LENGTH, 8):
        if not len(alive):
            break
        here, there = sa[alive] + depth, sa[alive - 1] + depth
        inside = np.maximum(here, there) < len(words)
        alive, here, there = alive[inside], here[inside], there[inside]
        differs = words[here] ^ words[there]
        for bits in range(8, 65, 8):
            out[alive] += differs < (U64(1) << U64(64 - bits)) if bits < 64 else differs == 0
        alive = alive[differs == 0]
    return np.minimum(out, LENGTH)


_FOUND = "shard int, runs binary, ids binary"


def _grouped(rows: pa.Table) -> pa.Table:
    """Per shard the strings that some document with a smaller id has: runs of (piece, strings
    skipped, strings) and the least id."""
    ints = lambda c: [np.frombuffer(b, np.int32).astype(np.int64) for b in rows.column(c).to_pylist()]
    sizes = ints("size")
    shard = np.repeat(rows.column("shard").to_numpy().astype(np.int64), [len(s) for s in sizes])
    piece, skipped, size = np.concatenate(ints("piece")), np.concatenate(ints("skipped")), np.concatenate(sizes)
    ids = np.concatenate([np.frombuffer(b, np.int64) for b in rows.column("id").to_pylist()])
    data = b"".join(rows.column("bytes").to_pylist())
    # equal pieces of several shards take part once, with the least id of all
    ends = np.cumsum(size)
    numbers: dict[bytes, int] = {}
    which = np.fromiter((numbers.setdefault(data[e - s:e], len(numbers)) for e, s in
                         zip(ends.tolist(), size.tolist())), np.int64, count=len(size))
    texts = list(numbers)
    least = np.full(len(texts), np.iinfo(np.int64).max)
    np.minimum.at(least, which, ids)
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    joined = np.frombuffer(b"".join(texts), dtype=np.uint8)
    counts = lengths - LENGTH + 1
    begins = np.cumsum(lengths) - lengths
    wanted = _spread(begins, counts)
    owner = np.repeat(np.arange(len(texts)), counts)
    number = np.empty(len(joined), np.int64)
    number[wanted] = np.arange(len(wanted))
    sa = two_stage(joined, wanted)
    prefix = common_prefixes(joined, sa)
    of = number[sa]
    starts = np.flatnonzero(prefix < LENGTH)
    lowest = np.minimum.reduceat(least[owner[of]], starts)
    best = np.empty(len(wanted), np.int64)
    best[of] = np.repeat(lowest, np.diff(np.append(starts, len(sa))))
    # runs of strings of a piece with one least id
    change = np.flatnonzero(np.concatenate([[True], (best[1:] != best[:-1]) | (owner[1:] != owner[:-1])]))
    run_owner, run_id = owner[change], best[change]
    run_size = np.diff(np.append(change, len(best)))
    run_skip = wanted[change] - begins[run_owner]
    edge = np.searchsorted(run_owner, np.arange(len(texts) + 1))
    n_runs = np.diff(edge)[which]
    run = _spread(edge[which], n_runs)
    member = np.repeat(np.arange(len(which)), n_runs)
    told = run_id[run] < ids[member]
    run, member = run[told], member[told]
    order = np.argsort(shard[member], kind="stable")
    run, member = run[order], member[order]
    to = shard[member]
    edges = np.append(np.flatnonzero(np.diff(to, prepend=-1)), len(to))
    facts = [piece[member], skipped[member] + run_skip[run], run_size[run]]
    return pa.table({
        "shard": pa.array(to[edges[:-1]].astype(np.int32), pa.int32()),
        "runs": pa.array([np.concatenate([f[a:b] for f in facts]).astype(np.int32).tobytes()
                          for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())], pa.binary()),
        "ids": pa.array(_cut(run_id[run], edges), pa.binary())})


def _covered(shard: Shard, found: pa.Table) -> np.ndarray:
    """Which bytes of the shard go."""
    size = len(shard.data)
    told = [np.frombuffer(b, np.int32).reshape(3, -1).astype(np.int64) for b in found.column("runs").to_pylist()]
    piece, skip, n = np.concatenate(told, axis=1) if told else np.empty((3, 0), np.int64)
    ids = np.concatenate([np.empty(0, np.int64), *(np.frombuffer(b, np.int64) for b in found.column("ids").to_pylist())])
    has = np.zeros(len(shard.same), bool)
    has[piece] = True
    # occurrences that a smaller id may cover, and the least id known of each string of their pieces
    mine = np.flatnonzero(has[shard.same] | (shard.id > shard.id[shard.same]))
    used = np.unique(shard.same[mine])
    base = np.zeros(len(shard.same) + 1, np.int64)
    base[used] = np.cumsum(shard.count[used]) - shard.count[used]
    least = np.repeat(shard.id[used], shard.count[used])
    np.minimum.at(least, _spread(base[piece] + skip, n), np.repeat(ids, n))
    count = shard.count[mine]
    at = _spread(shard.first[mine], count)
    gone = least[_spread(base[shard.same[mine]], count)] < np.repeat(shard.id[mine], count)
    steps = np.zeros(size + 1, np.int32)
    steps[at[gone]] += 1            # a place starts one string: no index comes twice
    steps[at[gone] + LENGTH] -= 1
    return np.cumsum(steps[:size]) > 0


def _removed(inner: list[str]):
    def run(rows: pa.Table, found: pa.Table) -> pa.Table:
        """The rows with n_bytes, n_removed, n_spans and the bytes kept."""
        sizes, removed, spans, kept = [], [], [], []
        order = []
        if rows.num_rows:
            shard = Shard(rows)
            order = shard.order
            gone = _covered(shard, found)
            at = 0
            for text, size in zip(shard.texts, shard.sizes.tolist()):
                off = gone[at:at + size]
                lost = int(np.count_nonzero(off))
                sizes.append(size)
                removed.append(lost)
                spans.append(int(np.count_nonzero(off[1:] & ~off[:-1])) + int(off[0]) if lost else 0)
                kept.append(shard.data[at:at + size][~off].tobytes() if lost else text)
                at += size
        rows = rows.take(pa.array(order, pa.int64()))
        return pa.table([*(rows.column(c) for c in [*inner, "input"]), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()),
                         pa.array(spans, pa.int64()), pa.array(kept, pa.binary())],
                        names=[*inner, "input", *RESULT.names])
    return run


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` with n_bytes, n_removed, n_spans and kept (the bytes left)."""
    size = docs.agg(F.sum(F.octet_length(quoted(text))).alias("n")).first()["n"] or 0
    shards = size // SHARD_BYTES + 1
    bits = min(max(int(4 * shards).bit_length(), 6), 24)
    names = [c for c in docs.columns if c not in RESULT.names]
    others = [c for c in names if c != text]
    inner = [f"c{i}" for i in range(len(others))]
    base = docs.select(*(quoted(c) for c in others), quoted(key).cast("bigint"), quoted(text).cast("binary")).toDF(
        *inner, "id", "input")
    # equal rows of different partitions part, so that no shard fills with copies of one row
    base = base.withColumn("shard", F.pmod(F.xxhash64("id", "input", F.spark_partition_id()), F.lit(shards)).cast("int"))
    by_shard = base.groupBy("shard")      # one shuffle of the texts, read three times
    survey = by_shard.applyInArrow(_surveyed(bits), "shard int, bucket int, names binary, times binary")
    recurring = survey.groupBy("bucket").applyInArrow(_recurring, "shard int, bucket int, names binary, parts binary")
    sent = by_shard.cogroup(recurring.groupBy("shard")).applyInArrow(_sent(bits), _SENT)
    found = sent.groupBy("bucket", "part").applyInArrow(_grouped, _FOUND)
    schema = T.StructType([*(base.schema[c] for c in inner), base.schema["input"], *RESULT.fields])
    out = by_shard.cogroup(found.groupBy("shard")).applyInArrow(_removed(inner), schema)
    source = {**{c: quoted(i) for c, i in zip(others, inner)}, text: F.col("input").cast(docs.schema[text].dataType)}
    return out.select(*(source[c].alias(c) for c in names), *RESULT.names)


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return without_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans",
                                        F.sha2("kept", 256).alias("kept_sha256"))


#: The same rows without suffix arrays: every 50-byte string with the least doc_id it starts in.
ORACLE_SQL = r"""
WITH texts AS (
    SELECT row_number() OVER () AS t, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents
), blocks AS (
    -- 512 starts each, so that a string is cut from a short piece
    SELECT t, doc_id, base, substr(x, 2 * base + 1, 2 * (512 + 49)) AS piece
    FROM (SELECT *, unnest(range(0, strlen(x) // 2 - 49, 512)) AS base FROM texts) AS each
), strings AS (
    SELECT t, doc_id, base + k AS i, md5(substr(piece, 2 * k + 1, 100)) AS s
    FROM (SELECT *, unnest(range(0, strlen(piece) // 2 - 49)) AS k FROM blocks) AS places
), firsts AS (
    SELECT s, min(doc_id) AS first_id FROM strings GROUP BY s
), found AS (
    SELECT t, i FROM strings JOIN firsts USING (s) WHERE first_id < doc_id
), marked AS (
    SELECT t, i, CASE WHEN i <= lag(i) OVER (PARTITION BY t ORDER BY i) + 50 THEN 0 ELSE 1 END AS new FROM found
), runs AS (
    SELECT t, run, min(i) AS lo, max(i) + 50 AS hi
    FROM (SELECT t, i, sum(new) OVER (PARTITION BY t ORDER BY i) AS run FROM marked) AS numbered GROUP BY t, run
), gaps AS (
    SELECT t, lo, hi, coalesce(lag(hi) OVER (PARTITION BY t ORDER BY lo), 0) AS before FROM runs
), cut AS (
    SELECT t, sum(hi - lo) AS n_removed, count(*) AS n_spans, max(hi) AS hi,
           string_agg(substr(x, 2 * before + 1, 2 * (lo - before)), '' ORDER BY lo) AS kept
    FROM gaps JOIN texts USING (t) GROUP BY t
)
SELECT doc_id, strlen(x) // 2 AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(CASE WHEN hi IS NULL THEN x ELSE kept || substr(x, 2 * hi + 1) END)) AS kept_sha256
FROM texts LEFT JOIN cut USING (t)
"""
