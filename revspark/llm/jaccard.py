"""Operator 9: similarity join by the Jaccard coefficient of word n-grams.

Equal texts are one class, so copies cost a row each and no pairs. MinHash bands
make candidates: a class is linked to the first class of each of its band
buckets, and connected components of these links hold every pair that shares a
bucket. A component is dealt to blocks of about BLOCK classes, those with the same
smallest head together, and only blocks that share a bucket are compared, two to a
task: a chain of texts that are alike from one to the next costs its links, not its
square (a group of real near copies is counted link by link). A task looks at
MinHash values STEP at a time and drops a pair as soon as the posterior probability
(uniform prior) that its similarity reaches the threshold is under TOLERANCE; the
rest are verified exactly on their shingles.
Tasks return link counts and spanning links, not pairs.

With BANDS bands of ROWS values a pair at the threshold of 0.8 misses every
bucket with probability (1 - 0.8^ROWS)^BANDS, under 1e-7, and less above it.

Defined cases: a word is a run of bytes other than the six ASCII blanks; a text
of 1 to n-1 words is one shingle, one without words has none and no links; null
texts are classes of their own without links. Rows that repeat a doc_id with
another text are documents of their own. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revspark.llm.common import U64, WORD, WordHash, mixed, numbered, sequence_hashes, slices, stored, table, use
from revspark.llm.components import components

N_WORDS = 5
THRESHOLD = 0.8
BANDS, ROWS = 32, 4
HASHES = BANDS * ROWS
STEP = 16
TOLERANCE = 1e-9
BLOCK = 512
#: Parts that the members of a large component are dealt to where its size is joined to them.
SALTS = 64

_BASE = 0x9E3779B97F4A7C15
_FACTORS = (np.random.default_rng(9).integers(1, 1 << 63, HASHES, dtype=np.uint64) << U64(1)) | U64(1)
_WORDS = WordHash()


def shingles(text: bytes | None, n: int = N_WORDS) -> np.ndarray:
    """Hashes of the word n-grams of a text, in order, repeats included."""
    words = WORD.findall(text or b"")
    use(_WORDS)
    return mixed(sequence_hashes(_WORDS.of(words), max(1, min(n, len(words))), _BASE))


def signature(hashes: np.ndarray) -> np.ndarray:
    """HASHES MinHash values (32 bits) of at least one shingle."""
    least = np.full(HASHES, np.iinfo(np.uint64).max, dtype=U64)
    for at in range(0, len(hashes), 1024):
        np.minimum(least, (hashes[at:at + 1024, None] * _FACTORS).min(axis=0), out=least)
    return (least >> U64(32)).astype(np.uint32)


def band_keys(values: np.ndarray) -> np.ndarray:
    rows = values.reshape(BANDS, ROWS).astype(U64)
    key = np.zeros(BANDS, dtype=U64)
    for r in range(ROWS):
        key = mixed(key * U64(_BASE) + rows[:, r])
    return key


def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> dict[int, int]:
    """values compared -> matches under which a pair is dropped.

    With m of n values equal the similarity is Beta(m+1, n-m+1) distributed, so that it
    reaches t with the probability that a Binomial(n+1, t) is at most m.
    """
    out = {}
    for n in range(STEP, HASHES + 1, STEP):
        below, m = 0.0, -1
        while below < tolerance:
            m += 1
            below += comb(n + 1, m) * threshold ** m * (1 - threshold) ** (n + 1 - m)
        out[n] = m
    return out


def surviving(a: np.ndarray, b: np.ndarray, same: bool, least: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j) of two blocks of signatures that are not dropped; i < j if they are the same."""
    matches = np.zeros((len(a), len(b)), dtype=np.int16)
    for k in range(STEP):
        matches += a[:, k, None] == b[None, :, k]
    keep = matches >= least[STEP]
    i, j = np.nonzero(np.triu(keep, 1) if same else keep)
    count = matches[i, j]
    for at in range(STEP, HASHES, STEP):
        for k in range(at, at + STEP):
            count += a[i, k] == b[j, k]
        on = count >= least[at + STEP]
        i, j, count = i[on], j[on], count[on]
    return i, j


def verified(i: np.ndarray, j: np.ndarray, a: list[np.ndarray], b: list[np.ndarray],
             threshold: float) -> np.ndarray:
    """Which pairs have that Jaccard coefficient; a and b are sorted distinct shingles."""
    out = np.zeros(len(i), dtype=bool)
    if not len(i):
        return out
    size = np.array([len(x) for x in b])
    _, ids = np.unique(np.concatenate([*a, *b]), return_inverse=True)
    cuts = np.cumsum([len(x) for x in a])
    mine, others = np.split(ids[:cuts[-1]], cuts[:-1]), ids[cuts[-1]:]
    starts = np.cumsum(size) - size
    mark = np.zeros(ids.max() + 1, dtype=bool)
    at = np.flatnonzero(np.r_[True, i[1:] != i[:-1]])
    for lo, hi in zip(at, np.append(at[1:], len(i))):
        own = mine[i[lo]]
        mark[own] = True
        common = np.add.reduceat(mark[others], starts, dtype=np.int64)[j[lo:hi]]
        out[lo:hi] = common / (len(own) + size[j[lo:hi]] - common) >= threshold
        mark[own] = False
    return out


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest index that each of n members is connected with."""
    root = np.arange(n)
    while True:
        before = root.copy()
        np.minimum.at(root, i, root[j])
        np.minimum.at(root, j, root[i])
        root = root[root]
        if (root == before).all():
            return root


def text_key(text: str = "text") -> Column:
    """The class of a text: equal for equal texts, null for null."""
    return F.md5(F.col(text).cast("binary"))


def _banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, key, text) to (doc_id, key, bands); bands is null without shingles."""
    for batch in slices(batches, 1024):
        bands = []
        for text in batch.column(2).to_pylist():
            h = shingles(text)
            bands.append(band_keys(signature(h)).astype(np.int64) if len(h) else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(bands, pa.list_(pa.int64()))],
            names=["doc_id", "key", "bands"])


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, text) to (key, values, grams): MinHash values and sorted distinct shingles."""
    for batch in slices(batches, 1024):
        values, grams = [], []
        for text in batch.column(1).to_pylist():
            h = np.unique(shingles(text))
            values.append(signature(h).tobytes())
            grams.append(h.tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(values, pa.binary()), pa.array(grams, pa.binary())],
            names=["key", "values", "grams"])


def _compared(threshold: float, tolerance: float):
    least = least_matches(threshold, tolerance)

    def run(rows: pa.Table) -> pa.Table:
        """The members of one or two blocks to (key, root, n_links)."""
        keys, block = rows.column("key").to_pylist(), np.array(rows.column("block").to_pylist())
        order = sorted(range(len(keys)), key=lambda k: (block[k], keys[k]))
        values = [np.frombuffer(v, np.uint32) for v in rows.column("values").to_pylist()]
        grams = [np.frombuffer(v, U64) for v in rows.column("grams").to_pylist()]
        values, grams = np.array([values[k] for k in order]), [grams[k] for k in order]
        keys, block = [keys[k] for k in order], block[order]
        one = rows.column("first")[0].as_py() == rows.column("second")[0].as_py()
        cut = 0 if one else int(np.searchsorted(block, block[-1]))
        if not one and cut == 0:  # one of the two blocks is empty
            i = j = np.empty(0, dtype=np.int64)
        else:
            head = slice(0, len(keys) if one else cut)
            i, j = surviving(values[head], values[cut:], one, least)
            on = verified(i, j, grams[head], grams[cut:], threshold)
            i, j = i[on], j[on] + cut
        links = np.bincount(i, minlength=len(keys)) + np.bincount(j, minlength=len(keys))
        root = _roots(len(keys), i, j)
        some = np.flatnonzero(links)
        return pa.table({"key": pa.array([keys[k] for k in some], pa.string()),
                         "root": pa.array([keys[root[k]] for k in some], pa.string()),
                         "n_links": pa.array(links[some], pa.int64())})

    return run


def _dealt(candidates: DataFrame, hooks: DataFrame) -> DataFrame:
    """(key, component, block): the members of a component in blocks of about BLOCK.

    A component of at most BLOCK is one block, ''. In larger ones the members with the same
    smallest head stay together: a quarter of BLOCK of them or more have blocks of their own,
    fewer share blocks with others.
    """
    of = candidates.select(F.col("node").alias("key"), "component",
                           F.pmod(F.xxhash64("node"), F.lit(SALTS)).alias("salt"))
    # at most a row for each BLOCK / 4 members, so that their copies are fewer than the members
    salts = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt")
    sizes = of.groupBy("component").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > BLOCK)
    heads = hooks.groupBy("key").agg(F.min("root").alias("head"))
    headed = of.join(heads, "key", "left").withColumn("head", F.coalesce("head", "key"))
    parts = headed.groupBy("component", "head").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") * 4 >= BLOCK)
    shared = F.concat(F.lit("-"), F.pmod(F.xxhash64("head"), F.ceil(F.col("n") / BLOCK)).cast("string"))
    own = F.concat("head", F.lit("-"), F.pmod(F.xxhash64("key"), F.ceil(F.col("m") / BLOCK)).cast("string"))
    return (headed.join(sizes.select("component", "n", salts), ["component", "salt"], "left")
            .join(parts.select("component", "head", "m", salts), ["component", "head", "salt"], "left")
            .select("key", "component", F.when(F.col("n").isNull(), "").when(F.col("m").isNull(), shared)
                    .otherwise(own).alias("block")))


def block_pairs(dealt: DataFrame, bands: DataFrame) -> DataFrame:
    """(component, first, second): every block with itself, and the blocks that share a bucket.

    Buckets that meet the same blocks are one row before their pairs are made.
    """
    met = (bands.join(dealt.where("block <> ''"), "key").groupBy("component", "band", "bucket")
           .agg(F.sort_array(F.collect_set("block")).alias("met")).where(F.size("met") > 1)
           .select("component", "met").distinct())
    two = (met.select("component", "met", F.explode("met").alias("first"))
           .select("component", "first", F.explode(F.filter("met", lambda b: b > F.col("first"))).alias("second"))
           .distinct())
    one = dealt.select("component", F.col("block").alias("first"), F.col("block").alias("second")).distinct()
    return one.unionByName(two)


def classes(docs: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> tuple[DataFrame, DataFrame]:
    """(members, links) of docs (doc_id, text).

    members: doc_id, key per row. links: key, first_id, n_copies, group, group_key,
    group_id, n_links per class of texts: its smallest doc_id and number of rows; the
    group of linked classes it is in, with the key and doc_id of the group's member of
    smallest doc_id; and the number of other texts it is linked with.
    """
    base = docs.select("doc_id", text_key().alias("key"), F.col("text").cast("binary").alias("text"))
    kind = base.schema["doc_id"].dataType.simpleString()
    members = stored(base.mapInArrow(_banded, f"doc_id {kind}, key string, bands array<bigint>"), "bands")
    texts = (members.where("key is not null").groupBy("key")
             .agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n_copies"), F.first("bands").alias("bands")))
    texts = stored(texts, "classes")
    bands = texts.select("key", F.posexplode("bands").alias("band", "bucket"))
    shared = (bands.groupBy("band", "bucket").agg(F.min("key").alias("least"), F.count(F.lit(1)).alias("n"))
              .where("n > 1").drop("n"))
    near = bands.join(shared, ["band", "bucket"]).where("key <> least").groupBy("key").agg(
        F.min("least").alias("root"), F.collect_set("least").alias("leasts"))     # one for each band at most
    # a class meets its smallest bucket head, its other heads do so too: what was connected stays
    # so, and a class of a large group brings one link instead of one for each band
    hooks = stored(near.select("key", "root").union(
        near.select(F.explode("leasts").alias("key"), "root").where("key <> root")).distinct(), "hooks")
    candidates = components(hooks, "key", "root", "candidates")
    dealt = stored(_dealt(candidates, hooks), "blocks")
    pairs = block_pairs(dealt, bands)
    sides = pairs.select("component", F.col("first").alias("block"), "first", "second").unionByName(
        pairs.where("first <> second").select("component", F.col("second").alias("block"), "first", "second"))
    # the text of one row of each candidate class: its id is in the key, so copies spread
    wanted = dealt.join(texts.select("key", "first_id"), "key").select(
        F.col("key").alias("k"), F.coalesce(F.col("first_id").cast("string"), F.lit("")).alias("id"))
    own_id = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    found = (base.select(F.col("key").alias("k"), own_id.alias("id"), "text").join(wanted, ["k", "id"])
             .withColumnRenamed("k", "key"))
    signed = (found.select("key", "text").mapInArrow(_signed, "key string, values binary, grams binary")
              .dropDuplicates(["key"]))
    blocks = signed.join(dealt, "key").join(sides, ["component", "block"])
    compared = stored(blocks.groupBy("component", "first", "second").applyInArrow(
        _compared(threshold, tolerance), "key string, root string, n_links long"), "links")
    counts = compared.groupBy("key").agg(F.sum("n_links").alias("n_links"))
    groups = components(compared.where("key <> root"), "key", "root", "groups")
    links = (texts.drop("bands").join(counts, "key", "left")
             .join(groups.withColumnRenamed("node", "key"), "key", "left")
             .select("key", "first_id", "n_copies", F.coalesce("component", "key").alias("group"),
                     F.coalesce("n_links", F.lit(0)).alias("n_links")))
    first = links.groupBy("group").agg(F.min(F.struct(F.col("first_id").isNull().alias("null"), "first_id", "key")).alias("f"))
    return members.select("doc_id", "key"), links.join(
        first.select("group", F.col("f.first_id").alias("group_id"), F.col("f.key").alias("group_key")), "group")


def joined(docs: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> DataFrame:
    """doc_id, class_id, n_links, copy_of, n_copies per row of docs.

    class_id: smallest doc_id of the group of linked texts; n_links: other texts that
    the document's text is linked with; copy_of: smallest doc_id with the same text.
    """
    members, links = classes(docs, threshold, tolerance)
    out = members.join(links, "key", "left")
    return out.select(
        "doc_id", F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("group_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("first_id")).alias("copy_of"),
        F.coalesce("n_copies", F.lit(1)).alias("n_copies"))


def one_of_each(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` less all but one of each group of linked or equal texts.

    Kept is the group's smallest doc_id; rows with a null text are all kept.
    """
    _, links = classes(docs, threshold)
    kept = links.where(F.col("key") == F.col("group_key")).select(
        "key", F.coalesce(F.col("first_id").cast("string"), F.lit("")).alias("id"))
    plain, at = numbered(docs)
    keyed = plain.withColumns({"key": text_key(at["text"]),
                               "id": F.coalesce(F.col(at["doc_id"]).cast("string"), F.lit(""))})
    chosen = keyed.where("key is not null").join(kept, ["key", "id"]).dropDuplicates(["key", "id"])
    none = plain.where(F.col(at["text"]).isNull())
    return chosen.select(*at.values()).unionByName(none).toDF(*docs.columns)


def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joined(table(spark, sf_dir, "documents"))


#: The same rows without MinHash: all pairs of texts that share a shingle, 5 c >= 4 of the union.
ORACLE_SQL = r"""
WITH RECURSIVE words AS (
    SELECT text, min(doc_id) AS first_id, count(*) AS n_copies,
           list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
    FROM documents WHERE text IS NOT NULL GROUP BY text
), texts AS (
    SELECT row_number() OVER (ORDER BY first_id, text) AS t, * FROM words
), grams AS (
    SELECT DISTINCT t, md5(array_to_string(w[i:i + 4], ' ')) AS g
    FROM (SELECT t, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM texts WHERE len(w) > 0) AS places
), sizes AS (
    SELECT t, count(*) AS n FROM grams GROUP BY t
), common AS (
    SELECT a.t AS a, b.t AS b, count(*) AS c FROM grams AS a JOIN grams AS b ON a.g = b.g AND a.t < b.t GROUP BY a.t, b.t
), pairs AS (
    SELECT a, b FROM common JOIN sizes AS x ON x.t = a JOIN sizes AS y ON y.t = b
    WHERE 5 * c >= 4 * (x.n + y.n - c)
), links AS (
    SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs
), reached(t, other) AS (
    SELECT t, t FROM texts
    UNION SELECT reached.t, links.b FROM reached JOIN links ON links.a = reached.other
), groups AS (
    SELECT t, min(other) AS least FROM reached GROUP BY t
), counts AS (
    SELECT a AS t, count(*) AS n FROM links GROUP BY a
)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN d.doc_id ELSE head.first_id END AS class_id,
       coalesce(counts.n, 0) AS n_links,
       CASE WHEN d.text IS NULL THEN d.doc_id ELSE own.first_id END AS copy_of,
       coalesce(own.n_copies, 1) AS n_copies
FROM documents AS d LEFT JOIN texts AS own ON own.text = d.text
LEFT JOIN groups ON groups.t = own.t LEFT JOIN texts AS head ON head.t = groups.least
LEFT JOIN counts ON counts.t = own.t
"""
