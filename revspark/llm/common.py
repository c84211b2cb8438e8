"""What the operators of this subpackage share: tables, shared storage, word hashes."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revspark.session import scratch_path

#: A word is a run of bytes other than the six ASCII blanks.
WORD = re.compile(rb"[^\x20\x09-\x0D]+")

#: Entries after which a worker's word cache starts afresh (bounds its memory).
CACHE_ENTRIES = 200_000

U64 = np.uint64
_MASK = (1 << 64) - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder (``spark.checkpoint.dir``) and read back.

    Cuts the lineage: a lost executor costs a re-read of files, not of the plan.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def quoted(name: str):
    """The column of that very name, dots and backticks included."""
    return F.col(f"`{name.replace('`', '``')}`")


def numbered(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with its columns named c0, c1, ..., and which name became which: columns that an
    operator adds clash with none, and names with dots or backticks need no care."""
    inner = [f"c{i}" for i in range(len(docs.columns))]
    return docs.toDF(*inner), dict(zip(docs.columns, inner))


def fold(id_col, modulus: int):
    """crc32 of the id as text, modulo ``modulus`` (null ids: null)."""
    return F.crc32(id_col.cast("string").cast("binary")) % modulus


_in_use: dict = {}


def use(cache: dict) -> None:
    """To be called before a batch of work on ``cache``, a worker's memory of tokens.

    A worker serves many operators in turn and keeps the entries of one: those of the
    cache used before are dropped, and ``cache`` itself starts afresh when it is full.
    """
    global _in_use
    if cache is not _in_use:
        _in_use.clear()
        _in_use = cache
    elif len(cache) > CACHE_ENTRIES:
        cache.clear()


class WordHash(dict):
    """word (bytes) -> 64-bit hash."""

    def __init__(self, seed: int = 0):
        super().__init__()
        self.seed = seed

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word, self.seed)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=U64, count=len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser, so that the order of hashes says nothing about words."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def sequence_hashes(h: np.ndarray, n: int, base: int) -> np.ndarray:
    """Polynomial hash (odd ``base``, modulo 2^64) of every run of ``n`` values of ``h``.

    Runs of doubling length are combined, so n costs about 2 log2(n) passes.
    """
    if len(h) < n:
        return np.empty(0, dtype=U64)
    done, done_n, part, part_n = None, 0, h, 1
    while True:
        if n & 1:
            if done is None:
                done, done_n = part, part_n
            else:
                size = len(h) - (done_n + part_n) + 1
                done = done[:size] * U64(pow(base, part_n, 1 << 64)) + part[done_n:done_n + size]
                done_n += part_n
        n >>= 1
        if not n:
            return done
        size = len(part) - part_n
        part = part[:size] * U64(pow(base, part_n, 1 << 64)) + part[part_n:part_n + size]
        part_n *= 2


def slices(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The batches cut to at most ``rows`` rows, so that what is derived stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
