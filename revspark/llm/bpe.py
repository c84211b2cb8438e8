"""Operator 3: byte-level BPE encoding and decoding.

The text is cut by the tokenizer's pattern and every piece is encoded on its
own. Bytes are mapped to Latin-1 characters, so that a pyahocorasick automaton
over the vocabulary finds all tokens that start at each byte. The encoder takes
the longest token at a position and falls back to shorter ones, or to the
position before, whenever the pair it would make with the token before cannot
stand side by side; whether two tokens can is settled once by merging just
their bytes, and remembered. A position that turned out a dead end is not tried
again, so the work is linear in the piece. The result is the one that the
merges give.

Nulls and empty texts have no ids and decode to nothing. Repeated rows are
encoded each; extra columns pass through ``encode`` untouched.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revspark.llm.common import slices, table, use

#: Entries after which a worker forgets remembered pieces or pairs.
REMEMBERED = 400_000
#: Longer pieces are encoded but not remembered.
REMEMBERED_CHARS = 64

_IDS, _DECODED = "ids", "decoded"


def read_ranks(path: str) -> dict[bytes, int]:
    """The rank file: a base64 token and its rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merge_parts(piece: bytes, ranks: dict[bytes, int], until: int = 1) -> list[bytes]:
    """Plain merging, lowest rank first and leftmost on ties, down to ``until`` parts."""
    parts = [piece[i:i + 1] for i in range(len(piece))]
    while len(parts) > until:
        rank, at = min((ranks.get(parts[i] + parts[i + 1], 1 << 60), i)
                       for i in range(len(parts) - 1))
        if rank == 1 << 60:
            break
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return parts


class Vocabulary:
    """Ranks, the pattern, and for each token of several bytes the pair it is merged from.

    Tokens without such a pair cannot be reached by merging; they occur only where
    a whole piece is that token.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, pattern
        self.halves: dict[int, tuple[int, int]] = {}
        for token, i in ranks.items():
            if len(token) > 1 and len(two := merge_parts(token, ranks, 2)) == 2:
                self.halves[i] = (ranks[two[0]], ranks[two[1]])
        self.key = hashlib.sha256(pattern.encode() + b"".join(
            t + i.to_bytes(4, "little") for t, i in ranks.items())).hexdigest()


class Encoder:
    """Encodes and decodes in one worker."""

    def __init__(self, vocabulary: Vocabulary):
        self.ranks = vocabulary.ranks
        self.split = regex.compile(vocabulary.pattern).findall
        size = max(self.ranks.values(), default=-1) + 1
        self.token, self.length = [b""] * size, [0] * size
        self.shorter = [-1] * size  # the longest shorter token that the token begins with
        self.automaton = ahocorasick.Automaton()
        for t, i in sorted(self.ranks.items(), key=lambda x: len(x[0])):
            self.token[i], self.length[i] = t, len(t)
            if len(t) == 1 or i in vocabulary.halves:
                self.automaton.add_word(t.decode("latin-1"), i)
                self.shorter[i] = next((self.ranks[t[:n]] for n in range(len(t) - 1, 0, -1)
                                        if t[:n] in self.ranks
                                        and (n == 1 or self.ranks[t[:n]] in vocabulary.halves)), -1)
        if len(self.automaton):
            self.automaton.make_automaton()
        self.halves = vocabulary.halves
        self.merge = {pair: i for i, pair in self.halves.items()}
        self.pairs: dict[int, bool] = {}
        self.pieces = _Pieces(self)

    def compatible(self, left: int, right: int) -> bool:
        key = left << 32 | right
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) > REMEMBERED:
                self.pairs.clear()
            known = self.pairs[key] = self._stay_apart(left, right)
        return known

    def _stay_apart(self, left: int, right: int) -> bool:
        """Whether merging the bytes of both tokens gives just these two.

        Goes back in time: the token merged last is taken apart, and the pair that
        then meets at the border must not have a merge of a better rank. On equal
        ranks the left one was merged first, so the right one is taken apart first.
        """
        before = 1 << 60
        while True:
            if self.merge.get((left, right), 1 << 60) < before:
                return False
            a, b = self.halves.get(left), self.halves.get(right)
            if a and (not b or left > right):
                before, left = left, a[1]
            elif b:
                before, right = right + 1, b[0]
            else:
                return True

    def piece_ids(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        size, length, pairs = len(piece), self.length, self.pairs
        longest = [-1] * size
        for end, token in self.automaton.iter(piece.decode("latin-1")):
            longest[end - length[token] + 1] = token  # longer ones come later
        dead: set[int] = set()
        taken: list[int] = []
        at, last, token = 0, -1, longest[0]
        while True:
            while token >= 0:
                end = at + length[token]
                if end not in dead:
                    if last < 0:
                        break
                    fits = pairs.get(last << 32 | token)
                    if self.compatible(last, token) if fits is None else fits:
                        break
                token = self.shorter[token]
            if token >= 0:
                taken.append(token)
                if end == size:
                    return taken
                at, last, token = end, token, longest[end]
            else:
                if not taken:
                    raise ValueError("a byte of the text is not in the vocabulary")
                dead.add(at)
                given_up = taken.pop()
                at -= length[given_up]
                last = taken[-1] if taken else -1
                token = self.shorter[given_up]

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if len(self.pieces) > REMEMBERED:
            self.pieces.clear()
        return b"".join(map(self.pieces.__getitem__, self.split(text)))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.token.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


class _Pieces(dict):
    """piece -> its packed ids; long pieces are encoded but not remembered."""

    def __init__(self, encoder: Encoder):
        super().__init__()
        self.encoder = encoder

    def __missing__(self, piece: str) -> bytes:
        ids = self.encoder.piece_ids(piece.encode("utf-8"))
        packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(piece) <= REMEMBERED_CHARS:
            self[piece] = packed
        return packed


_ENCODERS: dict[str, Encoder] = {}


def _encoder(vocabulary: Vocabulary) -> Encoder:
    """One encoder per worker process and vocabulary."""
    use(_ENCODERS)
    if vocabulary.key not in _ENCODERS:
        _ENCODERS[vocabulary.key] = Encoder(vocabulary)
    return _ENCODERS[vocabulary.key]


def _appended(docs: DataFrame, source: str, vocabulary: Vocabulary, steps: dict) -> DataFrame:
    """``docs`` with binary columns, by name: each step maps (encoder, value) to a value, the
    first from ``source``, each other one from the step before (null: null).

    All steps run in one pass, so that a task needs one worker with one encoder.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(vocabulary)  # bounded: one vocabulary file
    kept = [c for c in docs.columns if c not in steps]
    schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField(c, T.BinaryType()) for c in steps])
    at = kept.index(source)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared.value)
        for batch in slices(batches, 512):
            values, columns = batch.column(at).to_pylist(), []
            for step in steps.values():
                values = [None if v is None else step(encoder, v) for v in values]
                columns.append(pa.array(values, pa.binary()))
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*kept, *steps])

    return docs.select(*kept).mapInArrow(run, schema)


def encode(docs: DataFrame, vocabulary: Vocabulary, text: str = "text") -> DataFrame:
    """``docs`` with a column ``ids``: the ids of ``text``, little-endian u32 (null: null).

    An input column named ``ids`` is replaced.
    """
    return _appended(docs, text, vocabulary, {_IDS: Encoder.encode})


def decode(docs: DataFrame, vocabulary: Vocabulary, ids: str = _IDS) -> DataFrame:
    """``docs`` with a column ``decoded``: the bytes that ``ids`` stand for (null: null)."""
    return _appended(docs, ids, vocabulary, {_DECODED: Encoder.decode})


def round_trip(docs: DataFrame, vocabulary: Vocabulary, text: str = "text") -> DataFrame:
    """``docs`` with the columns of ``encode`` and, from these ids, of ``decode``."""
    return _appended(docs, text, vocabulary, {_IDS: Encoder.encode, _DECODED: Encoder.decode})


def default_vocabulary(path: str | None = None) -> Vocabulary:
    """The multilingual public vocabulary, or the rank file at ``path``."""
    import public_tokenizers

    return Vocabulary(read_ranks(path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken")),
                      public_tokenizers.PATTERN)


def digests(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row (null text as empty)."""
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return round_trip(texts, vocabulary).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"), default_vocabulary())
