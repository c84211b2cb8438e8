"""Operator 7: benchmark decontamination by template canonicalisation.

Numbers, units after a number and names (capitalised words inside a sentence)
become typed placeholders; runs of names are one. Every window of WINDOW template
tokens of a document is hash-joined with the windows of the benchmark items (an
item with fewer tokens is one window by itself). Windows that match at the same
shift between document and item form an alignment. Of these, a window whose slots
hold the item's own values counts in itself; each run of consecutive windows counts if
its slots are consistent, i.e. each value of the item stands for one value of the
document and the other way round. So an item is found again with other numbers and
names, but not where the same template is filled in differently each time. A name at
the item's very end may run on in the document.

Templates of few literal tokens would fit too much, and a short item is a single window
that one changed placeholder spoils. Items whose windows all have under MIN_LITERAL
literals, and those of at most WINDOW template tokens, are therefore looked for word by
word as well: all their raw tokens (numbers and names as they are, case aside) in a row.

Letters of scripts written without spaces are tokens one by one. Defined cases: null or
empty texts and items match nothing, nor do items under MIN_RAW raw tokens; repeated rows
match alike; a result row names the doc_id and the item_id, either may be null. Extra
columns are ignored.
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

from revspark.llm.common import U64, mixed, numbered, sequence_hashes, slices, stored, table, use


WINDOW = 13
MIN_TOKENS = 5
MIN_LITERAL = 5
MIN_RAW = 3
#: Raw tokens that are hashed together; a longer item is as many windows as it takes.
RAW = 8
#: Up to so many benchmark windows their hashes go to every task (8 bytes each), so that
#: only matching windows leave the scan; beyond, all windows are shuffled to the join.
BROADCAST_WINDOWS = 1_000_000

#: Units of measure, fixed values.
UNITS = frozenset((
    "mm cm m km in ft yd mi inch inches foot feet yard yards mile miles metre metres meter meters "
    "kilometre kilometres kilometer kilometers mg g kg t lb lbs oz gram grams kilogram kilograms "
    "pound pounds ton tons ml l litre litres liter liters gallon gallons s sec second seconds min "
    "minute minutes h hr hour hours day days week weeks month months year years percent degrees "
    "celsius fahrenheit usd eur gbp dollar dollars euro euros cent cents mph kmh hz khz mhz ghz "
    "w kw v a j kj cal kcal pa kpa bar").split())

#: Letters of scripts written without spaces (fixed values): Thai, Lao, Myanmar, Khmer, kana, Han.
_SINGLE = "\u0e01-\u0e7f\u0e80-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff"
_TOKEN = re.compile(rf"\d+(?:[.,:]\d+)*|[^\W\d_{_SINGLE}]+|[{_SINGLE}]|[.!?\n\u3002\uff01\uff1f]")
_ENDS = frozenset(".!?\n\u3002\uff01\uff1f")
#: How the text of a raw window begins.
_VERBATIM = "= "
_NUMBER, _CAPITAL, _END, _UNIT = 1, 2, 4, 8
_LOW = U64(15)
#: How the slot of a name at the very end of its text begins.
_OPEN = "<name$>"
_NAME_H, _NUMBER_H, _UNIT_H = U64(1 << 10), U64(2 << 10), U64(3 << 10)
_BASE = 0x9E3779B97F4A7C15


class _Tokens(dict):
    """token -> hash of its lower case, with flags in the low four bits."""

    def __missing__(self, token: str) -> int:
        flags, low = 0, token.lower()
        if token in _ENDS:
            flags = _END
        elif token[0].isdigit():
            flags = _NUMBER
        else:
            if token[0] != low[0] and token[1:] == low[1:]:
                flags = _CAPITAL
            if low in UNITS:
                flags |= _UNIT
        value = self[token] = (xxhash.xxh3_64_intdigest(low.encode("utf-8", "surrogatepass")) & ~15) | flags
        return value


_CACHE = _Tokens()


class Template:
    """The canonical tokens of one text: hash, index of the first raw token, kind of slot."""

    def __init__(self, text: str | None):
        self.raw = _TOKEN.findall(text or "")
        use(_CACHE)
        h = np.fromiter(map(_CACHE.__getitem__, self.raw), dtype=U64, count=len(self.raw))
        self.known = h
        kind, kept = np.zeros(len(h), dtype=np.uint8), np.ones(len(h), dtype=bool)
        marked = np.flatnonzero(h & _LOW)  # the few tokens that may be slots or end a sentence
        if len(marked):
            flags = np.concatenate([[_END], h & _LOW]).astype(np.uint8)  # of the token before, from 0
            own, before = flags[marked + 1], flags[marked]
            kept[marked[own == _END]] = False
            kind[marked[own == _NUMBER]] = _NUMBER
            kind[marked[((own & _UNIT) > 0) & (before == _NUMBER)]] = _UNIT
            names = marked[((own & _CAPITAL) > 0) & (before != _END)]
            if len(names):
                names = names[kind[names] == 0]
                kind[names] = _CAPITAL
                kept[names[1:][np.diff(names) == 1]] = False
        self.at = np.flatnonzero(kept)
        self.kind = kind[self.at]
        self.hash = h[self.at] >> U64(4)
        self.slots = bool(self.kind.any())
        if self.slots:
            for k, value in ((_NUMBER, _NUMBER_H), (_UNIT, _UNIT_H), (_CAPITAL, _NAME_H)):
                self.hash[self.kind == k] = value

    def windows(self, n: int) -> np.ndarray:
        """Hashes of the windows of ``n`` tokens."""
        return mixed(sequence_hashes(self.hash, n, _BASE))

    def verbatim(self) -> tuple[np.ndarray, np.ndarray]:
        """Hashes and places of the raw tokens, ends of sentences left out."""
        at = np.flatnonzero((self.known & _LOW) != _END)
        return self.known[at] >> U64(4), at

    def specific(self, starts: np.ndarray, n: int) -> np.ndarray:
        """Those of the windows that have enough literal tokens."""
        if not self.slots or not len(starts):
            return starts
        literal = np.concatenate([[0], np.cumsum(self.kind == 0)])
        return starts[literal[starts + n] - literal[starts] >= min(n, MIN_LITERAL)]

    def value(self, i: int) -> str:
        """What a slot holds; of a name, all its words."""
        first, end = self.at[i], self.at[i] + 1
        if self.kind[i] == _CAPITAL:
            stop = self.at[i + 1] if i + 1 < len(self.at) else len(self.raw)
            while end < stop and self.raw[end] not in _ENDS:
                end += 1
        return " ".join(self.raw[first:end])

    def described(self, start: int, n: int) -> tuple[str, list[str]]:
        """The window as text, and what its slots hold."""
        words, slots = [], []
        for i in range(start, start + n):
            if self.kind[i]:
                name = {_NUMBER: "<num>", _UNIT: "<unit>", _CAPITAL: "<name>"}[int(self.kind[i])]
                words.append(name)
                value = self.value(i)
                if self.kind[i] == _CAPITAL and self.at[i] + value.count(" ") + 1 == len(self.raw):
                    name = _OPEN
                slots.append(f"{name}{value}")
                name = name if name != _OPEN else "<name>"
            else:
                words.append(self.raw[self.at[i]].lower())
        return " ".join(words), slots


_FOUND = T.ArrayType(T.StructType([
    T.StructField("pos", T.IntegerType()), T.StructField("hash", T.LongType()),
    T.StructField("template", T.StringType()), T.StructField("slots", T.ArrayType(T.StringType()))]))
_ARROW = pa.list_(pa.struct([("pos", pa.int32()), ("hash", pa.int64()), ("template", pa.string()),
                             ("slots", pa.list_(pa.string()))]))


class _Wanted:
    """Sorted hashes, with a table of their first bits that settles most questions."""

    BITS = U64(64 - 22)

    def __init__(self, hashes: np.ndarray):
        self.hashes = hashes
        self.table = np.zeros(1 << 22, dtype=bool)
        self.table[hashes >> self.BITS] = True

    def among(self, values: np.ndarray) -> np.ndarray:
        """Places of the values that are among the hashes."""
        at = np.flatnonzero(self.table[values >> self.BITS])
        if not len(at):
            return at
        near = np.minimum(np.searchsorted(self.hashes, values[at]), len(self.hashes) - 1)
        return at[self.hashes[near] == values[at]]


def _raw_windows(template: Template, lengths, wanted: _Wanted | None) -> Iterator[dict]:
    """Windows of the raw tokens of the given lengths, as their text."""
    hashes, at = template.verbatim()
    for n in lengths:
        values = mixed(sequence_hashes(hashes, n, _BASE) ^ _NUMBER_H)
        starts = np.arange(len(values)) if wanted is None else wanted.among(values)
        for i in starts.tolist():
            words = [template.raw[k].lower() for k in at[i:i + n].tolist()]
            yield {"pos": i, "hash": int(values[i].astype(np.int64)), "template": _VERBATIM + " ".join(words), "slots": []}


def _windowed(texts: DataFrame, lengths, raw_lengths, wanted=None) -> DataFrame:
    """``texts`` (its last column the text) with the text replaced by its windows.

    ``lengths(number of tokens)`` gives the window lengths of a text and ``raw_lengths(
    template, windows found)`` those over its raw tokens; with ``wanted`` (a broadcast sorted
    array of hashes) only windows among these are given.
    """
    names = texts.columns[:-1]
    schema = T.StructType([texts.schema[c] for c in names] + [T.StructField("windows", _FOUND)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sought = None if wanted is None else _Wanted(wanted.value)
        for batch in slices(batches, 1024):
            out = []
            for text in batch.column(batch.num_columns - 1).to_pylist():
                template, found = Template(text), []
                for n in lengths(len(template.at)):
                    hashes = template.windows(n)
                    starts = np.arange(len(hashes)) if sought is None else sought.among(hashes)
                    for i in template.specific(starts, n).tolist():
                        name, slots = template.described(i, n)
                        found.append({"pos": i, "hash": int(hashes[i].astype(np.int64)),
                                      "template": name, "slots": slots})
                found += _raw_windows(template, raw_lengths(template, len(found)), sought)
                out.append(found)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(len(names))), pa.array(out, _ARROW)],
                names=[*names, "windows"])

    return texts.mapInArrow(run, schema)


def _item_lengths(n: int) -> list[int]:
    return [WINDOW] if n >= WINDOW else [n] if n >= MIN_TOKENS else []


def _item_raw_lengths(template: Template, windows: int) -> list[int]:
    n = len(template.verbatim()[0])
    if n < MIN_RAW or (windows and len(template.at) > WINDOW):
        return []
    return [min(n, RAW)]


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(key, item_id, n_windows, share) of each text that holds a benchmark item.

    ``docs`` has a column ``key`` and a column ``text``; texts of equal key are taken
    for the same. share: of the item's windows, how many the best alignment has.
    """
    verbatim = F.startswith("w.template", F.lit(_VERBATIM))
    every = (_windowed(benchmark.select("item_id", "text"), _item_lengths, _item_raw_lengths)
             .withColumn("n_raw", F.size(F.filter("windows", lambda w: F.startswith(w["template"], F.lit(_VERBATIM)))))
             .select("item_id", "n_raw", F.size("windows").alias("n"), F.explode("windows").alias("w")))
    items = stored(every.select("item_id", F.when(verbatim, F.col("n_raw")).otherwise(F.col("n") - F.col("n_raw")).alias("n_item"),
                                verbatim.alias("verbatim"), "w")
                   .select("item_id", "n_item", "verbatim", F.col("w.pos").alias("item_pos"), "w.hash", "w.template",
                           F.col("w.slots").alias("item_slots")), "benchmark-windows")
    # at most WINDOW + RAW values
    sizes = items.select("verbatim", F.size(F.split("template", " ")).alias("n")).distinct().collect()
    lengths = [WINDOW, *(r.n for r in sizes if not r.verbatim and r.n < WINDOW)]
    raw = [r.n - 1 for r in sizes if r.verbatim]      # a raw window's text has its mark in front
    few = items.limit(BROADCAST_WINDOWS + 1).count() <= BROADCAST_WINDOWS
    wanted = None
    if few:
        hashes = items.select("hash").distinct().toPandas()["hash"].to_numpy(dtype=np.int64)
        if not len(hashes):
            hashes = np.zeros(1, dtype=np.int64)
        wanted = docs.sparkSession.sparkContext.broadcast(np.sort(hashes.view(U64)))
    found = (_windowed(docs.select("key", "text"), lambda n: [k for k in lengths if k <= n],
                       lambda template, found: raw, wanted)
             .select("key", F.explode("windows").alias("w")).select("key", "w.*"))
    met = found.join(F.broadcast(items) if few else items, ["hash", "template"])
    # word by word: all of the item's raw windows, one after the other
    copied = (met.where("verbatim").groupBy("key", "item_id", "n_item", (F.col("pos") - F.col("item_pos")).alias("shift"))
              .agg(F.count_distinct("item_pos").alias("n")).where(F.col("n") == F.col("n_item"))
              .select("key", "item_id", F.col("n").alias("n_windows"), F.lit(1.0).alias("share")))
    judged = (met.where("not verbatim").groupBy("key", "item_id", "n_item", (F.col("pos") - F.col("item_pos")).alias("shift"))
              .agg(F.collect_set(F.struct("item_pos", "item_slots", "slots")).alias("windows")))
    schema = T.StructType([*judged.schema.fields[:-1], T.StructField("n_windows", T.LongType())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1024):
            n = [counted(w) for w in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(n, pa.int64())], names=schema.names)

    aligned = judged.mapInArrow(count, schema).where("n_windows > 0").select(
        "key", "item_id", "n_windows", (F.col("n_windows") / F.col("n_item")).alias("share"))
    return (aligned.unionByName(copied).groupBy("key", "item_id")
            .agg(F.max("n_windows").alias("n_windows"), F.max("share").alias("share")))


def _closed(slot: str) -> str:
    return "<name>" + slot[len(_OPEN):] if slot.startswith(_OPEN) else slot


def _pairs(window: dict) -> list[tuple[str, list[str]]]:
    """(value of the item, values of the document that it may stand for) of each slot."""
    out = []
    for mine, other in zip(window["item_slots"], map(_closed, window["slots"])):
        words = other.split(" ")
        if mine.startswith(_OPEN):  # may run on: as long as the item's name, or any shorter or longer
            k = min(mine.count(" ") + 1, len(words))
            cuts = [k, *(i for i in range(1, len(words) + 1) if i != k)]
            out.append((_closed(mine), [" ".join(words[:i]) for i in cuts]))
        else:
            out.append((mine, [other]))
    return out


def _consistent(pairs: list[tuple[str, list[str]]]) -> bool:
    there, back = {}, {}
    for mine, others in sorted(pairs, key=lambda p: len(p[1])):  # what is certain first
        other = there.get(mine) if there.get(mine) in others else others[0]
        if there.setdefault(mine, other) != other or back.setdefault(other, mine) != mine:
            return False
    return True


def counted(windows: list[dict]) -> int:
    """How many windows of an alignment (item_pos, item_slots, slots) count: those with the
    item's own values, and those of consistent runs."""
    runs: list[list] = []
    for w in sorted(windows, key=lambda w: w["item_pos"]):
        if not runs or runs[-1][-1][0] + 1 != w["item_pos"]:
            runs.append([])
        runs[-1].append((w["item_pos"], _pairs(w)))
    n = 0
    for run in runs:
        if _consistent([p for _, pairs in run for p in pairs]):
            n += len(run)
        else:
            n += sum(all(mine in others for mine, others in pairs) for _, pairs in run)
    return n


def text_key(text):
    """What equal texts share (null for null)."""
    return F.md5(F.col(text).cast("binary"))


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text holds no benchmark item, columns as they are."""
    found = stored(leaks(docs.select(text_key("text").alias("key"), "text"), benchmark)
                   .select("key").distinct(), "leaks")
    plain, at = numbered(docs)
    keyed = plain.withColumn("key", text_key(at["text"]))
    return keyed.join(found, "key", "left_anti").select(*at.values()).toDF(*docs.columns)


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each document and benchmark item that it holds; clean documents have none."""
    docs = table(spark, sf_dir, "documents")
    found = leaks(docs.select(F.struct("doc_id", text_key("text").alias("t")).alias("key"), "text"),
                  table(spark, sf_dir, "benchmark"))
    return found.select("key.doc_id", "item_id", "n_windows", "share")
