"""Operator 6: license scans with inheritance from the nearest ancestor directory.

Every run of consecutive terms of a file that is as long as a template (a licence text,
a standard header, a one-line notice, an SPDX tag) is compared with it by the cosine of
sparse TF-IDF vectors, and so is the whole text; line breaks and comment marks are no
terms, so wrapped and commented headers are found, also amid other text. Document
frequencies of the templates' terms are counted over all files; a term outside the
templates counts as the rarest one. Short templates differ in single terms: there a
window must also hold each term of the licence's id that the template has.
A file without a notice of its own takes the license of the licence file in its own
or the nearest ancestor directory, by joins on directory paths. A licence file is
named as such (LICENSE, COPYING, NOTICE, with any ending), or is in its whole text
close to a template.

Defined cases: null and empty texts have no notice of their own but inherit; a null
path has no directory and inherits nothing; of several templates the closest counts
(ties: the longest, then the first name in text order), of several licence files in a directory the
closest, then the first path. Repeated rows are scanned alike. Extra columns are
ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revspark.llm.common import slices, stored, table
from revspark.llm.license_texts import TEMPLATES

SIMILARITY = 0.8

#: Templates of at most this many terms are told apart by single terms: a window must hold
#: those that name the licence (see ``Notices``).
SHORT = 24

_TERM = re.compile(r"\w+")


def _terms(text: str) -> list[str]:
    return _TERM.findall(text.lower())


class Notices:
    """TF-IDF vectors of the templates, from the document frequencies of their terms.

    The terms that name a licence are those of its id (name and version) that the template has.
    """

    def __init__(self, notices, frequency: dict[str, int], files: int):
        terms = [(name, _terms(text)) for name, text in notices]
        self.index = {t: k for k, t in enumerate(sorted({t for _, own in terms for t in own}))}
        self.rarest = math.log(files + 1) + 1
        self.idf = np.array([math.log((files + 1) / (frequency.get(t, 0) + 1)) + 1 for t in self.index])
        self.names = [name for name, _ in terms]
        self.lengths = np.array([len(own) for _, own in terms])
        self.vectors = np.zeros((len(terms), len(self.index)))
        self.naming = []
        for k, (name, own) in enumerate(terms):
            for t, n in Counter(own).items():
                self.vectors[k, self.index[t]] = n * self.idf[self.index[t]]
            marks = {self.index[t] for t in set(own) & set(_terms(name))} if len(own) <= SHORT else ()
            self.naming.append(np.array(sorted(marks), dtype=int))
        norms = np.sqrt((self.vectors ** 2).sum(axis=1, keepdims=True))
        self.vectors /= np.where(norms > 0, norms, 1)

    def reachable(self, present: np.ndarray, threshold: float) -> np.ndarray:
        """The templates that a window of these terms can come close to: by Cauchy-Schwarz
        the cosine is at most the length of the template's part in the terms."""
        part = (self.vectors[:, present] ** 2).sum(axis=1)
        return np.flatnonzero(part >= threshold * threshold - 1e-9)

    def _cosine(self, k: int, codes: np.ndarray, weight: np.ndarray) -> float:
        """Of template ``k`` and the terms ``codes`` (the templates' first) with these idf each."""
        unique, at, counts = np.unique(codes, return_index=True, return_counts=True)
        known = unique < len(self.index)
        if not np.isin(self.naming[k], unique[known]).all():
            return 0.0
        dot = (self.vectors[k, unique[known]] * counts[known] * weight[at][known]).sum()
        return round(float(dot / np.sqrt(((counts * weight[at]) ** 2).sum())), 9)

    def _closest_window(self, k: int, codes: np.ndarray, weight: np.ndarray, gain: np.ndarray,
                        squares: np.ndarray, threshold: float) -> float:
        """The greatest cosine of template ``k`` with a window of its length, 0 if under the threshold.

        A window's vector is at least as long as if its terms were all different, which bounds
        the cosine of every window at once; windows are tried from the greatest bound down.
        """
        n = min(int(self.lengths[k]), len(codes))
        dots = np.concatenate([[0.0], np.cumsum(gain)])
        bound = (dots[n:] - dots[:-n]) / np.sqrt(squares[n:] - squares[:-n]) + 1e-6
        open_ = np.flatnonzero(bound >= threshold)
        best = 0.0
        for at in open_[np.argsort(-bound[open_], kind="stable")]:
            if bound[at] < best or best == 1.0:
                break
            cosine = self._cosine(k, codes[at:at + n], weight[at:at + n])
            if cosine >= threshold:
                best = max(best, cosine)
        return best

    def scan(self, text: str, threshold: float) -> tuple[str | None, float | None, bool]:
        """(license, similarity, whether the whole text is a licence) of a file."""
        terms = _terms(text)
        present = np.array(sorted(self.index[t] for t in self.index.keys() & set(terms)), dtype=int)
        among = self.reachable(present, threshold) if len(present) else present
        if not len(among):
            return None, None, False
        local = dict(self.index)
        codes = np.array([local.setdefault(t, len(local)) for t in terms])
        known = codes < len(self.index)
        inside = np.where(known, codes, 0)
        weight = np.where(known, self.idf[inside], self.rarest)
        squares = np.concatenate([[0.0], np.cumsum(weight ** 2)])
        found, whole = [], False
        for k in among:
            window = self._closest_window(k, codes, weight, np.where(known, self.vectors[k, inside] * weight, 0.0),
                                          squares, threshold)
            entire = self._cosine(k, codes, weight)
            whole = whole or entire >= threshold
            near = max(window, entire)
            if near >= threshold:
                found.append((-near, -int(self.lengths[k]), self.names[k]))
        if not found:
            return None, None, False
        near, _, name = min(found)
        return name, -near, whole


def _frequencies(notices):
    vocabulary = {t for _, text in notices for t in _terms(text)}  # the templates' size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        files = 0
        for batch in slices(batches, 1024):
            for text in batch.column(0).to_pylist():
                files += 1
                counts.update(vocabulary.intersection(_terms(text or "")))
        terms = ["", *counts]
        yield pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), pa.array(
            [files, *counts.values()], pa.int64())], names=["term", "n"])

    return run


def notices_for(files: DataFrame, text: str = "text", notices=TEMPLATES) -> Notices:
    """Counts the notices' terms over all files; what reaches the driver has their number."""
    rows = (files.select(text).mapInArrow(_frequencies(notices), "term string, n long")
            .groupBy("term").agg(F.sum("n").alias("n")).collect())
    counts = {r["term"]: r["n"] for r in rows}
    return Notices(notices, counts, counts.pop("", 0))


def own_licenses(files: DataFrame, notices: Notices, threshold: float = SIMILARITY) -> DataFrame:
    """(file_id, path, license, similarity, whole) per file."""
    shared = files.sparkSession.sparkContext.broadcast(notices)  # as large as the notices

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1024):
            found = [shared.value.scan(t or "", threshold) for t in batch.column(2).to_pylist()]
            names, near, whole = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(names, pa.string()),
                 pa.array(near, pa.float64()), pa.array(whole, pa.bool_())],
                names=["file_id", "path", "license", "similarity", "whole"])

    kind = files.schema["file_id"].dataType.simpleString()
    return files.select("file_id", "path", "text").mapInArrow(
        run, f"file_id {kind}, path string, license string, similarity double, whole boolean")


def directory_of(path: Column) -> Column:
    """The path without its last part; the root is empty."""
    return F.regexp_replace(F.regexp_replace(path, r"(?s)/?[^/]*$", ""), r"^(\./|/)+", "")


def ancestors(directory: Column) -> Column:
    """The directory and all above it, up to the root."""
    parts = F.split(directory, "/")
    above = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))
    return F.array_distinct(F.concat(F.array(F.lit("")), above))


def licenses(files: DataFrame, threshold: float = SIMILARITY, notices=TEMPLATES) -> DataFrame:
    """(file_id, path, license, similarity, origin, directory) per row of files
    (file_id, path, text); origin is ``own``, ``inherited`` or null, directory that of
    the licence file inherited from."""
    own = stored(own_licenses(files, notices_for(files, "text", notices), threshold)
                 .withColumn("_dir", directory_of(F.col("path"))), "licenses")
    named = F.regexp_extract("path", r"(?s)([^/]*)$", 1).rlike(r"(?i)^(licen[sc]e|copying|notice)([.\-_].*)?$")
    granted = (own.where((named | F.col("whole")) & F.col("license").isNotNull() & F.col("_dir").isNotNull())
               .groupBy("_dir").agg(F.min(F.struct(-F.col("similarity"), "path", "license")).alias("g"))
               .select(F.col("_dir").alias("above"), F.col("g.license").alias("granted")))
    directories = own.where("_dir is not null").select("_dir").distinct()
    nearest = (directories.select("_dir", F.explode(ancestors(F.col("_dir"))).alias("above"))
               .join(granted, "above").groupBy("_dir")
               .agg(F.max(F.struct(F.length("above").alias("n"), "above", "granted")).alias("n"))
               .select("_dir", F.col("n.above").alias("above"), F.col("n.granted").alias("granted")))
    mine = F.col("license").isNotNull()
    return own.join(nearest, "_dir", "left").select(
        "file_id", "path", F.coalesce("license", "granted").alias("license"), "similarity",
        F.when(mine, "own").when(F.col("granted").isNotNull(), "inherited").alias("origin"),
        F.when(~mine, F.col("above")).alias("directory"))


def document_files(docs: DataFrame) -> DataFrame:
    """The documents as files of a tree: source/thousand/fifty/doc_id.txt, where the first
    of each fifty and of each thousand is the LICENSE of its directory."""
    n = F.col("doc_id")
    thousand = F.concat_ws("/", F.coalesce("source", F.lit("unknown")), F.floor(n / 1000).cast("string"))
    fifty = F.concat_ws("/", thousand, F.floor(n / 50).cast("string"))
    path = (F.when(n % 1000 == 0, F.concat(thousand, F.lit("/LICENSE")))
            .when(n % 50 == 0, F.concat(fifty, F.lit("/LICENSE")))
            .otherwise(F.concat(fifty, F.lit("/"), n.cast("string"), F.lit(".txt"))))
    return docs.select(n.alias("file_id"), path.alias("path"), "text")


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses(document_files(table(spark, sf_dir, "documents")))
    return found.withColumnRenamed("file_id", "doc_id")
