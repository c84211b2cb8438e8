"""A training-corpus pipeline over ``documents``: five stages, each a written table.

    quality      documents that the quality classifier rejects go
    near_dups    of every group of near-duplicate texts one document stays
    substrings   repeated passages of 35 words or more are cut from the texts
    leaks        documents that hold a benchmark item go
    tokens       ids of the byte-level BPE vocabulary, with their digests

Each stage reads what the stage before wrote to the shared folder. All but the last
keep the columns of documents; rows with a null text pass through to the tokens (as
no token), unless the classifier rejects them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revspark.llm import bpe, decontaminate, jaccard, quality, substring
from revspark.llm.common import stored, table


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.one_of_each(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return substring.deduplicated(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.digests(docs, bpe.default_vocabulary())


STAGES = [
    ("quality", keep_quality),
    ("near_dups", keep_one_of_each),
    ("substrings", cut_repeats),
    ("leaks", drop_leaks),
    ("tokens", tokenize),
]

#: SQL has no classifier, minhash or byte-pair merges; the tests hold the rows against
#: plain Python versions of the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
