"""Corpus pipeline: quality, near duplicates, repeated passages, benchmark passages, then token ids.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next one's ``docs``.
All but the last return the columns of ``docs``. Extra columns pass through, whatever their names.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from salesloom.llm import bpe_trie, decontaminate, jaccard_join, quality_trees, suffix_dedup
from salesloom.llm import common as K
from salesloom.session import run_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; it learns from labelled documents of its input."""
    return quality_trees.accepted(docs, quality_trees.fit_on(docs, K.table(spark, sf_dir, "labels"), K.fold(4) != 2))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each component of near duplicates: five words a shingle, a similarity of 0.8 or more."""
    return jaccard_join.one_of_each(docs, width=5, least=80)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that documents with smaller ids hold too."""
    return suffix_dedup.without_repeats(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    return decontaminate.clean(docs, K.table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number and digest of the ids of each document, and the digest of the text decoded from them."""
    return bpe_trie.digests(docs)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeats", repeats),
    ("decontamination", decontamination),
    ("encoding", encoding),
]

#: The quality classifier and the token vocabulary are beyond SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is kept in the shared folder, so a lost executor costs one stage's tasks."""
    docs, name = K.table(spark, sf_dir, "documents"), f"pipeline-{uuid.uuid4().hex}"
    for k, (stage, function) in enumerate(STAGES):
        path = run_dir(spark, name, f"{k}-{stage}")
        out = function(spark, docs, sf_dir)
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
