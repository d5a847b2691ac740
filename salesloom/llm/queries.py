"""Registered queries of the subpackage and, where SQL can express them, their DuckDB checks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from salesloom.llm import (
    bpe_trie, decontaminate, importance, jaccard_join, language_ppm, packing, product_codes, quality_trees, rule_forest, suffix_dedup, token_counts,
    token_files, toxicity)
from salesloom.llm.common import table
from salesloom.llm.sql import SQL  # noqa: F401  the entry reads it here


def op1_quality_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_trees.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_fm_index_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.counts(table(spark, sf_dir, "documents"))


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.joined(table(spark, sf_dir, "documents"), width=4, least=85)


def op5_trie_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_trie.digests(table(spark, sf_dir, "documents"))


def op6_ppm_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_ppm.language(table(spark, sf_dir, "documents"))


def op7_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup(table(spark, sf_dir, "documents"))


def op8_packed_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.stored_tokens(table(spark, sf_dir, "documents"))


def op9_rule_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_forest.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_counterfactual_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.ranks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digests(table(spark, sf_dir, "documents"))


def op13_pivot_product_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return product_codes.digests(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_trees": op1_quality_trees,
    "op2_fm_index_decontamination": op2_fm_index_decontamination,
    "op3_token_counts": op3_token_counts,
    "op4_ngram_jaccard_join": op4_ngram_jaccard_join,
    "op5_trie_bpe": op5_trie_bpe,
    "op6_ppm_language": op6_ppm_language,
    "op7_suffix_array_dedup": op7_suffix_array_dedup,
    "op8_packed_token_files": op8_packed_token_files,
    "op9_rule_forest": op9_rule_forest,
    "op10_counterfactual_toxicity": op10_counterfactual_toxicity,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_best_fit_packing": op12_best_fit_packing,
    "op13_pivot_product_codes": op13_pivot_product_codes,
}
