"""The training-text queries: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import collocations, decontaminate, exact, langid, mixing, negatives, packing, pii, quality, simhash, suffix, toxicity, wordlm
from .common import table


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_pii(table(spark, sf_dir, "documents"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.held_out_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(table(spark, sf_dir, "documents"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.remove_repeats(table(spark, sf_dir, "documents"))


def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wordlm.score_difference(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.held_out_languages(table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.mined(table(spark, sf_dir, "embeddings"))


def op12_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_pii, op2_quality, op3_exact_dedup, op4_simhash, op5_suffix_dedup, op6_lm_score, op7_decontaminate, op8_packing, op9_toxicity, op10_language, op11_hard_negatives, op12_mixing, op13_collocations)
}
ORACLE_SQL: dict[str, str] = {"op3_exact_dedup": exact.ORACLE_SQL, "op11_hard_negatives": negatives.ORACLE_SQL, "op12_mixing": mixing.ORACLE_SQL, "op13_collocations": collocations.ORACLE_SQL}
