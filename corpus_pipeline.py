"""Corpus pipeline: toxicity, exact copies, near copies, benchmark passages, packing.

Every stage takes (spark, docs, sf_dir) and works on all rows that the stage
before it kept; all but the last return the columns of documents.

A null text counts as an empty one and is never toxic, near another text or
contaminated; of all empty texts the exact stage keeps one.  Rows with a null id
are rows like any other: of equal texts the smallest id stays (a null id only
where none has one), and groups of near copies without any id stay whole.
Repeated rows are exact copies.  Texts of any length are read whole.  Extra
columns, whatever they are called, pass through all stages but the last.  An
empty table gives an empty result, and without labels of both kinds nothing is
toxic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loomwork.llm import decontaminate, exact, packing, simhash, toxicity
from loomwork.llm.common import materialise, table


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact.drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_duplicates(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("toxicity", toxic),
    ("exact_dedup", exact_copies),
    ("simhash_dedup", near_copies),
    ("decontamination", benchmark_passages),
    ("packing", packed),
]

#: Toxicity is a fitted model and packing needs a tokenizer: SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each but the last written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialise(docs, f"stage-{name}")
    return docs
