"""Bounded samples of labelled rows, for fitting classifiers only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SLICES = 64


def sample_ids(rows: DataFrame, per_class: int) -> DataFrame:
    """At most `per_class` ids of every class (SLICES of them where that is more), the smallest by a hash of the id.

    rows: doc_id, cls.  A class is ranked within SLICES slices of its ids, so no
    class meets in one task; rows with a null id or class are never drawn.
    """
    h = F.xxhash64("doc_id")
    slices = Window.partitionBy("cls", F.pmod(h, F.lit(SLICES))).orderBy(h, "doc_id")
    return (
        rows.where(F.col("doc_id").isNotNull() & F.col("cls").isNotNull())
        .select("doc_id", "cls")
        .withColumn("n", F.row_number().over(slices))
        .where(F.col("n") <= max(1, per_class // SLICES))
        .select("doc_id", "cls")
    )


def one_label(rows: DataFrame) -> DataFrame:
    """doc_id, cls: an id with several labels has the largest of them."""
    return rows.groupBy("doc_id").agg(F.max("cls").alias("cls"))


def sampled(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The sampled rows' texts: doc_id, cls, text.  ids is bounded by sample_ids, so it is broadcast."""
    return docs.join(F.broadcast(ids), "doc_id").select("doc_id", "cls", "text")
