"""Whether scores tell wanted documents from others that neither model was told about."""

import pytest
from pyspark.sql import functions as F

pytest.importorskip("loomwork.llm")
from loomwork.llm import wordlm  # noqa: E402


def test_scores_separate_held_out_documents(spark):
    """Labels of a third of the ids are not learnt from; wanted ones among them score lower than others."""
    path = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{path}/documents.parquet"), spark.read.parquet(f"{path}/labels.parquet")
    held = "crc32(cast(doc_id as string)) % 3 = 1"
    got = wordlm.score_difference(docs, labels.where(f"not {held}")).join(labels.where(held), "doc_id").select("score", "quality").toPandas()
    wanted, ranks = got.quality.eq(1), got.score.rank()
    n, m = int(wanted.sum()), int((~wanted).sum())
    assert (ranks[~wanted].sum() - m * (m + 1) / 2) / (n * m) > 0.95  # the share of pairs in the right order
