"""The sparse design against a dense one, and the size of the vocabulary."""

import numpy as np
import pytest
from pyspark.sql import functions as F

pytest.importorskip("loomwork.llm")
from loomwork.llm import toxicity  # noqa: E402


def test_sparse_design_is_the_dense_one():
    rng = np.random.default_rng(2)
    marks, dense = rng.random((90, 40)) < 0.1, rng.standard_normal((90, 2)).astype(np.float32)
    marks[7], marks[:, 5] = False, False
    x = np.hstack([marks, dense]).astype(np.float32)
    sparse = toxicity.Design(np.nonzero(marks)[1].astype(np.int32), marks.sum(axis=1), 40, dense)
    v, g = rng.standard_normal(42).astype(np.float32), rng.standard_normal(90).astype(np.float32)
    assert np.allclose(sparse.times(v), x @ v, atol=1e-4) and np.allclose(sparse.back(g), x.T @ g, atol=1e-4)
    y = np.stack([marks[:, 0], marks[:, 1] | marks[:, 0]], 1).astype(np.float32)
    folds = np.arange(90) % toxicity.FOLDS
    for a, b in zip(toxicity.fit_chain(x, y, folds)[0], toxicity.fit_chain(sparse, y, folds)[0], strict=True):
        assert np.allclose(a, b, atol=1e-2)


def test_vocabulary_is_not_cut(spark):
    """2600 words tell the classes apart, besides their beginnings; the last 552 were dropped before."""
    rows = [(k, " ".join(f"{'ab'[k % 2]}{j:03d}" for j in range(1300))) for k in range(1, 25)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("cls"))
    assert sum(not t.startswith("^") for t in toxicity.fit(docs, labels)["at"]) == 2600
