"""Quality by nearest-neighbour voting over latent-semantic vectors.

A document's terms are its lower-cased words, trigrams of character shapes
(every letter counts as one of two shapes, each ASCII sign as itself), both
hashed to TERMS numbers, and buckets of three repetition ratios.  A truncated singular value decomposition of the labelled sample's
TF-IDF matrix gives latent vectors; the labelled vectors are broadcast, and
for every document the exact cosines to all of them come from blocked matrix
products.  The NEIGHBOURS nearest vote with their similarity as weight; of equally
similar ones at the edge the one with the smaller id votes.  An id with several
labels has the largest of them.

The labelled sample holds at most PER_CLASS rows of either label, so what is
broadcast is at most 2 * PER_CLASS * DIMS floats.  Null and empty texts have
the terms of an empty document and are scored like any other.  Without any
labelled row every score is 0.5.  Repeated rows each get their own row.

An empty table gives an empty result.  Texts of any length are read whole.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import pairwise
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold, id_and_text, texts
from .sample import one_label, sample_ids, sampled

PER_CLASS = 2048
TERMS = 1 << 13
BUCKETS = 8
WIDTH = 2 * TERMS + 3 * BUCKETS
WORD_SHARE = 0.5
DIMS = 48
NEIGHBOURS = 21
BLOCK = 2048
#: Similarities are compared to so many digits, whatever the block.
DIGITS = 4


def _shapes() -> np.ndarray:
    shape = np.ones(256, np.uint32)
    for b in range(128):
        c = chr(b)
        shape[b] = 1 if c.islower() else 2 if c.isupper() else 3 if c.isdigit() else 4 if c == " " else 5 if c == "\n" else 6
    signs = [b for b in range(33, 127) if not chr(b).isalnum()]
    shape[signs] = np.arange(7, 7 + len(signs))
    return shape


SHAPE = _shapes()


#: Signs and white space of ASCII end a word.
_SPACE = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def ratios(text: str) -> tuple[float, float, float]:
    """Share of repeated words, of words equal to the one before, of repeated lines."""
    words, lines = text.split(), text.split("\n")
    n = max(1, len(words))
    return (
        (1 - len(set(words)) / n) / (1 + 0.1 * np.log10(n)),
        sum(a == b for a, b in pairwise(words)) / n,
        1 - len(set(lines)) / len(lines),
    )


def terms(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Term numbers below WIDTH, and their weights before inverse document frequency."""
    data = text.encode("utf-8", "surrogatepass")
    s = SHAPE[np.frombuffer(data, np.uint8)]
    code = (s[:-2] << 12) | (s[1:-1] << 6) | s[2:]
    count = np.bincount((code * np.uint32(2654435761)) >> np.uint32(19), minlength=TERMS)
    shapes = np.flatnonzero(count)
    found = text.lower().encode("utf-8", "surrogatepass").translate(_SPACE).split()
    said = np.bincount(np.fromiter(map(crc32, found), np.uint32, len(found)) >> np.uint32(19), minlength=TERMS) if found else np.zeros(TERMS, np.int64)
    spoken = np.flatnonzero(said)
    own = [2 * TERMS + k * BUCKETS + min(BUCKETS - 1, int(r * BUCKETS)) for k, r in enumerate(ratios(text))]
    return np.concatenate([shapes, TERMS + spoken, own]), np.concatenate([np.log1p(count[shapes]), np.log1p(said[spoken]), [0.0] * 3]).astype(np.float32)


def weigh(idx: np.ndarray, tf: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Unit length over the trigrams, WORD_SHARE over the words; each ratio's bucket weighs half."""
    w = tf * idf[idx]
    words = slice(int(np.searchsorted(idx, TERMS)), len(w) - 3)
    for part, length in ((slice(0, words.start), 1.0), (words, WORD_SHARE)):
        w[part] *= length / max(1e-9, float(np.sqrt(w[part] @ w[part])))
    w[-3:] = 0.5
    return w


def _term_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        got = [terms(t) for t in texts(batch)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array([i.astype("<u2").tobytes() for i, _ in got], pa.binary()), pa.array([w.tobytes() for _, w in got], pa.binary())],
            ["doc_id", "cls", "idx", "tf"],
        )


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> dict[str, np.ndarray] | None:
    """docs: doc_id, text; labels: doc_id, cls (0 or 1), already restricted to the learning rows."""
    # docs comes first: a label without its document teaches nothing
    known = one_label(docs.select("doc_id").join(labels, "doc_id"))
    rows = sampled(docs, sample_ids(known, per_class)).mapInArrow(_term_rows, "doc_id long, cls int, idx binary, tf binary").toPandas()
    if rows.empty:
        return None
    rows = rows.sort_values(["doc_id", "idx"], kind="stable")
    idx = [np.frombuffer(b, "<u2").astype(np.int64) for b in rows.idx]
    df = np.bincount(np.concatenate(idx), minlength=WIDTH)
    idf = np.log((1 + len(rows)) / (1 + df)).astype(np.float32) + 1
    x = np.zeros((len(rows), WIDTH), np.float32)
    for k, (i, b) in enumerate(zip(idx, rows.tf, strict=True)):
        x[k, i] = weigh(i, np.frombuffer(b, np.float32), idf)
    q = np.random.default_rng(7).standard_normal((WIDTH, min(DIMS + 16, len(rows)))).astype(np.float32)
    for _ in range(3):  # subspace iteration
        q, _ = np.linalg.qr(x.T @ (x @ q))
    _, _, vt = np.linalg.svd(x @ q, full_matrices=False)
    base = np.ascontiguousarray((q @ vt.T)[:, :DIMS], np.float32)
    latent = x @ base
    latent /= np.maximum(1e-9, np.linalg.norm(latent, axis=1, keepdims=True))
    return {"idf": idf, "base": base, "latent": latent, "label": rows.cls.to_numpy(np.float32)}


def nearest(sims: np.ndarray, k: int) -> np.ndarray:
    """In every row the k largest; of equals at the edge those that come first."""
    edge = np.partition(sims, sims.shape[1] - k, axis=1)[:, sims.shape[1] - k, None]
    above, at = sims > edge, sims == edge
    return above | (at & (np.cumsum(at, axis=1) <= k - above.sum(1, keepdims=True)))


def vote(z: np.ndarray, model: dict[str, np.ndarray]) -> np.ndarray:
    """Scores of latent rows z from exact cosines, a block of documents at a time."""
    z = z / np.maximum(1e-9, np.linalg.norm(z, axis=1, keepdims=True))
    k, out = min(NEIGHBOURS, len(model["label"])), np.empty(len(z))
    for a in range(0, len(z), BLOCK):
        sims = np.round(z[a : a + BLOCK] @ model["latent"].T, DIGITS)
        w = np.where(nearest(sims, k), np.maximum(sims.astype(np.float64), 1e-6), 0.0)
        out[a : a + BLOCK] = w @ model["label"] / w.sum(1)
    return np.clip(out, 0, 1)


def _scorer(shared) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            if model is None:
                score = np.full(batch.num_rows, 0.5)
            else:
                z = np.zeros((batch.num_rows, model["base"].shape[1]), np.float32)
                for k, text in enumerate(texts(batch)):
                    i, tf = terms(text)
                    z[k] = weigh(i, tf, model["idf"]) @ model["base"][i]
                score = vote(z, model)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score, pa.float64())], ["doc_id", "score"])

    return run


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", per_class: int = PER_CLASS) -> DataFrame:
    """doc_id, score, predicted.  Learns from labels as given: restrict them first."""
    own = id_and_text(docs, id_col, text_col)
    known = labels.select(labels[id_col].cast("long").alias("doc_id"), labels[label_col].cast("int").alias("cls"))
    model = fit(own, known.where("cls in (0, 1)"), per_class)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    scored = own.mapInArrow(_scorer(shared), "doc_id long, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def held_out_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The same with held_out: ids whose crc32 modulo 3 is 1 teach nothing (nor do null ids)."""
    learn = labels.where(fold(F.col("doc_id"), 3) != 1)
    held = F.coalesce(fold(F.col("doc_id"), 3) == 1, F.lit(False))
    return score_quality(docs, learn).select("doc_id", held.alias("held_out"), "score", "predicted")
