"""Language by nearest centroid over normalised TF-IDF n-gram vectors.

Terms are hashed byte bigrams and trigrams of the lower-cased text, in which
every run of ASCII signs, digits and spaces counts as one space.  A bounded
sample per language is clustered (spherical k-means, CENTROIDS clusters); a
document gets the language of the most similar centroid.  Each centroid also
keeps the similarity that nearly all its members reach; a document below it is
marked rejected, which never changes lang_pred.

`und` marks a null text or one without any letter, which numerals such as ² or Ⅷ
are not (score 0, rejected).  With
no labelled row at all every document is `und`.  An id with several languages
has the one that sorts last.  A tie goes to the language
that sorts first.  Repeated rows each get their own row.

An empty table gives an empty result.  Texts of any length are read whole.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold, id_and_raw_text, texts
from .sample import one_label, sample_ids, sampled

PER_LANGUAGE = 768
TERMS = 1 << 13
CENTROIDS = 4
ROUNDS = 12
REJECT_QUANTILE = 0.005
REJECT_MARGIN = 0.5
FOLD = np.array([b if b >= 128 or chr(b).isalpha() else 32 for b in range(256)], np.uint32)


def terms(text: str) -> np.ndarray:
    """Counts of hashed n-grams of the whole text."""
    b = FOLD[np.frombuffer(text.lower().encode("utf-8", "surrogatepass"), np.uint8)]
    gap = b == 32
    b = b[~(gap & np.concatenate([[True], gap[:-1]]))]
    two = (b[:-1] << 8) | b[1:]
    three = (two[:-1] << 8) | b[2:]
    mix = np.uint32(2654435761)
    out = np.bincount(((two + np.uint32(1 << 24)) * mix) >> np.uint32(19), minlength=TERMS)
    return out + np.bincount((three * mix) >> np.uint32(19), minlength=TERMS)


def _term_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [np.log1p(terms(t)).astype("<f2").tobytes() for t in texts(batch)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(rows, pa.binary())], ["doc_id", "cls", "tf"])


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(1e-9, np.linalg.norm(x, axis=1, keepdims=True))


def clusters(x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Unit centroids and each row's similarity to its own; seeds are the first row and then the farthest ones."""
    seeds = [0]
    near = x @ x[0]
    while len(seeds) < min(k, len(x)):
        seeds.append(int(near.argmin()))
        near = np.maximum(near, x @ x[seeds[-1]])
    c = x[seeds]
    for _ in range(ROUNDS):
        own = (x @ c.T).argmax(1)
        c = unit(np.stack([x[own == j].sum(0) if (own == j).any() else c[j] for j in range(len(c))]))
    return c, x @ c.T


def fit(docs: DataFrame, langs: DataFrame, per_language: int = PER_LANGUAGE, centroids: int = CENTROIDS) -> dict | None:
    """docs: doc_id, text; langs: doc_id, cls, already restricted to the learning rows."""
    rows = sampled(docs.where(F.col("text").isNotNull()), sample_ids(one_label(langs), per_language))
    got = rows.mapInArrow(_term_rows, "doc_id long, cls string, tf binary").toPandas()
    if got.empty:
        return None
    got = got.sort_values(["cls", "doc_id", "tf"], kind="stable")
    x = np.stack([np.frombuffer(b, "<f2") for b in got.tf]).astype(np.float32)
    idf = np.log((1 + len(x)) / (1 + (x > 0).sum(0))).astype(np.float32) + 1
    x = unit(x * idf)
    cls = got.cls.to_numpy()
    parts, owner, floor = [], [], []
    for lang in sorted(set(cls)):
        c, sims = clusters(x[cls == lang], centroids)
        own, best = sims.argmax(1), sims.max(1)
        parts.append(c)
        owner += [lang] * len(c)
        floor += [REJECT_MARGIN * float(np.quantile(best[own == j], REJECT_QUANTILE)) if (own == j).any() else 0.0 for j in range(len(c))]
    return {"idf": idf, "centroids": np.concatenate(parts).astype(np.float32), "lang": owner, "floor": floor}


def _predictor(shared) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            lang, score, rejected = [], [], []
            for text in texts(batch):
                if model is None or text is None or not any(map(str.isalpha, text)):
                    best, s, far = "und", 0.0, True
                else:
                    v = np.log1p(terms(text)).astype(np.float32) * model["idf"]
                    sims = model["centroids"] @ v / max(1e-9, float(np.sqrt(v @ v)))
                    j = int(sims.argmax())
                    best, s, far = model["lang"][j], float(min(1.0, max(0.0, sims[j]))), bool(sims[j] < model["floor"][j])
                lang.append(best)
                score.append(s)
                rejected.append(far)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())], ["doc_id", "lang_pred", "score", "rejected"])

    return run


def identify(docs: DataFrame, langs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = PER_LANGUAGE) -> DataFrame:
    """doc_id, lang_pred, score, rejected.  Learns from langs (id_col, lang_col) as given."""
    own = id_and_raw_text(docs, id_col, text_col)
    known = langs.select(langs[id_col].cast("long").alias("doc_id"), langs[lang_col].cast("string").alias("cls"))
    shared = docs.sparkSession.sparkContext.broadcast(fit(own, known, per_language))
    return own.mapInArrow(_predictor(shared), "doc_id long, lang_pred string, score double, rejected boolean")


def held_out_languages(docs: DataFrame) -> DataFrame:
    """The same with held_out: ids whose crc32 modulo 4 is 2 teach nothing (nor do null ids)."""
    learn = docs.where((fold(F.col("doc_id"), 4) != 2) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    held = F.coalesce(fold(F.col("doc_id"), 4) == 2, F.lit(False))
    return identify(docs, learn).select("doc_id", held.alias("held_out"), "lang_pred", "score", "rejected")
