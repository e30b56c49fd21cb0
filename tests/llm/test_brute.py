"""Plain versions of fitted operators and of the whole pipeline."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

pytest.importorskip("loomwork.llm")
import corpus_pipeline  # noqa: E402
from loomwork.llm import decontaminate, exact, langid, packing, quality, simhash, toxicity  # noqa: E402


def rows_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_quality_scores_by_hand(spark, small):
    """Every document's score again from the fitted vectors: all cosines sorted, ties by id."""
    docs, labels = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "labels"))
    own, known = docs.select("doc_id", "text"), labels.select("doc_id", F.col("quality").alias("cls"))
    model = quality.fit(own, known)
    got = {r.doc_id: r.score for r in quality.score_quality(docs, labels).collect()}
    off = 0
    for doc_id, text in rows_of(docs):
        i, tf = quality.terms(text or "")
        z = quality.weigh(i, tf, model["idf"]) @ model["base"][i]
        sims = np.round(model["latent"] @ (z / max(1e-9, np.linalg.norm(z))), quality.DIGITS)
        near = sorted(range(len(sims)), key=lambda k: (-sims[k], k))[: quality.NEIGHBOURS]
        w = np.maximum(sims[near].astype(float), 1e-6)
        off += got[doc_id] != pytest.approx((w * model["label"][near]).sum() / w.sum(), abs=1e-3)
    assert off <= 0.02 * len(got)  # a similarity may be rounded the other way


def test_nearest_breaks_ties_by_place():
    sims = np.array([[0.5, 0.9, 0.5, 0.5, 0.1], [0.2, 0.2, 0.2, 0.2, 0.2]], np.float32)
    assert quality.nearest(sims, 2).tolist() == [[True, True, False, False, False], [True, True, False, False, False]]


def test_language_by_hand(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    learn = docs.where("lang is not null")
    model = langid.fit(docs.select("doc_id", "text"), learn.select("doc_id", F.col("lang").alias("cls")))
    got = {r.doc_id: r.lang_pred for r in langid.identify(docs, learn).collect()}
    for doc_id, text in rows_of(docs):
        if not re.search(r"[^\W\d_]", text or ""):
            assert got[doc_id] == "und"
            continue
        v = np.log1p(langid.terms(text)).astype(np.float32) * model["idf"]
        cosines = [float(c @ v) / float(np.linalg.norm(c) * np.linalg.norm(v)) for c in model["centroids"]]
        best = max(range(len(cosines)), key=lambda k: cosines[k])
        assert got[doc_id] == model["lang"][best] or cosines[best] - max(c for c, lang in zip(cosines, model["lang"], strict=True) if lang == got[doc_id]) < 1e-5


def test_toxicity_by_hand(spark, small):
    """Probabilities again, row by row, from the fitted chain."""
    docs, labels = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs.select("doc_id", "text"), labels.select("doc_id", F.col("toxic").alias("cls")))
    got = {r.doc_id: (r.p_marked, r.p_repeated, r.p_toxic) for r in toxicity.score_toxicity(docs, labels).collect()}
    n = len(model["at"])
    for doc_id, text in rows_of(docs):
        found = toxicity.words(text or "")
        here = sorted(model["at"][t] for t in toxicity.terms(found) if t in model["at"])
        k, out = sum(bool(model["strong"][i]) for i in here), []
        for w in model["chain"]:
            x = [k / (len(found) + 20), np.log1p(len(found)), *out]
            z = sum(float(w[i]) for i in here) + sum(float(a) * b for a, b in zip(w[n:-1], x, strict=True)) + float(w[-1])
            out.append(1 / (1 + np.exp(-z)))
        assert got[doc_id] == pytest.approx(out, abs=1e-6)


def test_out_of_fold_rows_are_unseen(monkeypatch):
    """While learning, no model sees a row that it is asked about, nor does a fold's design come from its rows."""
    asked = []
    real = toxicity.logistic
    monkeypatch.setattr(toxicity, "logistic", lambda x, y, **k: asked.append((len(x), float(y.sum()))) or real(x, y, **k))
    rng = np.random.default_rng(0)
    x, folds = rng.standard_normal((100, 3)).astype(np.float32), np.arange(100) % toxicity.FOLDS
    y = (np.arange(100) % 3 == 0).astype(np.float32)[:, None]
    views = []
    for f in range(toxicity.FOLDS):
        own = y.copy()
        own[folds == f] = 99  # would show in a sum
        views.append((toxicity.design(x), own))
    toxicity.fit_chain(x, y, folds, views)
    assert asked[0] == (100, y.sum())
    assert asked[1:] == [(80, float(y[folds != f].sum())) for f in range(toxicity.FOLDS)]


def test_terms_are_chosen_without_the_fold(spark):
    """A word that only one fold's rows hold is no marker of that fold's models."""
    ids = [k for k in range(1, 400) if toxicity.fold_of(np.array([k]))[0] == 0][:20] + [k for k in range(1, 400) if toxicity.fold_of(np.array([k]))[0] != 0][:80]
    rows = [(k, k % 2, ("zzzz " if n < 20 and k % 2 else "") + ("bad here" if k % 2 else "fine there")) for n, k in enumerate(ids)]
    docs = spark.createDataFrame([(k, t) for k, _, t in rows], "doc_id long, text string")
    seen = docs.join(spark.createDataFrame([(k, c) for k, c, _ in rows], "doc_id long, cls int"), "doc_id").select("doc_id", "cls", "text").mapInArrow(toxicity._term_rows, "fold int, cls int, term string")
    size = Counter((int(toxicity.fold_of(np.array([k]))[0]), c) for k, c, _ in rows)
    picked = toxicity._chosen(seen, size)
    assert "zzzz" in picked[0][0] and "zzzz" not in picked[1][0] and all("zzzz" in best for best, _ in picked[2:])


def test_several_labels_are_one(spark, small):
    docs, labels = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "labels"))
    twice = labels.unionByName(labels.withColumn("quality", F.lit(0)).withColumn("toxic", F.lit(0)))
    for score, column in ((quality.score_quality, "score"), (toxicity.score_toxicity, "p_toxic")):
        a, b = ({r.doc_id: r[column] for r in score(docs, x).collect()} for x in (labels, twice))
        assert a == b


# --- the pipeline ----------------------------------------------------------


def squeezed(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def test_pipeline_against_plain_stages(spark, odd, small, tmp_path):
    """Each stage against a plain version over what the stage before it kept."""
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{small}/{name}.parquet").write.parquet(str(tmp_path / f"{name}.parquet"))
    base = spark.read.parquet(f"{small}/documents.parquet")
    more = odd.select(*base.columns).withColumn("doc_id", F.col("doc_id") + 10**6)
    base.unionByName(more).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    sf = str(tmp_path)
    labels, benchmark = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("labels", "benchmark"))
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)

    kept = stages["toxicity"](spark, docs, sf)
    p = {(r.doc_id, r.p_toxic) for r in toxicity.score_toxicity(docs, labels).collect() if r.p_toxic >= 0.5}
    gone = {i for i, _ in p}
    assert kept.columns == docs.columns and Counter(rows_of(kept)) == Counter((i, t) for i, t in rows_of(docs) if i not in gone)

    one = stages["exact_dedup"](spark, kept, sf)
    groups = {}
    for i, t in rows_of(kept):
        groups.setdefault(squeezed(t), []).append(i)
    least = lambda ids: min((i for i in ids if i is not None), default=None)
    assert Counter((i, squeezed(t)) for i, t in rows_of(one)) == Counter((least(ids), t) for t, ids in groups.items())

    two = stages["simhash_dedup"](spark, one, sf)
    classes = {}
    for r in simhash.near_duplicates(one).collect():
        classes.setdefault(r.component_id, []).append(r.doc_id)
    left = Counter(i for i, _ in rows_of(two))
    assert left == Counter([c for c in classes if c is not None] + [None] * len(classes.get(None, [])))

    three = stages["decontamination"](spark, two, sf)
    bad = {r.doc_id for r in decontaminate.find_contamination(two, benchmark).where("contaminated").collect()}
    assert Counter(rows_of(three)) == Counter((i, t) for i, t in rows_of(two) if i not in bad)

    last = stages["packing"](spark, three, sf)
    want = packing.pack(three)
    cols = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert Counter(map(tuple, last.select(*cols).collect())) == Counter(map(tuple, want.select(*cols).collect()))
    assert Counter(map(tuple, corpus_pipeline.run(spark, sf).select(*cols).collect())) == Counter(map(tuple, last.select(*cols).collect()))


def test_pipeline_empty(spark, none, small, tmp_path):
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{small}/{name}.parquet").write.parquet(str(tmp_path / f"{name}.parquet"))
    none.write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_drop_copies_with_a_full_filter(odd):
    want = {hashlib.sha256(squeezed(t).encode()).hexdigest() for _, t in rows_of(odd)}
    for bits in (64, exact.BITS):
        got = rows_of(exact.drop_copies(odd, bits=bits))
        assert len(got) == len(want) and {hashlib.sha256(squeezed(t).encode()).hexdigest() for _, t in got} == want


def test_contamination_in_many_blocks(spark, odd, monkeypatch):
    """One item a block, written every other pass, against all items at once."""
    monkeypatch.setattr(decontaminate, "TOGETHER", 2)
    texts = [t for _, t in rows_of(odd) if t and len(t.split()) > 15][:7] + ["a b c", "the the", ""]
    bench = spark.createDataFrame([(k % 8, t) for k, t in enumerate(texts)] + [(None, "x"), (3, None)], "item_id long, text string")
    cols = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    one, many = (Counter(map(tuple, decontaminate.find_contamination(odd, bench, block_bytes=b).select(*cols).collect())) for b in (1 << 20, 1))
    assert one == many and any(k[-1] for k in one)
    left = [Counter(rows_of(decontaminate.drop_contaminated(odd, bench, block_bytes=b))) for b in (1 << 20, 1)]
    assert left[0] == left[1] and sum(left[0].values()) == sum(n for k, n in one.items() if not k[-1])


def test_items_take_little_memory():
    """A block's windows take at most some ten times its text."""
    import random

    rng = random.Random(1)
    vocabulary = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(2000)]
    text = " ".join(rng.choices(vocabulary, k=40_000))
    items = decontaminate.Items([(k, text[k * 20_000 : (k + 1) * 20_000]) for k in range(14)])
    held = sum(a.nbytes for arrays in items.by_length.values() for a in arrays)
    assert held < 12 * len(text)


def test_edges_of_fitted_operators(spark, odd, none):
    """Empty tables, no labels, extra columns with the names that operators use inside."""
    few = spark.createDataFrame([(1, 0, 1), (4, 1, 0)], "doc_id long, quality int, toxic int")
    for run in (lambda d: quality.held_out_scores(d, few), lambda d: toxicity.score_toxicity(d, few), langid.held_out_languages, lambda d: packing.pack(d)):
        assert run(none).count() == 0
        assert {r.doc_id for r in run(odd).select("doc_id").collect()} == {r.doc_id for r in odd.select("doc_id").collect()}
    assert {r.p_toxic for r in toxicity.score_toxicity(odd, few.where("false")).collect()} == {0.0}
    noise = odd.withColumn("seed", F.lit(1)).withColumn("bucket", F.lit("x")).withColumn("__loom_hit", F.lit("y"))
    assert toxicity.drop_toxic(noise, few).columns == noise.columns
    bench = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    noise = noise.withColumn("__loom_id", F.lit(7)).withColumn("__loom_sha", F.lit("z")).withColumn("__loom_p", F.lit(0)).withColumn("part", F.lit(1))
    for drop in (exact.drop_copies, simhash.drop_near_duplicates, lambda d: decontaminate.drop_contaminated(d, bench)):
        got = drop(noise)
        assert got.columns == noise.columns and {r.doc_id for r in got.collect()} == {r.doc_id for r in drop(odd).collect()}
