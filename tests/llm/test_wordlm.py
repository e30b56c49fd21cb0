"""The word model against a plain one, and what the symbol model could not tell apart."""

from collections import Counter

import numpy as np
import pytest

pytest.importorskip("loomwork.llm")
from loomwork.llm import queries, wordlm  # noqa: E402


def plain(all_texts, held):
    """n, target loss and background loss of every text; held: which are wanted."""
    split = [wordlm.words(t or "") for t in all_texts]
    vocabulary = len({w for s in split for w in s})
    models = []
    for keep in (held, [True] * len(split)):
        word, history, pair = Counter(), Counter(), Counter()
        for s, k in zip(split, keep, strict=True):
            if k:
                word.update(s)
                history.update([None, *s][: len(s)])
                pair.update(zip([None, *s], s, strict=False))
        models.append((word, history, pair, sum(word.values())))
    out = []
    for s in split:
        loss = []
        for word, history, pair, total in models:
            bits = 0.0
            for h, w in zip([None, *s], s, strict=False):
                p = (word[w] + wordlm.HALF) / (total + wordlm.HALF * vocabulary)
                bits -= np.log2((pair[h, w] + wordlm.MASS * p) / (history[h] + wordlm.MASS))
            loss.append(bits / max(1, len(s)))
        out.append((len(s), *loss))
    return out


def test_words():
    assert wordlm.words("It's  Déjà-vu, 東京 x_1\n") == ["it", "'", "s", "déjà", "-", "vu", ",", "東", "京", "x_1"]


@pytest.mark.parametrize("block_bytes", [wordlm.BLOCK_BYTES, 300])
def test_word_scores(spark, odd, none, block_bytes):
    labels = spark.createDataFrame([(i, int(i % 2 == 0)) for i in range(1, 200, 3)] + [(4, 1), (None, 1), (9999, 1)], "doc_id long, quality int")
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    held = [i is not None and i % 2 == 0 and i < 200 for i, _ in rows]
    want = sorted((i or -1, *x) for (i, _), x in zip(rows, plain([t for _, t in rows], held), strict=True))
    got = sorted((r.doc_id or -1, r.n_tokens, r.target_loss, r.background_loss, r.score) for r in wordlm.score_difference(odd, labels, block_bytes=block_bytes).collect())
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert np.array([g[2:4] for g in got]) == pytest.approx(np.array([w[2:4] for w in want]), abs=1e-9)
    assert all(g[4] == g[2] - g[3] for g in got)
    assert wordlm.score_difference(none, labels).count() == 0
    assert wordlm.score_difference(odd, labels.where("false")).count() == odd.count()


def test_query_tells_characters_and_phrases_apart(spark, tmp_path):
    """Under byte classes 䀀 and 䀠 (last bytes 0x80, 0xa0) are one symbol, so both rows scored the same."""
    texts = ["䀀 alpha beta", "䀠 alpha beta", "red house by green river"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(0, 1)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    got = {r.doc_id: r for r in queries.op6_lm_score(spark, str(tmp_path)).collect()}
    assert got[0].score < got[1].score < got[2].score
    assert [got[k].n_tokens for k in range(3)] == [3, 3, 5]
