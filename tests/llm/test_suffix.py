import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

pytest.importorskip("loomwork.llm")
from loomwork.llm import bcr, suffix  # noqa: E402


def plain(rows, length=200):
    where = defaultdict(int)
    data = [(t or "").encode() for _, t in rows]
    for b in data:
        for p in range(len(b) - length + 1):
            where[b[p : p + length]] += 1
    out = Counter()
    for (i, _), b in zip(rows, data, strict=True):
        cover = np.zeros(len(b) + 1, bool)
        for p in range(len(b) - length + 1):
            if where[b[p : p + length]] > 1:
                cover[p : p + length] = True
        n_spans = int((np.diff(cover.astype(int), prepend=0) == 1).sum())
        kept = bytes(x for x, c in zip(b, cover, strict=False) if not c)
        out[i, len(b), int(cover.sum()), n_spans, hashlib.sha256(kept).hexdigest()] += 1
    return out


def test_columns_give_suffixes_and_prefixes():
    rng = np.random.default_rng(0)
    for _ in range(120):
        some = [rng.integers(97, 97 + rng.integers(1, 5), rng.integers(1, 40)).astype(np.uint8).tobytes() for _ in range(rng.integers(1, 12))]
        start, lcp = bcr.build(some, 6)
        flat, end = b"".join(some), np.cumsum([len(s) for s in some])
        got = [flat[p : end[np.searchsorted(end, p, side="right")]] for p in start]
        assert got == sorted(got) and len(got) == len(flat)
        for a, b, n in zip(got, got[1:], lcp[1:], strict=False):
            same = next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
            assert n == min(same, 6)


def repeats(rng):
    word = lambda: "".join(rng.choice(list("abcdeé "), 9))
    text = lambda n: "".join(word() for _ in range(n // 9))
    passages = [text(n) for n in (150, 199, 260, 500, 900)] + ["ab" * 200, "x" * 450, "é" * 150]
    out = []
    for _ in range(60):
        t = text(int(rng.integers(20, 500)))
        for _ in range(int(rng.integers(0, 3))):
            p = passages[rng.integers(len(passages))]
            a = int(rng.integers(0, max(1, len(p) // 3)))
            cut = int(rng.integers(0, len(t) + 1))
            t = t[:cut] + p[a : len(p) - int(rng.integers(0, 60))] + t[cut:]
        out.append(t)
    return out + out[:6] + [out[7][:-1], "", "z" * 199, "z" * 200, "y" * 201, out[8] + out[8]]


@pytest.mark.parametrize(("hot", "bits", "chunk"), [(suffix.HOT, suffix.BITS, suffix.CHUNK), (3, 1 << 10, suffix.CHUNK), (3, suffix.BITS, suffix.CHUNK), (1, suffix.BITS, suffix.CHUNK)])
def test_against_all_strings(spark, hot, bits, chunk):
    rows = [(k if k % 9 else 7, t) for k, t in enumerate(repeats(np.random.default_rng(hot)))] + [(None, None), (None, "q" * 300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = suffix.remove_repeats(docs, bits=bits, hot=hot)
    assert Counter(map(tuple, got.collect())) == plain(rows)


def test_texts_that_repeat_themselves(spark, monkeypatch):
    """Every byte starts a run of its own; they travel as stretches, whatever the limits."""
    rng = np.random.default_rng(4)
    noise = "".join(rng.choice(list("abcdef "), 700))
    rows = [(1, "x" * 4000), (2, "ab" * 900 + noise), (3, noise[:300] + "x" * 900 + "y"), (4, "abc" * 300), (5, "x" * 201), (None, "x" * 260 + noise[300:]), (6, "abcde" * 200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = plain(rows)
    for hot in (2, 50, suffix.HOT):
        assert Counter(map(tuple, suffix.remove_repeats(docs, hot=hot).collect())) == want
    r = suffix.Runs(next(suffix.parts([b"x" * 3000])))
    own, times = r.stretches(np.arange(len(r.seed)), alike=True)
    assert len(r.seed) > 2500 and len(own) < 5 and times.sum() == len(r.seed)
    monkeypatch.setattr(suffix, "ROWS", 8)
    found = list(suffix._seeds(32, 4)(iter([suffix.pa.RecordBatch.from_arrays([suffix.pa.array([1, 2]), suffix.pa.array([5, 6]), suffix.pa.array([noise.encode(), noise.encode()], suffix.pa.binary())], ["doc_id", "tag", "data"])])))
    assert sum(int(x["n"].sum()) for b in found for x in suffix.unpacked(b.column(1), suffix.SEED)) == 2 * sum(len(suffix.Runs(p).seed) for p in suffix.parts([noise.encode()]))


def test_rows_whose_texts_share_a_checksum(spark):
    """Null ids, and one id that two rows have: equal crc32, different texts."""
    rng = np.random.default_rng(11)
    letters = np.frombuffer(b"abcdefghijklmnop", np.uint8)
    passage, lone = (letters[rng.integers(0, 16, 250)].tobytes() for _ in range(2))
    tails = [letters[x].tobytes() for x in rng.integers(0, 16, (300_000, 9))]
    with_passage = {zlib.crc32(passage + t): t for t in tails[:150_000]}
    a, b = next((with_passage[c], t) for t in tails[150_000:] if (c := zlib.crc32(lone + t)) in with_passage)
    one, other = (passage + a).decode(), (lone + b).decode()
    assert zlib.crc32(one.encode()) == zlib.crc32(other.encode())
    for i in (None, 4):
        rows = [(i, one), (i, other), (9, passage.decode() + "end")]
        got = suffix.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"))
        assert Counter(map(tuple, got.collect())) == plain(rows)


def test_tables(spark, odd, none, small):
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    assert Counter(map(tuple, suffix.remove_repeats(odd).collect())) == plain(rows)
    assert suffix.remove_repeats(none).count() == 0
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert Counter(map(tuple, suffix.remove_repeats(docs).collect())) == plain(rows)


def test_pieces_of_long_texts(monkeypatch):
    """A text cut into pieces has every string in exactly one run."""
    rng = np.random.default_rng(1)
    b = rng.integers(97, 100, 3000).astype(np.uint8)
    monkeypatch.setattr(suffix, "CHUNK", 700)
    found = [(t, s + lo + k) for p in suffix.parts([b.tobytes(), b"x", b"y" * 205]) for r in [suffix.Runs(p)] for t, s, lo, n in zip(r.text, r.shift, r.lo, r.n, strict=True) for k in range(n)]
    assert sorted(found) == [(0, k) for k in range(len(b) - 199)] + [(2, k) for k in range(6)]
