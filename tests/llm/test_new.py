"""Hard negatives, mixing and collocations against plain versions on small, awkward tables."""

import random
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomwork.llm import collocations, mixing, negatives

VECTORS = T.StructType(
    [T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType()),
     T.StructField("q", T.StringType()), T.StructField("span", T.StringType()), T.StructField("norm", T.StringType())]
)


def odd_vectors() -> list[tuple]:
    rng = random.Random(3)
    rows = []
    for i in range(400):
        v = [rng.gauss(0, 1) * rng.choice([0.1, 1, 3]) for _ in range(8)]
        rows.append((i, v, rng.randrange(3), "x", "y", "z"))
    copy = rows[0][1]
    rows += [(400 + i, copy, i % 3, None, None, None) for i in range(120)]  # one very common vector
    rows += [(600, None, 1, "", "", ""), (601, [1.0] * 8, None, "", "", ""), (None, [1.0] * 8, 1, "", "", ""), (602, [float("nan")] * 8, 1, "", "", ""), (603, [None] + [1.0] * 7, 1, "", "", "")]
    rows += [(604, [float("inf")] * 8, 1, "", "", ""), (650, [1.0, 2.0], 1, "", "", ""), (651, [1.0, 1.0], 1, "", "", ""), (652, [1.0, 0.7], 0, "", "", ""), (700, [], 1, "", "", ""), (701, [0.0] * 8, 1, "", "", ""), (750, [0.0] * 8, 2, "", "", "")]
    return rows


def plain_negatives(rows: list[tuple]) -> list[tuple]:
    own = []
    for i, v, label, *_ in rows:
        if i is None or label is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        own.append((i, [int(np.floor(256 * float(np.float32(x)))) for x in v], (label + 1) % 10 if i % 7 == 0 else label))
    out = []
    for a, q, label in own:
        if a % 50:
            continue
        scored = sorted((-sum(x * y for x, y in zip(q, r, strict=True)), i, other) for i, r, other in own if i != a and len(r) == len(q))
        for s, p, _ in [x for x in scored if x[2] == label][:5]:
            fits = [x for x in scored if x[2] != label and 50 * -s <= 100 * -x[0] and 100 * -x[0] <= 95 * -s][:3]
            out += [(a, p, n, i, -s, -t) for n, (t, i, _) in enumerate(fits, 1)]
    return sorted(out)


@pytest.mark.parametrize("sizes", [{}, {"bucket": 7, "span": 2, "block": 3}])
def test_hard_negatives(spark, sizes):
    rows = odd_vectors()
    found = negatives.mined(spark.createDataFrame(rows, VECTORS).repartition(5), **sizes)
    assert sorted(map(tuple, found.collect())) == plain_negatives(rows)


def test_hard_negatives_large_components(spark):
    rows = [(i, [float(np.float32((i % 9 + 1) * 10.0**k)) for k in (12, 11, 10)], i % 2, "", "", "") for i in range(1, 60)]
    found = negatives.mined(spark.createDataFrame(rows, VECTORS)).collect()
    want = [(*r[:4], *(x if x < 1 << 63 else None for x in r[4:])) for r in plain_negatives(rows)]
    assert sorted(map(tuple, found), key=repr) == sorted(want, key=repr) and len(found) > 5


def test_hard_negatives_empty(spark):
    assert negatives.mined(spark.createDataFrame([], VECTORS)).count() == 0
    assert negatives.mined(spark.createDataFrame(odd_vectors()[:1], VECTORS)).count() == 0


def test_buckets_are_pruned(spark):
    """A bucket whose longest vector cannot reach the k-th score is never multiplied."""
    rows = [(i, [10.0 if i < 32 else 0.1] + [0.0] * 3, i % 2, "", "", "") for i in range(640)]
    own = negatives.vectors(spark.createDataFrame(rows, VECTORS))
    packs = negatives.packed(own, 16, 1, "t").toPandas().sort_values("span")
    assert packs["longest"].is_monotonic_decreasing and packs["n"].sum() == 640
    seen = []
    kept = negatives._matrix
    asked = [{"anchor_id": 0, "copy": 1, "dim": 4, "norm": 2560.0, "label": 0, "q": np.array([2560.0, 0, 0, 0]).tobytes(), "windows": [{"place": 0, "p": None, "kth": None}]}]

    class Table:
        def __init__(self, rows):
            self.rows = rows

        def to_pylist(self):
            return self.rows

    negatives._matrix = lambda p: seen.append(p["longest"]) or kept(p)
    try:
        negatives._searcher(5, True)(Table(asked), Table(packs.to_dict("records")))
    finally:
        negatives._matrix = kept
    assert seen and min(seen) == 2560.0


def plain_phrases(rows: list[tuple[str | None, str | None]], least: int, top: int) -> list[tuple]:
    fold = {ord(c): ord(c) + 32 for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"} | {ord(c): "\n" for c in ".,;:!?\x0b\x0c\r"}
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in (text or "").translate(fold).split("\n"):
            w = [x for x in piece.replace("\t", " ").split(" ") if x]
            n[lang] += len(w)
            for i in range(len(w)):
                for m in range(1, 5):
                    if i + m <= len(w):
                        f[lang][tuple(w[i : i + m])] += 1
    out = []
    for lang, c in f.items():
        frequent = {p: a for p, a in c.items() if a >= least}
        best = []
        for p, a in frequent.items():
            if len(p) < 2 or any(100 * b >= 80 * a for q, b in frequent.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))):
                continue
            score, _, left, right = min((2000000 * a // (c[p[:k]] + c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p)))
            best.append((-score, -a, " ".join(p).encode(), left, right))
        out += [(lang, k, p.decode(), -a, left, right, n[lang], -s) for k, (s, a, p, left, right) in enumerate(sorted(best)[:top], 1)]
    return sorted(out)


@pytest.mark.parametrize("sizes", [{}, {"block_bytes": 400, "range_bytes": 100}])
def test_collocations(spark, odd, sizes):
    rng = random.Random(9)
    words = ["a", "b", "the", "The", "É", "é", "x\x01", "x", "\x00", "zz", "𝔘", "\x1f"]
    rows = [(None, "en"), ("", None), ("...", "fr")]
    for k in range(300):
        text = "".join(rng.choice(words[: 4 + k % 9]) + rng.choice([" ", " ", " ", "\t", "  ", ". ", "\n"]) for _ in range(rng.randrange(40)))
        rows.append((text, rng.choice(["en", "en", None, "und", "", "fr\x00", "fr"])))
    rows += [("very common words here " * 50, "en")] * 40
    df = spark.createDataFrame([(1, t, g, None, None, "p", "q", "r") for t, g in rows], odd.schema).repartition(6)
    got = collocations.collocations(df, 6, 50, **sizes)
    assert sorted(map(tuple, got.collect())) == plain_phrases(rows, 6, 50)


def test_collocations_odd(spark, odd, none):
    rows = [(r["text"], r["lang"]) for r in odd.collect()]
    assert sorted(map(tuple, collocations.collocations(odd, 2).collect())) == plain_phrases(rows, 2, 2000)
    assert collocations.collocations(none).count() == 0


def test_ranges_split_hot_prefixes():
    """Counts add up however the sorted suffixes are cut."""
    rng = np.random.default_rng(4)
    rows, count = collocations.summed(np.where(rng.random((500, 4)) < 0.8, 1, rng.integers(1, 4, (500, 4))).astype(np.int32), np.ones(500, np.int64))
    whole = {tuple(rows[::-1][r, :k]): f for r, k, f in collocations.prefixes(rows[::-1], count[::-1], 1)}
    parts = Counter()
    for cut in np.array_split(np.arange(len(rows)), 7):
        part, c = rows[cut][::-1], count[cut][::-1]
        for r, k, f in collocations.prefixes(part, c, 10**9):
            parts[tuple(part[r, :k])] += f
    assert all(whole[p] >= f for p, f in parts.items()) and parts[(1,)] == whole[(1,)]


def mixed(rows):
    return sorted(map(tuple, rows), key=repr)


def test_mixing_against_sql(spark, odd, none):
    got = mixing.mix(odd)
    documents = odd.select("doc_id", "text", "lang", "source").toPandas()
    documents["doc_id"] = documents["doc_id"].astype("Int64")
    extra = odd.withColumn("source", F.when(F.col("doc_id") % 5 > 0, F.concat(F.lit("s"), F.col("doc_id") % 5)))
    for df in (odd, extra):
        documents = df.select("doc_id", "text", "source").toPandas()
        documents["doc_id"] = documents["doc_id"].astype("Int64")
        con = duckdb.connect()
        con.register("docs", documents)
        con.sql("create view documents as select doc_id, CAST(text AS VARCHAR) AS text, CAST(source AS VARCHAR) AS source from docs")
        got = mixing.mix(df)
        want = con.sql(mixing.ORACLE_SQL)
        assert got.columns == want.columns and mixed(got.collect()) == mixed(want.fetchall())
    assert mixing.mix(none).count() == 0


def test_mixing_holds_its_promises(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").withColumn("source", F.when(F.col("doc_id") % 3 > 0, "big").when(F.col("doc_id") % 10 > 0, F.concat(F.lit("s"), F.col("doc_id") % 10)))
    rows = mixing.mix(docs).collect()
    assert mixed(rows) == mixed(mixing.mix(docs.repartition(7)).collect())
    total = sum(r["size"] for r in rows)
    assert all(0 <= r["taken"] <= 3 * r["size"] and r["taken"] == r["whole"] * r["size"] + r["part"] for r in rows)
    targets = {r["source"]: (r["target"], r["source_size"]) for r in rows}
    assert abs(sum(t for t, _ in targets.values()) - total) < 1
    assert any(t == 3 * s for t, s in targets.values())
    for source, (target, size) in targets.items():
        assert abs(sum(r["taken"] for r in rows if r["source"] == source) - target) <= 1 and target <= 3 * size
        assert sum(r["part"] > 0 for r in rows if r["source"] == source) <= 1


def test_mixed_corpus(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    taken = mixing.mix(docs).agg(F.sum("taken")).first()[0]
    assert mixing.repeated(docs).select(F.sum(mixing.words(F.col("text")))).first()[0] == taken
